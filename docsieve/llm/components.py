"""Connected components by alternating stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import written

_EDGES_A_FILE = 50_000
_LEAST_FILES = 12


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the smallest of u's neighbours; counted before it is joined."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    return edges.join(least, F.col("u") == F.col("_u")).drop("_u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = _least(both).where("v > u")
    return met.select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Both ends leave in one pass: a union of two would plan and run all that lies below it twice.
    ends = [F.struct(F.col(end).alias("u"), F.col("m").alias("v")) for end in ("v", "u")]
    return _least(edges).select(F.inline(F.array(*ends))).where("u <> v").distinct()


def _left_apart(edges: DataFrame) -> tuple[int, int]:
    """How many ``edges(u, v)`` there are, and how many nodes keep them from being stars: with two edges down, or up and down.

    Stars are what a round leaves as it is, so none has to be run to find that out.
    """
    ends = [F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
            F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))]
    nodes = edges.select(F.inline(F.array(*ends))).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    apart = (F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))
    n, left = nodes.agg(F.sum("down"), F.count_if(apart)).first()
    return n or 0, left


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; the root is the component's smallest node.

    Edges to itself and repeated edges do no harm. Each round is written to the scratch folder;
    what a node has in common with its neighbours is a minimum, so a node with a third of all
    edges is combined before the shuffle and its join can be split.
    """
    ordered = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current = written(ordered, "edges")
    while True:
        n, apart = _left_apart(current)
        if not apart:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        # Few edges in many shuffle partitions would make a small file of each, every round.
        files = max(_LEAST_FILES, n // _EDGES_A_FILE + 1)
        current = written(_small_star(_large_star(current)).coalesce(files), "edges")
