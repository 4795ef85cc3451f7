"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, its source's target over its
source's size. Along one order of the source's documents these expectations are summed up, one
offset per source is added, and a document is emitted once for each whole number its sum passes.
The order is by size, so that the words taken stay within about one document of the target.

The order is never made by one task. A source's documents are counted by size, sizes are summed
up per source (as many rows as there are different sizes, whatever the number of documents), and
a size is cut into blocks by a hash, so the only sort over documents is inside one block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.llm.common import group_offsets, spread_key


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Targets of ``sizes(skey, source_size)``: adds ``target``, in the unit of the sizes.

    Sources in ``skey`` order take the weights in turn and share the sum of all sizes by weight; a
    target stops at ``cap`` times its source's size and the excess goes to the others by weight
    until none is above. That is one water level: with the sources by cap over weight, the level
    is the largest of (total - caps before) / (weights from here on). One row per source passes
    through one task, two numbers each: the list of sources, not the documents.
    """
    all_ = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(all_.orderBy("skey"))
    weighed = sizes.withColumn(
        "w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    ).withColumn("cap", F.col("source_size") * F.lit(cap))
    by_level = all_.orderBy(F.col("cap") / F.col("w"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(by_level), F.lit(0.0))
    level = (F.sum("source_size").over(all_) - before("cap")) / (F.sum("w").over(all_) - before("w"))
    levelled = weighed.withColumn("level", level)
    return levelled.select(
        "skey", "source_size", F.least("cap", F.max("level").over(all_) * F.col("w")).alias("target")
    )


def copies(
    docs: DataFrame,
    key: str,
    source: str,
    size: str,
    weights: Sequence[int] = (1, 2, 3),
    cap: float = 3.0,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``mix_source_size``, ``mix_target`` and ``mix_copies`` (0 to ``ceil(cap)``).

    ``size`` must hold a number for every row (a null counts as 0). A null source is a source of
    its own, the last one. A null key is a key like another. Repeated rows are separate documents
    and may get different numbers of copies. A source of size 0 has target 0 and gets no copies.
    An empty table gives no rows. Other columns stay as they are; columns whose names begin with
    ``mix_`` are overwritten. Equal input, weights and seed give equal copies.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    rows = docs.select(
        "*",
        F.coalesce(F.concat(F.lit("a"), docs[source].cast("string")), F.lit("b")).alias("mix_source"),
        F.coalesce(docs[size].cast("long"), F.lit(0)).alias("mix_size"),
        spread_key(F.coalesce(docs[key].cast("string"), F.lit(""))).alias("mix_block"),
    )
    blocks = rows.groupBy("mix_source", "mix_size", "mix_block").agg(F.count(F.lit(1)).alias("n"))
    sizes = blocks.groupBy("mix_source", "mix_size").agg(F.sum("n").alias("n"))
    per_source = sizes.groupBy(F.col("mix_source").alias("skey")).agg(
        F.sum(F.col("mix_size") * F.col("n")).alias("source_size")
    )
    wanted = targets(per_source, weights, cap)
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("skey"))), 1, 4), 16, 10).cast("double")
    wanted = wanted.select(
        F.col("skey").alias("mix_source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("mix_rate"),
        # Never nearer to a whole number than rounding errors are.
        ((digits + 0.5) / 65536).alias("mix_offset"),
    )
    by_size = group_offsets(sizes, ["mix_source"], "mix_size", "n").drop("n")
    by_size = by_size.withColumnRenamed("before", "mix_smaller").join(wanted, "mix_source")
    places = group_offsets(blocks, ["mix_source", "mix_size"], "mix_block", "n").drop("n")
    places = places.withColumnRenamed("before", "mix_before").join(by_size, ["mix_source", "mix_size"])
    in_block = Window.partitionBy("mix_source", "mix_size", "mix_block").orderBy(F.col(key))
    placed = rows.join(places, ["mix_source", "mix_size", "mix_block"]).withColumn(
        "mix_rank", F.row_number().over(in_block) + F.col("mix_before") + F.col("mix_smaller")
    )
    passed = lambda rank: F.floor(F.col("mix_rate") * rank + F.col("mix_offset"))
    taken = passed(F.col("mix_rank")) - passed(F.col("mix_rank") - 1)
    return placed.select(*docs.columns, "mix_source_size", "mix_target", taken.alias("mix_copies"))


def mix(docs: DataFrame, key: str, source: str, size: Column, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it was drawn. Same cases as ``copies``."""
    names = docs.columns
    own = {name: f"c{i}" for i, name in enumerate(names)}
    plain = docs.select(*[docs[name].alias(c) for name, c in own.items()], size.alias("size"))
    drawn = copies(plain, own[key], own[source], "size", **options).where("mix_copies > 0")
    drawn = drawn.withColumn("copy", F.explode(F.expr("sequence(1L, mix_copies)")))
    return drawn.select(*[F.col(c).alias(name) for name, c in own.items()])
