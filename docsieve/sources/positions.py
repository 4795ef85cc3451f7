"""Term positions as a derived Parquet table, so that a phrase reads its own terms instead of all texts.

A row holds one term of one text with the places where it stands, as gaps from place to place, which
stay small and pack well. Folders go by term bucket and files are sorted by term, as in ``postings``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.functions.text import _col, let, query_side_terms
from docsieve.operators.keyword import query_terms_in_order
from docsieve.sources.postings import bucket_of


def term_places(terms: Column) -> Column:
    """Array of (term, gaps) of the terms of one text: sort them with their places, then cut the runs."""

    def runs(placed: Column) -> Column:
        heads = F.filter(
            F.transform(placed, lambda x, i: F.when((i == 0) | (x["t"] != F.get(placed, i - 1)["t"]), i)), lambda i: i.isNotNull()
        )

        def cut(starts: Column) -> Column:
            def one(i: Column, n: Column) -> Column:
                end = F.coalesce(F.get(starts, n + 1), F.size(placed))
                first = F.get(placed, i)
                gap = lambda j: F.get(placed, j)["p"] - F.when(j == i, 0).otherwise(F.get(placed, j - 1)["p"])
                # Most terms stand once in a text.
                gaps = F.when(end == i + 1, F.array(first["p"])).otherwise(F.transform(F.sequence(i, end - 1), gap))
                return F.struct(first["t"].alias("term"), gaps.alias("gaps"))

            return F.transform(starts, one)

        return let(heads, cut)

    # sort_array orders like array_sort, which calls an expression per comparison.
    return let(F.sort_array(F.transform(terms, lambda t, i: F.struct(t.alias("t"), i.alias("p")))), runs)


def places(gaps: Column) -> Column:
    """The places behind their gaps."""
    start = F.array().cast("array<int>")
    return F.aggregate(
        gaps, F.struct(F.lit(0).alias("at"), start.alias("out")),
        lambda s, g: F.struct((s["at"] + g).alias("at"), F.concat(s["out"], F.array(s["at"] + g)).alias("out")),
        lambda s: s["out"],
    )


def build(df: DataFrame, key: str, text: Column | str, path: str, buckets: int = 64) -> None:
    """Write ``path/positions``; a text without terms has no row. Buckets are split and joined by size."""
    terms = query_side_terms(F.coalesce(_col(text), F.lit("")))
    rows = df.select(F.col(key).alias("key"), F.inline(term_places(terms))).withColumn("bucket", bucket_of("term", buckets))
    dealt = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
    dealt.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/positions")
    df.sparkSession.range(0, 1, 1, 1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")


def phrase(spark: SparkSession, path: str, query: str, key: str, slop: int = 0) -> DataFrame:
    """Keys of the texts that hold the query's terms in order, moved by at most ``slop`` places in all.

    With o = place minus rank in the query, a text matches when some choice of places has
    max(o) - min(o) <= slop. Only the folders and row groups of the query's terms are read; a text's
    places meet in one row, of which there are as many as the query has different terms.
    """
    stored = spark.read.parquet(f"{path}/positions")
    terms = query_terms_in_order(stored, query)
    different = list(dict.fromkeys(terms))
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    asked = spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(t) for t in different])).alias("t"))
    wanted = [r["b"] for r in asked.select(bucket_of("t", buckets).alias("b")).distinct().collect()]
    found = stored.where(F.col("bucket").isin(wanted) & F.col("term").isin(different))
    met = found.groupBy("key").agg(*[
        F.max(F.when(F.col("term") == t, F.col("gaps"))).alias(f"g{i}") for i, t in enumerate(different)
    ])
    met = met.where(reduce(lambda a, b: a & b, [F.col(f"g{i}").isNotNull() for i in range(len(different))]))
    # Places minus rank, by rank in the query.
    moved = [_less(places(F.col(f"g{different.index(t)}")), rank) for rank, t in enumerate(terms)]
    return met.where(_close(moved, slop)).select(F.col("key").alias(key))


def _less(values: Column, by: int) -> Column:
    return F.transform(values, lambda v: v - by)


def _close(offsets: list[Column], slop: int) -> Column:
    if slop == 0:
        return F.size(reduce(F.array_intersect, offsets)) > 0
    # Any fitting choice has its least offset; it lies at most slop below the first term's.
    lows = F.array_distinct(F.flatten(F.transform(offsets[0], lambda o: F.sequence(o - slop, o))))
    inside = lambda o, low: F.exists(o, lambda x: (x >= low) & (x <= low + slop))

    def bound(rest: list[Column], have: list[Column]) -> Column:
        if rest:
            return let(rest[0], lambda o: bound(rest[1:], [*have, o]))
        return F.exists(lows, lambda low: reduce(lambda a, b: a & b, [inside(o, low) for o in have]))

    return bound(offsets, [])
