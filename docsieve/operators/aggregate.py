"""Statistics, facets and term reports over a match set.

All of these aggregate map-side first, so a value that fills a third of the table costs one
partial row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.functions.text import _col

STATS = ("min", "max", "count", "missing", "sum", "mean", "stddev")


def field_stats(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row of statistics per numeric field, from a single pass over the matches.

    The fields are aggregated side by side into one row and only that row is turned into
    lines; turning the input itself would multiply it by the number of fields.
    """
    measures: list[Column] = []
    for i, name in enumerate(fields):
        value = F.col(name).cast("double")
        measures += [
            F.min(value).alias(f"min_{i}"),
            F.max(value).alias(f"max_{i}"),
            F.count(value).alias(f"count_{i}"),
            F.count_if(value.isNull()).alias(f"missing_{i}"),
            F.sum(value).alias(f"sum_{i}"),
            F.avg(value).alias(f"mean_{i}"),
            F.stddev_samp(value).alias(f"stddev_{i}"),
        ]
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("field"), *[F.col(f"{s}_{i}").alias(s) for s in STATS])
            for i, name in enumerate(fields)
        ]
    )
    return df.agg(*measures).select(F.inline(lines))


def fields_with_missing(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return field_stats(df, fields).where(F.col("missing") > 0).select("field", "count", "missing")


def facets(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, value, count) over the matches for several fields; lists count per element."""

    def lines(name: str) -> Column:
        value = F.col(name)
        if not isinstance(df.schema[name].dataType, T.ArrayType):
            value = F.array(value)
        values = F.filter(F.array_distinct(value.cast("array<string>")), lambda v: v.isNotNull())
        return F.transform(
            values, lambda v: F.struct(F.lit(name).alias("field"), v.alias("value"))
        )

    # A list that is missing as a whole must not take the other fields with it.
    nothing = F.array().cast("array<struct<field:string,value:string>>")
    every = F.concat(*[F.coalesce(lines(f), nothing) for f in fields])
    exploded = df.select(F.inline(every))
    return exploded.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))


def stats_and_facets(
    df: DataFrame, numbers: Sequence[str], fields: Sequence[str], limit: int | None = None
) -> DataFrame:
    """(part, field, name, amount): all statistics and facets of one match set in one pass.

    A search that asks for no rows needs only these. A row becomes one line per number and facet
    value, lists one per element, and the lines are combined map-side. ``limit`` keeps so many
    values of each facet, by count, then value.
    """

    def facet(name: str) -> Column:
        value = F.col(name)
        if not isinstance(df.schema[name].dataType, T.ArrayType):
            value = F.array(value)
        values = F.filter(F.array_distinct(value.cast("array<string>")), lambda v: v.isNotNull())
        return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: line("facet", name, v, F.lit(None)))

    def line(part: str, field: str, name: Column, value: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), F.lit(field).alias("field"), name.cast("string").alias("name"),
                        value.cast("double").alias("value"))

    lines = F.concat(F.array(*[line("stats", n, F.lit(None), F.col(n)) for n in numbers]), *[facet(f) for f in fields])
    v = F.col("value")
    grouped = df.select(F.inline(lines)).groupBy("part", "field", "name").agg(
        F.count(F.lit(1)).alias("rows"), F.min(v).alias("min"), F.max(v).alias("max"), F.count(v).alias("count"),
        F.count_if(v.isNull()).alias("missing"), F.sum(v).alias("sum"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"),
    )
    if limit is not None:
        order = Window.partitionBy("part", "field").orderBy(F.desc("rows"), "name")
        grouped = grouped.withColumn("_place", F.row_number().over(order)).where((F.col("part") == "stats") | (F.col("_place") <= limit))
    amounts = F.when(
        F.col("part") == "stats",
        F.array(*[F.struct(F.lit(s).alias("name"), F.col(s).cast("double").alias("amount")) for s in STATS]),
    ).otherwise(F.array(F.struct(F.col("name"), F.col("rows").cast("double").alias("amount"))))
    return grouped.select("part", "field", F.inline(amounts)).withColumn("amount", F.round("amount", 6))


def term_counts(df: DataFrame, terms: Column | str) -> DataFrame:
    """Term to number of documents that hold it.

    Repeats are dropped inside the row, so no distinct over (term, document) is shuffled.
    """
    return (
        df.select(F.explode(F.array_distinct(_col(terms))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def filter_terms(
    counts: DataFrame,
    prefix: str | None = None,
    regex: str | None = None,
    min_count: int = 1,
    max_count: int | None = None,
) -> DataFrame:
    """Term filters; the regex must match the whole term."""
    if prefix:
        counts = counts.where(F.col("term").startswith(prefix))
    if regex:
        counts = counts.where(F.col("term").rlike(f"^(?:{regex})$"))
    if min_count > 1:
        counts = counts.where(F.col("frequency") >= min_count)
    if max_count is not None:
        counts = counts.where(F.col("frequency") <= max_count)
    return counts


def top_terms(counts: DataFrame, limit: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("frequency"), "term").limit(limit)


def terms(
    df: DataFrame,
    term_array: Column | str,
    prefix: str | None = None,
    regex: str | None = None,
    limit: int = 10,
    min_count: int = 1,
    max_count: int | None = None,
) -> DataFrame:
    """The most frequent terms of a field that pass the filters.

    Filters on the term itself are moved below the aggregation by Catalyst.
    """
    counts = term_counts(df, term_array)
    return top_terms(filter_terms(counts, prefix, regex, min_count, max_count), limit)


def autocomplete(df: DataFrame, term_array: Column | str, typed: str, limit: int = 10) -> DataFrame:
    return terms(df, term_array, prefix=typed.lower(), limit=limit, min_count=2)


def tag_cloud(top: DataFrame) -> DataFrame:
    """Size 1 to 5 for the terms of a top-k report; one size when all counts are equal."""
    # At most ``limit`` rows, so one window over the report is bounded.
    report = Window.partitionBy(F.lit(0))
    lo, hi = F.min("frequency").over(report), F.max("frequency").over(report)
    steps = F.floor(4 * (F.col("frequency") - lo) / F.nullif(hi - lo, F.lit(0)))
    return top.select("term", "frequency", (1 + F.coalesce(steps, F.lit(0))).cast("int").alias("size"))


def vocabulary_stats(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count(F.lit(1)).alias("total_terms"),
        F.min("frequency").alias("min_frequency"),
        F.max("frequency").alias("max_frequency"),
        F.avg("frequency").alias("mean_frequency"),
    )


def unexpected_values(df: DataFrame, field: str, expected: Iterable[str]) -> DataFrame:
    """Observed values of a field that are not in the expected set, with their counts."""
    values = df.where(F.col(field).isNotNull() & ~F.col(field).isin(list(expected)))
    return values.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("frequency"))


def expanded_terms(df: DataFrame, term_array: Column | str, prefix: str, limit: int = 20) -> list[str]:
    """The top terms that start with a prefix, for an any-of search. At most ``limit`` rows."""
    return [r["term"] for r in terms(df, term_array, prefix=prefix, limit=limit).collect()]


def distinct_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, non_null, distinct_values) of text fields, from one scan.

    A value is shuffled as two 64-bit hashes, so long texts stay where they are; two values are
    taken for one only if both hashes agree.
    """

    def line(name: str) -> Column:
        hashes = [F.xxhash64(name).alias("h1"), F.xxhash64(F.lit(1), F.col(name)).alias("h2")]
        return F.when(F.col(name).isNotNull(), F.struct(F.lit(name).alias("field"), *hashes))

    lines = F.filter(F.array(*[line(f) for f in fields]), lambda x: x.isNotNull())
    values = df.select(F.inline(lines)).groupBy("field", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("field").agg(F.sum("n").alias("non_null"), F.count(F.lit(1)).alias("distinct_values"))
