"""Suggestions as a derived table: the best entries for every beginning of a word, written once.

Typing then reads the row group of what is typed. A beginning keeps ``most`` entries; Spark cuts each task's
lists to that before the shuffle, so that a beginning that most entries share stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsieve.functions.text import _col, tokenize
from docsieve.operators.spelling import suggest as suggest_by_scan
from docsieve.sources.postings import bucket_of

LETTERS = 12


def beginnings(df: DataFrame, entry: Column | str, weight: Column | str, letters: int = LETTERS, most: int = 10) -> DataFrame:
    """(prefix, rank, suggestion, weight): the ``most`` heaviest entries by beginning of a word, ties by entry."""
    entries = df.select(_col(entry).alias("suggestion"), _col(weight).alias("weight")).where(F.col("suggestion").isNotNull())
    entries = entries.groupBy("suggestion").agg(F.max("weight").alias("weight"))
    words = F.array_distinct(F.transform(tokenize("suggestion"), F.lower))
    begins = F.flatten(F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.least(F.length(w), F.lit(letters))), lambda n: F.substring(w, F.lit(1), n)
    )))
    rows = entries.select("suggestion", "weight", F.explode(F.array_distinct(begins)).alias("prefix"))
    order = Window.partitionBy("prefix").orderBy(F.desc("weight"), "suggestion")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("prefix", "rank", "suggestion", "weight")


def build(
    df: DataFrame, entry: Column | str, weight: Column | str, path: str, letters: int = LETTERS, most: int = 10, buckets: int = 64
) -> None:
    """Write ``path/prefixes`` (folders by bucket, sorted by prefix), ``path/entries`` and their limits."""
    rows = beginnings(df, entry, weight, letters, most).withColumn("bucket", bucket_of("prefix", buckets))
    dealt = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "prefix", "rank")
    dealt.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/prefixes")
    df.select(_col(entry).alias("entry"), _col(weight).alias("weight")).write.mode("overwrite").parquet(f"{path}/entries")
    limits = df.sparkSession.range(0, 1, 1, 1).select(F.lit(letters).alias("letters"), F.lit(most).alias("most"), F.lit(buckets).alias("buckets"))
    limits.write.mode("overwrite").parquet(f"{path}/limits")


def suggest(spark: SparkSession, path: str, typed: str, limit: int = 10) -> DataFrame:
    """(suggestion, weight), heaviest first. More letters or rows than the table was built for are looked up in the entries."""
    limits = spark.read.parquet(f"{path}/limits").first()
    typed = typed.lower()
    if not typed or len(typed) > limits["letters"] or limit > limits["most"]:
        return suggest_by_scan(spark.read.parquet(f"{path}/entries"), "entry", typed, "weight", limit)
    bucket = spark.range(0, 1, 1, 1).select(bucket_of(F.lit(typed), limits["buckets"]).alias("b")).first()["b"]
    rows = spark.read.parquet(f"{path}/prefixes").where((F.col("bucket") == bucket) & (F.col("prefix") == typed))
    return rows.where(F.col("rank") <= limit).orderBy("rank").select("suggestion", "weight")
