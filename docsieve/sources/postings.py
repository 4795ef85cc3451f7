"""Term postings as a derived Parquet table, for tables that are searched often.

The scan-based search in ``operators.keyword`` reads every text twice per query. The postings
table is built once; a query then reads the folders and row groups of its own terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.functions.text import _col, index_terms, let, query_terms
from docsieve.operators.keyword import bm25_weight

def term_counts_in(terms: Column) -> Column:
    """Array of (term, tf, dl) of one bag of terms: sort it, then measure the runs.

    Linear after the sort and inside the row, so counting needs no shuffle.
    """

    def runs(words: Column) -> Column:
        marks = F.transform(
            words,
            lambda w, i: F.when((i == 0) | (w != F.get(words, i - 1)), i),
        )
        return let(
            F.filter(marks, lambda i: i.isNotNull()),
            lambda starts: F.transform(
                starts,
                lambda i, n: F.struct(
                    F.get(words, i).alias("term"),
                    (F.coalesce(F.get(starts, n + 1), F.size(words)) - i).alias("tf"),
                    F.size(words).alias("dl"),
                ),
            ),
        )

    return let(F.sort_array(terms), runs)


def postings(df: DataFrame, key: str, text: Column | str) -> DataFrame:
    """(key, term, tf, dl) rows.

    The array goes straight into the generator: were it a column first, Spark would add a
    filter on its size, push it down and count every text twice.
    """
    return df.select(F.col(key).alias("key"), F.inline(term_counts_in(index_terms(text))))


def bucket_of(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(_col(term)), F.lit(buckets)).cast("int")


def build(df: DataFrame, key: str, text: Column | str, path: str, buckets: int = 64) -> None:
    """Write ``path/postings`` (folders by term bucket, files sorted by term) and ``path/corpus`` (one row).

    Buckets are rebalanced by Spark: one that is large, be it through a single term that most texts
    hold, is split into as many files as its size needs, small ones share a task. A search reads
    the folders of its terms; ``buckets`` is how finely these are cut.
    """
    rows = postings(df, key, text).withColumn("bucket", bucket_of("term", buckets))
    dealt = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
    dealt.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/postings")
    # The mean length comes from the counts just written, not from the texts again.
    written = df.sparkSession.read.parquet(f"{path}/postings")
    total = written.agg(F.sum("tf").cast("double")).scalar()
    corpus = df.agg(F.count(F.lit(1)).alias("n")).select(
        "n", (total / F.col("n")).alias("avgdl"), F.lit(buckets).alias("buckets")
    )
    corpus.write.mode("overwrite").parquet(f"{path}/corpus")


def search(
    spark: SparkSession, path: str, query: str, key: str, rows: int = 10, keys: DataFrame | None = None
) -> DataFrame:
    """BM25 over the postings: same scores and order as the scan-based search.

    ``keys``, one column, are the rows that may be found; they do not change the scores. A query
    without terms finds nothing.
    """
    terms = query_terms(spark, query)
    stored = spark.read.parquet(f"{path}/postings")
    if not terms:
        return stored.where(F.lit(False)).select(F.col("key").alias(key), F.lit(0.0).alias("score"))
    corpus = spark.read.parquet(f"{path}/corpus")
    buckets = corpus.first()["buckets"]
    asked = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in terms])).alias("t"))
    wanted = [r["b"] for r in asked.select(bucket_of("t", buckets).alias("b")).distinct().collect()]
    found = stored.where(F.col("bucket").isin(wanted) & F.col("term").isin(terms))
    # One count per query term, read from the same few row groups.
    counts = found.agg(
        F.create_map(
            *[
                x
                for t in terms
                for x in (F.lit(t), F.count_if(F.col("term") == t))
            ]
        ).alias("df")
    )
    stats = corpus.select(F.struct("n", "avgdl").alias("c")).scalar()
    if keys is not None:
        found = found.join(keys.toDF("key"), "key", "left_semi")
    scored = found.withColumn("_c", stats).withColumn("_df", counts.scalar())
    weight = bm25_weight(
        F.col("_c.n"), F.col("_df")[F.col("term")], F.col("tf"), F.col("dl"), F.col("_c.avgdl")
    )
    return (
        scored.groupBy(F.col("key").alias(key))
        .agg(F.sum(weight).alias("score"))
        .orderBy(F.desc("score"), key)
        .limit(rows)
    )
