"""Semantic search and the blend of keyword and vector results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.functions.vectors import embed_text
from docsieve.operators import keyword as K
from docsieve.operators import vector as V


def embed_query(df: DataFrame, text: str, embed: Callable[[Column], Column] = embed_text) -> list:
    """The vector of one query text, from the same expression that embeds the table."""
    return list(df.sparkSession.range(1).select(embed(F.lit(text))).first()[0])


def semantic_select(
    df: DataFrame,
    text: str,
    key: str,
    fields: Sequence[str],
    where: Column | None = None,
    limit: int = 10,
    offset: int = 0,
    vector: str = "embedding",
    embed: Callable[[Column], Column] = embed_text,
) -> DataFrame:
    query = embed_query(df, text, embed)
    return V.vector_select(df, query, key, fields, where, limit, offset, vector)


def blend(
    keyword: DataFrame, vector: DataFrame, key: str, k: int = 5, blend_factor: float = 0.5
) -> DataFrame:
    """Merge two top-k hit lists ``(key, score)`` into one.

    Each side is divided by its best score (0 when that is not positive), a missing side
    counts as 0, and ``hybrid = keyword * (1 - b) + vector * b``. Both inputs hold at most
    k rows, so nothing here grows with the table.
    """

    def scaled(hits: DataFrame, name: str) -> DataFrame:
        # A window over at most k rows; a second aggregate would run the search again.
        top = F.max("score").over(Window.partitionBy(F.lit(0)))
        share = F.when(top > 0, F.col("score") / top).otherwise(F.lit(0.0))
        return hits.select(key, share.alias(name))

    both = scaled(keyword, "keyword_score").join(scaled(vector, "vector_score"), key, "full_outer")
    kw, vec = (F.coalesce(c, F.lit(0.0)) for c in ("keyword_score", "vector_score"))
    return (
        both.select(
            key,
            kw.alias("keyword_score"),
            vec.alias("vector_score"),
            (kw * (1 - blend_factor) + vec * blend_factor).alias("hybrid_score"),
        )
        .orderBy(F.desc("hybrid_score"), key)
        .limit(k)
    )


def search(
    df: DataFrame,
    text: str,
    key: str,
    fields: Sequence[str] = (),
    where: Column | None = None,
    k: int = 10,
    blend_factor: float = 0.5,
    text_field: str = "text",
    vector: str = "embedding",
    embed: Callable[[Column], Column] = embed_text,
) -> DataFrame:
    """The k best rows for a text by words and by vector, with ``fields`` and the three scores.

    Both sides see the same filter; the stored vectors are read, only the query is embedded.
    """
    keyword = K.search(df, text_field, text, key, k, where).select(key, "score")
    near = V.knn(df, embed_query(df, text, embed), key, k, vector, where).select(key, "score")
    hits = blend(keyword, near, key, k, blend_factor)
    rows = V.attach(df.select(key, *[f for f in fields if f != key]), hits, key, k)
    return rows.orderBy(F.desc("hybrid_score"), key)


def compare(methods: dict[str, DataFrame], key: str) -> DataFrame:
    """Hit lists ``(key, score)`` side by side, ranked within their method."""
    out = None
    for name, hits in methods.items():
        listed = hits.select(
            F.lit(name).alias("method"), F.col(key), F.col("score").cast("double").alias("score")
        )
        out = listed if out is None else out.unionByName(listed)
    order = Window.partitionBy("method").orderBy(F.desc("score"), key)
    return out.withColumn("rank", F.row_number().over(order))
