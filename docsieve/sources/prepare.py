"""Index preparation: documents plus vectors, under their suffixed field names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.functions.scalars import add_suffixes, content_fallback
from docsieve.functions.vectors import embed_text


def prepare_documents(
    df: DataFrame,
    embed: Callable[[Column], Column] = embed_text,
    model: str = "hashed-words",
    clock: bool = True,
) -> DataFrame:
    """One projection from raw documents to index documents.

    The text is the first of text, content and title; it becomes ``content`` unless the
    document has one. The vector, its model name and its dimension are added, names get
    their type suffix, and ``date_indexed`` is filled where it is missing.
    """
    have = [c for c in ("text", "content", "title") if c in df.columns]
    body = content_fallback(*have)
    out = df.withColumn("embedding", embed(body)).withColumn("vector_model", F.lit(model))
    out = out.withColumn("dimensions", F.size("embedding"))
    if "text" in df.columns:
        kept = F.coalesce("content", "text") if "content" in df.columns else F.col("text")
        out = out.withColumn("content", kept).drop("text")
    if clock:
        given = F.col("date_indexed") if "date_indexed" in df.columns else F.lit(None)
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        out = out.withColumn("date_indexed", F.coalesce(given.cast("string"), now))
    return add_suffixes(out)
