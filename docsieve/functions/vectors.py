"""Vector expressions: similarity, normalising, text form and hashed text vectors."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.functions.text import _col, index_terms, let


def norm(v: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(
            _col(v), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
    )


def l2_normalize(v: Column | str) -> Column:
    """Scale to unit length; the zero vector stays as it is."""
    pair = F.struct(_col(v).cast("array<double>").alias("v"), norm(v).alias("n"))
    return let(
        pair,
        lambda p: F.when(p["n"] > 0, F.transform(p["v"], lambda x: x / p["n"])).otherwise(p["v"]),
    )


def vector_to_text(v: Column | str) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", _col(v).cast("array<string>")), F.lit("]"))


def text_to_vector(text: Column | str) -> Column:
    """``"[0.1, 0.2]"`` to an array of floats; brackets and blanks are ignored."""
    return F.split(F.regexp_replace(_col(text), r"[\[\]\s]", ""), ",").cast("array<float>")


def term_bucket(term: Column, dim: int) -> Column:
    """Stable bucket of a term: first eight hex digits of its md5, modulo ``dim``."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("bigint") % dim


def bucket_counts(buckets: Column, dim: int) -> Column:
    """How often each of ``dim`` bucket numbers occurs: sort them, measure the runs, fill the gaps.

    One pass after the sort, whatever the number of dimensions.
    """

    def runs(b: Column) -> Column:
        starts = F.filter(
            F.transform(b, lambda x, i: F.when((i == 0) | (x != F.get(b, i - 1)), i)), lambda i: i.isNotNull()
        )
        return let(starts, lambda at: F.transform(at, lambda i, n: F.struct(
            F.get(b, i).cast("int").alias("bucket"),
            (F.coalesce(F.get(at, n + 1), F.size(b)) - i).cast("double").alias("n"),
        )))

    def dense(found: Column) -> Column:
        last = lambda j: F.coalesce(F.get(found, j)["bucket"], F.lit(-1))
        filled = F.flatten(F.transform(found, lambda x, j: F.concat(
            F.array_repeat(F.lit(0.0), x["bucket"] - last(j - 1) - 1), F.array(x["n"])
        )))
        return F.concat(filled, F.array_repeat(F.lit(0.0), dim - 1 - last(F.size(found) - 1)))

    return let(let(F.sort_array(buckets), runs), dense)


def embed_text(text: Column | str, dim: int = 64) -> Column:
    """Hashed bag of words (Weinberger et al. 2009), unit length, without leaving the JVM."""
    buckets = F.transform(index_terms(text), lambda t: term_bucket(t, dim))
    return let(bucket_counts(buckets, dim), l2_normalize)


def embedding_udf(get_vectors: Callable[[list[str]], list[list[float]]]):
    """Wrap a batch text-to-vector model as an Arrow UDF usable in place of ``embed_text``."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pd.Series) -> pd.Series:
        return pd.Series(get_vectors(texts.fillna("").tolist()), index=texts.index)

    return embed


def mock_vector(key: Column | str, dim: int = 64, seed: int = 42) -> Column:
    """Deterministic unit vector per key: hashed uniforms, Box-Muller, normalised."""

    def uniform(i: Column, salt: int) -> Column:
        bits = F.pmod(F.xxhash64(_col(key), i, F.lit(seed), F.lit(salt)), F.lit(1 << 52))
        return (bits + 1) / F.lit(float((1 << 52) + 1))

    normal = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.sqrt(-2 * F.log(uniform(i, 0))) * F.cos(uniform(i, 1) * 6.283185307179586),
    )
    return l2_normalize(normal)
