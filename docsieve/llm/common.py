"""Small helpers that the operators share."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import docsieve
from docsieve.functions.text import let
from docsieve.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D."""
    return F.array_remove(F.split(text, SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shingle_hashes(ws: Column, k: int) -> Column:
    """64-bit hashes of all windows of ``k`` words, in order; a shorter text is one window, no word is none."""
    n = F.size(ws)
    window = lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(k)])
    return (
        F.when(n >= k, F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), window))
        .when(n > 0, F.array(F.xxhash64(F.lit(k), ws)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose values are computed once, here.

    The values leave through a generator of one row, which the optimizer neither merges with
    later projections (that would compute them once per use) nor moves.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    kept = [df[c] for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(packed))


_shipped: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application, as one archive of its sources."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(docsieve.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="docsieve-")) / "docsieve.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of queries that others ran, as a caller who writes an operator's result.

    Spark removes a plan's shuffle files once the driver's garbage collector finds the plan unused, and a
    driver that has little to do collects rarely.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# Takes a plan's shuffle files away as soon as its query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once as Parquet to the shared scratch folder and read back from it.

    The shuffle files of the step are let go with it. Left to the driver's garbage collector, those of
    all steps would pile up on the executors' disks.
    """
    spark = df.sparkSession
    released(spark)
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def spread_key(*columns: Column, digits: int = 3) -> Column:
    """A short hexadecimal block name of the columns, for cutting large groups into 16 ** digits blocks."""
    return F.substring(F.md5(F.concat_ws("\x1f", *[c.cast("string") for c in columns])), 1, digits)


def group_offsets(counts: DataFrame, groups: list[str], block: str, n: str) -> DataFrame:
    """Rows of ``counts`` (one per group and block) with ``before``: the sum of ``n`` in earlier blocks.

    A group has as many rows here as it has blocks, however many rows it has in the table.
    """
    w = Window.partitionBy(*groups).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum(n).over(w), F.lit(0)))


__all__ = [
    "SPACE", "WORD", "group_offsets", "held", "let", "lower_ascii", "n_words", "released", "shingle_hashes", "shipped",
    "spread_key", "whole", "words", "written",
]
