"""Streams of changes: a change log written per micro-batch and read on top of the base.

A micro-batch replaces its own ``batch=N`` folder, so a batch that is run again after a lost
executor or driver leaves the same log. The base table is not rewritten per batch; ``commit``
folds the log into a new snapshot when that is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docsieve.operators.updates import DELETED, SEQ, latest


def read_changes(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _start(stream: DataFrame, write, checkpoint: str, within_ms: int | None, mode: str):
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if within_ms is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{within_ms} milliseconds").start()


def log_changes(
    stream: DataFrame, key: str, path: str, checkpoint: str, within_ms: int | None = None
) -> StreamingQuery:
    """Append the last row per key of every micro-batch to the log at ``path``.

    With ``within_ms`` a batch starts at least that often, so a change becomes visible that
    long after it arrives, plus the time the batch takes. Without it the stream handles what
    is there and stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest(batch, key).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(stream, write, checkpoint, within_ms, "append")


def log_table(
    spark: SparkSession, path: str, schema: T.StructType, after: int | None = None, upto: int | None = None
) -> DataFrame:
    """The log as one change table. ``seq`` becomes (batch, seq): later batches win.

    With ``after`` and ``upto`` only the folders of later batches, up to and with the last, are read.
    """
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    log = rows.option("basePath", path).parquet(path)
    if after is not None:
        log = log.where(F.col("batch") > after)
    if upto is not None:
        log = log.where(F.col("batch") <= upto)
    if DELETED not in log.columns:
        log = log.withColumn(DELETED, F.lit(False))
    return log.withColumn(SEQ, F.struct("batch", SEQ)).drop("batch")


def counters(stream: DataFrame, key: str, time: str, viewer: str) -> DataFrame:
    """Per key: number of views, time of the last one, sorted set of viewers.

    Run in update mode. The state holds one row per key, so keys (and the viewers of a key)
    have to be of bounded number.
    """
    return stream.groupBy(key).agg(
        F.count(F.lit(1)).alias("view_count"),
        F.max(time).alias("last_viewed"),
        F.array_sort(F.collect_set(viewer)).alias("recent_viewers"),
    )


def log_counters(
    counts: DataFrame, path: str, checkpoint: str, within_ms: int | None = None
) -> StreamingQuery:
    """Write the counter rows that a micro-batch changed to the log at ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(counts, write, checkpoint, within_ms, "update")


def counter_table(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """Newest counter row per key."""
    fields = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    log = spark.read.schema(fields).option("basePath", path).parquet(path)
    return latest(log, key, "batch").drop("batch")
