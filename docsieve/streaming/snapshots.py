"""A table as snapshots and a change log, with a manifest that says how far the log is folded in.

``root/manifest/version=N`` is one row in one file: the snapshot's folder and the last log batch that is part
of it. It becomes visible by the rename that ends Spark's write, so a reader sees the old state or the new
one. A step that fails leaves folders that no manifest names and is simply run again. Readers skip batches
that are folded in, so a batch that a restarted stream writes once more changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.operators.updates import merged
from docsieve.streaming.changes import log_table

_MANIFEST = "version long, snapshot string, folded long"


@dataclass(frozen=True)
class State:
    """A published version: its snapshot and the last batch folded in, -1 for none."""

    version: int
    snapshot: str
    folded: int


def _rows(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, or None while there is none."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, root: str) -> list[State]:
    """All published versions, newest first."""
    found = _rows(spark, f"{root}/manifest", _MANIFEST)
    if found is None:
        return []
    return [State(r["version"], r["snapshot"], r["folded"]) for r in found.orderBy(F.desc("version")).collect()]


def current(spark: SparkSession, root: str) -> State:
    found = versions(spark, root)
    if not found:
        raise ValueError(f"no table at {root}")
    return found[0]


def publish(spark: SparkSession, root: str, state: State) -> None:
    """Make ``state`` the current version."""
    row = spark.createDataFrame([(state.snapshot, state.folded)], "snapshot string, folded long").coalesce(1)
    row.write.mode("overwrite").parquet(f"{root}/manifest/version={state.version}")


def create(df: DataFrame, root: str) -> State:
    """A new table with the rows of ``df`` and nothing folded in."""
    if versions(df.sparkSession, root):
        raise ValueError(f"there is a table at {root}")
    state = State(0, f"{root}/snapshots/{uuid.uuid4().hex}", -1)
    df.write.parquet(state.snapshot)
    publish(df.sparkSession, root, state)
    return state


def view(spark: SparkSession, root: str, log: str, schema: T.StructType, key: str) -> DataFrame:
    """The table with its pending batches on top. ``schema`` is that of the log's rows."""
    now = current(spark, root)
    base = spark.read.parquet(now.snapshot)
    if _last_batch(spark, log, now.folded) is None:
        return base
    return merged(base, log_table(spark, log, schema, after=now.folded), key)


def _last_batch(spark: SparkSession, log: str, folded: int) -> int | None:
    found = _rows(spark, log, "batch long")
    if found is None:
        return None
    return found.where(F.col("batch") > folded).agg(F.max("batch")).first()[0]


def fold(spark: SparkSession, root: str, log: str, schema: T.StructType, key: str) -> State:
    """Write a snapshot with all batches of the log that are there now, and publish it.

    Without new batches nothing is written, so a commit that is repeated is no other commit.
    """
    now = current(spark, root)
    last = _last_batch(spark, log, now.folded)
    if last is None:
        return now
    base = spark.read.parquet(now.snapshot)
    changes = log_table(spark, log, schema, after=now.folded, upto=last)
    state = State(now.version + 1, f"{root}/snapshots/{uuid.uuid4().hex}", last)
    merged(base, changes, key).write.parquet(state.snapshot)
    publish(spark, root, state)
    return state


def drop_folded(spark: SparkSession, root: str, log: str, keep: int = 1) -> int:
    """Delete folded batches, and snapshots that are neither current nor among the ``keep`` before it.

    Returns the number of folders deleted. Folders that failed steps left behind go as well; run it when
    no other fold runs. Paths are plain or of a kind that pyarrow opens.
    """
    from pyarrow import fs

    def inside(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
        files, where = fs.FileSystem.from_uri(path)
        return files, files.get_file_info(fs.FileSelector(where, allow_not_found=True))

    published = versions(spark, root)
    used = {s.snapshot.rsplit("/", 1)[1] for s in published[: keep + 1]}
    gone = 0
    files, found = inside(log)
    for info in found:
        name = info.base_name
        if name.startswith("batch=") and int(name[6:]) <= published[0].folded:
            files.delete_dir(info.path)
            gone += 1
    files, found = inside(f"{root}/snapshots")
    for info in found:
        if info.base_name not in used:
            files.delete_dir(info.path)
            gone += 1
    return gone
