"""Snapshots with a manifest: failures, repeats and upkeep; live counters whose state does not grow."""

import glob
import os
import time

import pytest
from pyspark.sql import types as T

from docsieve.streaming import changes as Z
from docsieve.streaming import recent as R
from docsieve.streaming import snapshots as S

ROW = "id long, v string"
LOG = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("deleted", T.BooleanType()),
])


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "v").collect())


@pytest.fixture
def table(spark, tmp_path):
    root, log = str(tmp_path / "t"), str(tmp_path / "log")
    S.create(spark.createDataFrame([(1, "a"), (2, "b")], ROW), root)
    return root, log


def append(spark, log, n, *changes):
    spark.createDataFrame(list(changes), LOG).write.mode("overwrite").parquet(f"{log}/batch={n}")


def view(spark, table):
    return rows(S.view(spark, *table, LOG, "id"))


def fold(spark, table):
    return S.fold(spark, *table, LOG, "id")


def test_pending_folded_and_repeated(spark, table):
    root, log = table
    assert view(spark, table) == [(1, "a"), (2, "b")]
    assert fold(spark, table).version == 0
    append(spark, log, 0, (1, "x", 1, False), (3, "c", 2, False))
    append(spark, log, 1, (1, "y", 1, False), (2, None, 1, True))
    now = [(1, "y"), (3, "c")]
    assert view(spark, table) == now
    first = fold(spark, table)
    assert (first.version, first.folded) == (1, 1) and view(spark, table) == now
    # Again without new batches: the same version, no new folder.
    assert fold(spark, table) == first and len(os.listdir(f"{root}/snapshots")) == 2
    # A restarted stream writes a folded batch once more, with other contents even.
    append(spark, log, 1, (1, "late", 9, False))
    assert view(spark, table) == now
    append(spark, log, 2, (4, "d", 1, False))
    assert view(spark, table) == [*now, (4, "d")]
    with pytest.raises(ValueError):
        S.create(spark.createDataFrame([], ROW), root)
    with pytest.raises(ValueError):
        S.current(spark, f"{root}-none")


@pytest.mark.parametrize("where", ["snapshot", "publish"])
def test_a_crash_leaves_the_old_state_and_the_step_can_be_repeated(spark, table, monkeypatch, where):
    root, log = table
    append(spark, log, 0, (1, "x", 1, False))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "publish" if where == "publish" else "merged", fail)
        with pytest.raises(RuntimeError):
            fold(spark, table)
    if where == "publish":
        # A writer that died during the manifest leaves a folder without its file.
        os.makedirs(f"{root}/manifest/version=1/_temporary/0")
    assert S.current(spark, root).version == 0 and view(spark, table) == [(1, "x"), (2, "b")]
    assert fold(spark, table).version == 1 and view(spark, table) == [(1, "x"), (2, "b")]
    S.drop_folded(spark, root, log, keep=0)
    assert len(os.listdir(f"{root}/snapshots")) == 1 and view(spark, table) == [(1, "x"), (2, "b")]


def test_the_log_stays_bounded(spark, table):
    root, log = table
    for n in range(6):
        append(spark, log, n, (n, f"v{n}", 1, False))
        fold(spark, table)
        S.drop_folded(spark, root, log)
        assert len(glob.glob(f"{log}/batch=*")) == 0 and len(os.listdir(f"{root}/snapshots")) <= 2
    assert view(spark, table) == [(n, f"v{n}") for n in range(6)]


def test_only_pending_folders_are_read(spark, table):
    root, log = table
    for n in range(4):
        append(spark, log, n, (n, f"v{n}", 1, False))
    plan = Z.log_table(spark, log, LOG, after=1, upto=2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


VIEWS = "page string, at timestamp, viewer long"


def run(spark, tmp_path, batches, **kw):
    inbox, log = tmp_path / "in", str(tmp_path / "log")
    states = []
    schema = T.StructType.fromDDL(VIEWS)
    for n, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, "page string, at double, viewer long").selectExpr("page", "timestamp_seconds(at) AS at", "viewer")
        frame.coalesce(1).write.mode("append").parquet(str(inbox))
        stream = Z.read_changes(spark, str(inbox), schema)
        counts = R.recent_counters(stream, "page", "at", "viewer", **kw)
        if kw.get("live_ms"):
            query = R.log_recent(counts, log, str(tmp_path / "state"), within_ms=200)
            end = time.time() + 60
            while time.time() < end and not any(p["numInputRows"] for p in query.recentProgress):
                time.sleep(0.2)
            query.stop()
            time.sleep(kw["live_ms"] / 1000 + 0.5)
            continue
        query = R.log_recent(counts, log, str(tmp_path / "state"))
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    table = Z.counter_table(spark, log, "page", counts.schema)
    return {r["page"]: (r["view_count"], r["last_us"], r["recent_viewers"]) for r in table.collect()}, states


def test_state_does_not_grow_with_viewers(spark, tmp_path):
    batches = [[(p, float(100 * n + i), 1000 * n + i) for p in "ab" for i in range(30)] for n in range(5)]
    got, states = run(spark, tmp_path, batches, most=4)
    assert states == [2] * 5
    for page in "ab":
        assert got[page] == (150, 429 * 10**6, [4029, 4028, 4027, 4026])


def test_viewers_that_come_again_nulls_and_ties(spark, tmp_path):
    batches = [[("a", 5.0, 1), ("a", 6.0, 2), ("a", 6.0, 3), ("a", None, 4), ("a", 7.0, None)], [("a", 8.0, 1), ("a", 1.0, 9), (None, 1.0, 1)]]
    got, _ = run(spark, tmp_path, batches, most=3)
    assert got["a"] == (7, 8 * 10**6, [1, 2, 3])
    assert got[None] == (1, 10**6, [1])


def test_a_key_that_is_not_seen_starts_anew(spark, tmp_path):
    batches = [[("a", 1.0, 1)], [("a", 2.0, 2)]]
    got, _ = run(spark, tmp_path, batches, most=3, live_ms=1000)
    assert got["a"] == (1, 2 * 10**6, [2])
