"""Streams over the table files, run to the end of what is there."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.operators import updates as U
from docsieve.plans.registry import Tables, query
from docsieve.plans.updates import CUSTOMER, MERGED_SQL, ROWS_SQL, log_of
from docsieve.streaming import changes as Z
from docsieve.streaming import recent as R
from docsieve.streaming import snapshots as S


def order_stream(t: Tables) -> DataFrame:
    orders = Z.read_changes(t.spark, t.folder, t.orders.schema, files="orders.parquet")
    key = F.col("o_custkey")
    return orders.select(
        F.when(F.col("o_orderstatus") == "P", key + 10000000).otherwise(key).alias("c_custkey"),
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("c_name"),
        F.lit(0).alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
    )


def indexed(t: Tables, within_ms: int | None) -> DataFrame:
    path, checkpoint = t.scratch("change-log"), t.scratch("change-log-state")
    stream = order_stream(t)
    running = Z.log_changes(stream, "c_custkey", path, checkpoint, within_ms)
    if within_ms is None:
        running.awaitTermination()
    else:
        running.processAllAvailable()
        running.stop()
    return U.commit(t.customer, Z.log_table(t.spark, path, stream.schema), "c_custkey")


UPSERT_SQL = f"""
    WITH {ROWS_SQL}
    SELECT {CUSTOMER} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
    UNION ALL SELECT {CUSTOMER} FROM last"""


@query("stream_upsert", UPSERT_SQL)
def stream_upsert(t: Tables) -> DataFrame:
    return indexed(t, None)


@query("stream_commit_within", UPSERT_SQL)
def stream_commit_within(t: Tables) -> DataFrame:
    """A running stream with a batch at least every 200 ms."""
    return indexed(t, 200)


@query(
    "stream_counters",
    """
    SELECT user_id, count(*) AS view_count, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_viewed,
      string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS recent_viewers FROM events GROUP BY user_id
    """,
)
def stream_counters(t: Tables) -> DataFrame:
    path, checkpoint = t.scratch("counters"), t.scratch("counters-state")
    events = Z.read_changes(t.spark, t.folder, t.events.schema, files="events.parquet")
    counts = Z.counters(events, "user_id", "ts", "event_type")
    Z.log_counters(counts, path, checkpoint).awaitTermination()
    table = Z.counter_table(t.spark, path, "user_id", counts.schema)
    return table.select(
        "user_id", "view_count", F.date_format("last_viewed", "yyyy-MM-dd HH:mm:ss").alias("last_viewed"),
        F.array_join("recent_viewers", ",").alias("recent_viewers"),
    )


@query(
    "stream_recent",
    """
    WITH v AS (SELECT event_type, user_id, max(ts) AS seen FROM events GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY seen DESC, CAST(user_id AS VARCHAR)) AS i FROM v)
    SELECT event_type, (SELECT count(*) FROM events e WHERE e.event_type = r.event_type) AS view_count,
      strftime(max(seen), '%Y-%m-%d %H:%M:%S') AS last_viewed, string_agg(user_id::VARCHAR, ',' ORDER BY i) FILTER (i <= 10) AS recent_viewers
    FROM r GROUP BY event_type
    """,
)
def stream_recent(t: Tables) -> DataFrame:
    """Event types as pages, users as their viewers, of whom the last ten are kept."""
    path, checkpoint = t.scratch("recent"), t.scratch("recent-state")
    events = Z.read_changes(t.spark, t.folder, t.events.schema, files="events.parquet")
    counts = R.recent_counters(events, "event_type", "ts", "user_id")
    R.log_recent(counts, path, checkpoint).awaitTermination()
    table = Z.counter_table(t.spark, path, "event_type", counts.schema)
    return table.select(
        "event_type", "view_count", F.date_format(F.timestamp_micros("last_us"), "yyyy-MM-dd HH:mm:ss").alias("last_viewed"),
        F.array_join("recent_viewers", ",").alias("recent_viewers"),
    )


@query("commit_manifest", f"WITH {MERGED_SQL} SELECT {CUSTOMER} FROM now")
def commit_manifest(t: Tables) -> DataFrame:
    """Three batches of changes: two are folded into a snapshot, twice, and dropped; the third is still pending."""
    root, log = t.scratch("snapshots"), t.scratch("change-log")
    changes = log_of(t)
    S.create(t.customer, root)
    last = t.orders.agg(F.max("o_orderkey")).scalar() + 1
    batch = F.floor(F.col("seq") * 3 / last).cast("long")
    for n in range(3):
        changes.where(batch == n).write.parquet(f"{log}/batch={n}")
        if n == 1:
            S.fold(t.spark, root, log, changes.schema, "c_custkey")
            S.fold(t.spark, root, log, changes.schema, "c_custkey")
            S.drop_folded(t.spark, root, log)
    return S.view(t.spark, root, log, changes.schema, "c_custkey")
