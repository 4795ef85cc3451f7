"""Live counters with a state of fixed size per key: totals and the last few viewers.

The state of a key is one row of count, time and at most ``most`` viewers with the times of their last
views; with a time to live, a key that is not seen for that long loses it and starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from docsieve.streaming.changes import log_counters

MOST = 10
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _latest_first(viewers: dict, most: int) -> list[tuple]:
    return sorted(viewers.items(), key=lambda item: (-item[1], str(item[0])))[:most]


class _Recent(StatefulProcessor):
    """Adds a key's new views to its row of state."""

    def __init__(self, key: str, most: int, live_ms: int | None, viewer_type: T.DataType):
        self.key, self.most, self.live_ms = key, most, live_ms
        self.whole = isinstance(viewer_type, T.IntegralType)
        entry = T.StructType([T.StructField("viewer", viewer_type), T.StructField("at", T.LongType())])
        self.schema = T.StructType([
            T.StructField("views", T.LongType()), T.StructField("last", T.LongType()), T.StructField("viewers", T.ArrayType(entry))
        ])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("views", self.schema, self.live_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        views, last, viewers = 0, None, {}
        if self.state.exists():
            views, last, kept = self.state.get()
            viewers = {v[0]: v[1] for v in kept}
        for part in rows:
            views += len(part)
            times = part["at"].dropna()
            if len(times):
                last = max(int(times.max()), last) if last is not None else int(times.max())
            # Within a batch only each viewer's last view counts; the list is cut before the next batch.
            newest = part.dropna(subset=["at", "viewer"]).groupby("viewer")["at"].max()
            for viewer, at in newest.items():
                # A batch with null viewers holds whole numbers as floats.
                viewer = int(viewer) if self.whole else viewer.item() if hasattr(viewer, "item") else viewer
                viewers[viewer] = max(int(at), viewers.get(viewer, int(at)))
            viewers = dict(_latest_first(viewers, self.most))
        ordered = _latest_first(viewers, self.most)
        self.state.update((views, last, ordered))
        yield pd.DataFrame({
            self.key: [key[0]], "view_count": [views], "last_us": [last], "recent_viewers": [[v for v, _ in ordered]]
        })

    def close(self) -> None:
        pass


def recent_counters(
    stream: DataFrame, key: str, time: str, viewer: str, most: int = MOST, live_ms: int | None = None
) -> DataFrame:
    """Per key: views, time of the last one in microseconds, and the last ``most`` different viewers, newest first.

    Run in update mode. Viewers seen at one time go by their text. A view without a time or a viewer counts,
    but names nobody. ``live_ms`` is processing time, for which Spark runs batches without rows too: such a
    stream never ends by itself, so log it with ``within_ms``.
    """
    viewer_type = stream.schema[viewer].dataType
    fields = T.StructType([
        T.StructField(key, stream.schema[key].dataType), T.StructField("view_count", T.LongType()),
        T.StructField("last_us", T.LongType()), T.StructField("recent_viewers", T.ArrayType(viewer_type)),
    ])
    views = stream.selectExpr(f"`{key}`", f"unix_micros(CAST(`{time}` AS TIMESTAMP)) AS at", f"`{viewer}` AS viewer")
    processor = _Recent(key, most, live_ms, viewer_type)
    return views.groupBy(key).transformWithStateInPandas(processor, fields, "Update", "ProcessingTime" if live_ms else "None")


def log_recent(counts: DataFrame, path: str, checkpoint: str, within_ms: int | None = None) -> StreamingQuery:
    """Write changed counter rows to the log at ``path``. Such state needs the RocksDB store, which is set for this query."""
    conf = counts.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        return log_counters(counts, path, checkpoint, within_ms)
    finally:
        if before is None:
            conf.unset(_PROVIDER)
        else:
            conf.set(_PROVIDER, before)
