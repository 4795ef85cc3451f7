"""Removal of repeated byte strings by prefix-free parsing.

Every document is cut into phrases where a rolling hash of ``length - 1`` bytes fires; a phrase
runs to the end of the next firing window, so neighbours overlap and every string of ``length``
bytes lies in the one phrase that holds its start. The distinct phrases are the dictionary, the
phrases' sequence the parse (Boucher et al. 2019). A phrase that an earlier document has is
repeated as a whole; only first occurrences have to be compared with each other.

Comparing them is a matter of the dictionary's suffix order, of which only the first ``length``
bytes count. Suffixes are met at sampled places: in every window of ``length`` bytes, the
``SEED``-byte string of smallest hash. Equal strings have equal samples at equal distances, so
suffixes are put in order only around samples that two documents share, and runs of suffixes that
agree in ``length`` bytes take the smallest document of the run.

Dictionary and suffixes are keyed by hashes (128 and 64 bits) and spread by them; a text goes to
its key once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.llm.common import shipped, whole, written

LENGTH = 50
PERIOD = 256  # mean distance of phrase starts
SEED = 24  # longer: fewer chance meetings, more samples (two of every LENGTH - SEED + 2 bytes)
SPLIT_ROWS = 100_000  # above so many places (about 150 MB in a task), a sample is compared by Spark joins
_AT_ONCE = 1 << 19
_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)
_BYTES_2 = np.random.default_rng(8).integers(0, 1 << 63, 256, dtype=np.uint64)


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` values, by joining windows of powers of two."""
    out, have, window, size = None, 0, values, 1
    while k:
        if k & 1:
            if out is None:
                out, have = window, size
            else:
                n = len(values) - have - size + 1
                out, have = out[:n] * np.uint64(pow(_MULTIPLIER, size, 1 << 64)) + window[have : have + n], have + size
        k >>= 1
        if k:
            window = window[:-size] * np.uint64(pow(_MULTIPLIER, size, 1 << 64)) + window[size:]
            size *= 2
    out = out ^ (out >> np.uint64(32))
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    low, size = values, 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    if size < width:
        low = np.minimum(low[: len(values) - width + 1], low[width - size :])
    return low


def stretches(offsets: np.ndarray, most: int, overlap: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, document ends inside) for working through a buffer of documents some bytes at a time.

    A document longer than ``most`` bytes is cut, the parts overlapping so that no window is lost.
    """
    i, last = 0, len(offsets) - 1
    while i < last:
        j = max(int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1, i)
        if j > i:
            yield int(offsets[i]), int(offsets[j]), offsets[i + 1 : j + 1]
            i = j
            continue
        a, end = int(offsets[i]), int(offsets[i + 1])
        while a < end:
            b = min(a + most + overlap, end)
            yield a, b, np.array([b])
            a = end if b == end else a + most
        i += 1


def _left(ends: np.ndarray, a: int, n: int) -> np.ndarray:
    """Bytes from each of the first ``n`` places of a stretch to the end of its document."""
    at = np.arange(a, a + n)
    return ends[np.searchsorted(ends, at, side="right").clip(max=len(ends) - 1)] - at


def phrase_starts(data: np.ndarray, offsets: np.ndarray, length: int, period: int) -> np.ndarray:
    """Where phrases begin: each document's first byte and every place where the hash fires."""
    found = [offsets[:-1][np.diff(offsets) > 0]]
    for a, b, ends in stretches(offsets, _AT_ONCE, length - 1):
        if b - a >= length - 1:
            fires = np.flatnonzero(rolling(_BYTES[data[a:b]], length - 1) % np.uint64(period) == 0)
            found.append(a + fires[_left(ends, a, b - a)[fires] >= length - 1])
    return np.unique(np.concatenate(found))


def sample_places(data: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sampled ``seed``-byte strings and their hashes."""
    # A stretch has _AT_ONCE + length - 1 bytes at most; the place in it must fit below the hash.
    low_bits = np.uint64((1 << (_AT_ONCE + length - 1).bit_length()) - 1)
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, b, ends in stretches(offsets, _AT_ONCE, length - 1):
        if b - a < length:
            continue
        values = rolling(_BYTES[data[a:b]], seed)
        ranked = (values & ~low_bits) | np.arange(len(values), dtype=np.uint64)
        chosen = smallest(ranked, length - seed + 1)
        chosen = (chosen[_left(ends, a, len(chosen)) >= length] & low_bits).astype(np.int64)
        if len(chosen):
            chosen = chosen[np.append(True, chosen[1:] != chosen[:-1])]
            places.append(a + chosen)
            hashes.append(values[chosen].view(np.int64))
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[first]


_powers: list[np.ndarray] = []


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each byte range, the same wherever equal bytes lie."""
    if not _powers:
        for m in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            _powers.append(np.cumprod(np.full(2 * _AT_ONCE, m, dtype=np.uint64)))
    out = np.empty((2, len(starts)), dtype=np.uint64)
    long = np.flatnonzero(ends - starts > _AT_ONCE)
    for i in long:
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        out[:, i] = np.frombuffer(digest, dtype=np.uint64)
    rest = np.flatnonzero(ends - starts <= _AT_ONCE)
    at = 0
    while at < len(rest):
        to = max(int(np.searchsorted(ends[rest], starts[rest[at]] + 2 * _AT_ONCE, side="right")), at + 1)
        some = rest[at:to]
        a, b = int(starts[some[0]]), int(ends[some[-1]])
        lengths = (ends[some] - starts[some]).astype(np.uint64)
        for row, table in enumerate((_BYTES, _BYTES_2)):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(table[data[a:b]] * _powers[0][: b - a])])
            h = (sums[ends[some] - a] - sums[starts[some] - a]) * _powers[1][starts[some] - a]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + lengths
            out[row, some] = h ^ (h >> np.uint64(29))
        at = to
    return out[0].view(np.int64), out[1].view(np.int64)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls; offsets begin at 0."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def parse(rows: DataFrame, length: int = LENGTH, period: int = PERIOD) -> DataFrame:
    """(d, r, h1, h2, a, b): the phrases of ``rows(d, r, data)`` that hold a whole window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _buffers(batch.column("data"))
            starts = phrase_starts(data, offsets, length, period)
            owner = np.searchsorted(offsets, starts, side="right") - 1
            end = offsets[owner + 1]
            follows = np.append(starts[1:], offsets[-1]) + length - 1
            ends = np.minimum(follows, end)
            keep = ends - starts >= length
            starts, ends, owner = starts[keep], ends[keep], owner[keep]
            h1, h2 = range_hashes(data, starts, ends)
            who = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").take(who), batch.column("r").take(who), pa.array(h1), pa.array(h2),
                 pa.array(starts - offsets[owner]), pa.array(ends - offsets[owner])],
                ["d", "r", "h1", "h2", "a", "b"],
            )

    return rows.mapInArrow(cut, "d long, r long, h1 long, h2 long, a long, b long")


def still_open(places: np.ndarray, low: np.ndarray, high: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which ranges ``low`` to ``high`` of window starts no union of ``starts`` to ``ends`` (sorted by start) covers."""
    if not len(starts):
        return np.ones(len(places), dtype=bool)
    ends = np.maximum.accumulate(ends)
    head = np.append(True, starts[1:] > ends[:-1] + 1)
    first, last = starts[head], ends[np.append(head[1:], True)]
    at = np.searchsorted(first, low, side="right") - 1
    return (at < 0) | (last[at.clip(min=0)] < high)


def samples(full: DataFrame, text: str, repeated: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(s, d, r, place): sampled places of ``full(d, r, text)`` with a window outside repeated phrases.

    Of a phrase that several documents have only the first document's places are left, which is enough:
    the smallest document of a string has it in a phrase that no smaller one has.
    """
    covered = repeated.groupBy(F.col("d").alias("rd"), F.col("r").alias("rr")).agg(F.collect_set(F.struct("a", "b")).alias("covered"))
    joined = full.join(covered, (F.col("d") == F.col("rd")) & (F.col("r") == F.col("rr")), "left")
    joined = joined.select("d", "r", F.encode(whole(F.col(text)), "UTF-8").alias("data"), "covered")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _buffers(batch.column("data"))
            places, hashes = sample_places(data, offsets, length, seed)
            owner = np.searchsorted(offsets, places, side="right") - 1
            known = batch.column("covered")
            sizes = known.value_lengths().fill_null(0).to_numpy()
            spans = known.flatten()
            base = np.repeat(offsets[:-1], sizes)
            starts, ends = base + spans.field("a").to_numpy(), base + spans.field("b").to_numpy() - length
            order = np.argsort(starts, kind="stable")
            low = np.maximum(places - (length - seed), offsets[owner])
            high = np.minimum(places, offsets[owner + 1] - length)
            keep = still_open(places, low, high, starts[order], ends[order])
            places, hashes, owner = places[keep], hashes[keep], owner[keep]
            who = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), batch.column("d").take(who), batch.column("r").take(who), pa.array(places - offsets[owner])],
                ["s", "d", "r", "place"],
            )

    return joined.mapInArrow(cut, "s long, d long, r long, place long")


def shared(found: DataFrame, split_rows: int) -> DataFrame:
    """(d, r, place, hot) of samples that two documents or more have, by one sort and one pass.

    A sample's rows wait until they are known to be shared, and up to ``split_rows`` of them until
    it is known whether there are more, which makes them ``hot``.
    """

    def flagged(table: pa.Table | pa.RecordBatch, hot: bool) -> pa.RecordBatch:
        columns = [table.column(c) for c in ("d", "r", "place")]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(columns[0]), hot))], ["d", "r", "place", "hot"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, hot = None, None  # rows of the last sample; the last sample, once it is hot
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if waiting is not None:
                table = pa.concat_tables([waiting, table])
                waiting = None
            s = table.column("s").to_numpy()
            if hot is not None and len(s):
                n = int(np.searchsorted(s, hot, side="right"))
                if n:
                    yield flagged(table.slice(0, n), True)
                    table, s = table.slice(n), s[n:]
                if len(s):
                    hot = None
            if not len(s):
                continue
            d = table.column("d").to_numpy()
            first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            sizes = np.diff(np.append(first, len(s)))
            several = np.minimum.reduceat(d, first) < np.maximum.reduceat(d, first)
            many = several & (sizes > split_rows)
            last = int(first[-1])
            if many[-1]:
                hot = s[-1]
                yield flagged(table.slice(last), True)
            else:
                waiting = table.slice(last)
            # All samples but the last are complete.
            for which, mark in ((several & ~many, False), (many, True)):
                rows = np.flatnonzero(np.repeat(which[:-1], sizes[:-1]))
                if len(rows):
                    yield flagged(table.take(pa.array(rows)), mark)
        if waiting is not None:
            d = waiting.column("d").to_numpy()
            if d.min() < d.max():
                yield flagged(waiting, False)

    return found.repartition("s").sortWithinPartitions("s").mapInArrow(keep, "d long, r long, place long, hot boolean")


def contexts(full: DataFrame, text: str, places: DataFrame, length: int, seed: int, how: str = "left") -> DataFrame:
    """(s, d, r, place, lo, hi, context) for the shared samples ``places(d, r, place)``.

    The context is the bytes around the sample that windows through it can reach; ``lo`` to ``hi``
    lie inside the document.
    """
    reach = length - seed
    by_doc = places.groupBy(F.col("d").alias("pd"), F.col("r").alias("pr")).agg(F.collect_set("place").alias("places"))
    joined = full.join(by_doc, (F.col("d") == F.col("pd")) & (F.col("r") == F.col("pr")), how)
    joined = joined.withColumn("data", F.encode(whole(F.col(text)), "UTF-8"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in np.flatnonzero(batch.column("places").is_valid().to_numpy(zero_copy_only=False)).tolist():
                data = np.frombuffer(batch.column("data")[i].as_buffer(), dtype=np.uint8)
                place = batch.column("places")[i].values.to_numpy()
                at = place[:, None] + np.arange(-reach, length)
                inside = (at >= 0) & (at < len(data))
                context = np.where(inside, data[at.clip(0, len(data) - 1)], 0).astype(np.uint8)
                sample = rolling(_BYTES[context[:, reach : reach + seed]].T, seed)[0].view(np.int64)
                n, width = len(place), reach + length
                offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
                packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(context.tobytes())])
                ids = [pa.array(np.full(n, batch.column(c)[i].as_py(), dtype=np.int64)) for c in ("d", "r")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sample), *ids, pa.array(place), pa.array(inside.argmax(axis=1).astype(np.int32)),
                     pa.array((width - inside[:, ::-1].argmax(axis=1)).astype(np.int32)), packed],
                    ["s", "d", "r", "place", "lo", "hi", "context"],
                )

    kinds = "s long, d long, r long, place long, lo int, hi int, context binary"
    # All columns go along: Spark would else cut the texts' other columns off and send them twice.
    return joined.mapInArrow(cut, kinds)


def _spans_of(batch: pa.Table, length: int, reach: int) -> pa.RecordBatch:
    """(d, r, a, b): bytes that suffixes of smaller documents in the same samples cover."""
    n = batch.num_rows
    column = batch.column("context").combine_chunks()
    data, _ = _buffers(column)
    windows = rolling(_BYTES[data.reshape(n, -1).T], length).T  # one column per start before the sample
    starts = np.arange(windows.shape[1])
    lo, hi, d, r, place = (batch.column(c).to_numpy() for c in ("lo", "hi", "d", "r", "place"))
    inside = (starts >= lo[:, None]) & (starts + length <= hi[:, None])
    row, start = np.nonzero(inside)
    key = windows[row, start] + start.astype(np.uint64) * np.uint64(_MULTIPLIER)
    order = np.argsort(key)
    first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else np.empty(0, np.int64)
    hit = np.zeros((n, windows.shape[1] + 2), dtype=np.int8)
    if len(key):
        least = np.repeat(np.minimum.reduceat(d[row[order]], first), np.diff(np.append(first, len(key))))
        taken = order[least < d[row[order]]]
        hit[row[taken], start[taken] + 1] = 1
    edge = np.diff(hit, axis=1)
    at, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    base = place[at] - reach
    return pa.RecordBatch.from_arrays(
        [pa.array(d[at]), pa.array(r[at]), pa.array(base + a), pa.array(base + b - 1 + length)], ["d", "r", "a", "b"]
    )


def suffix_spans(found: DataFrame, length: int, seed: int) -> DataFrame:
    """(d, r, a, b) from the contexts of samples of few places: a sample is in one task."""
    reach = length - seed

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held_back is not None:
                table = pa.concat_tables([held_back, table])
            s = table.column("s").to_numpy()
            cut = int(np.searchsorted(s, s[-1])) if len(s) else 0
            held_back = table.slice(cut)
            for at in range(0, cut, 1 << 14):
                # Cut between samples only.
                a = int(np.searchsorted(s, s[at])) if at else 0
                b = cut if at + (1 << 14) >= cut else int(np.searchsorted(s, s[at + (1 << 14)]))
                if b > a:
                    yield _spans_of(table.slice(a, b - a), length, reach)
        if held_back is not None and held_back.num_rows:
            yield _spans_of(held_back, length, reach)

    kinds = "d long, r long, a long, b long"
    return found.repartition("s").sortWithinPartitions("s").mapInArrow(runs, kinds)


def hot_spans(found: DataFrame, length: int, seed: int) -> DataFrame:
    """The same for samples of many places, a row per suffix: combined before the shuffle, its join can be split."""
    each = found.select("d", "r", "place", "context", F.explode(F.expr(f"sequence(lo, hi - {length})")).alias("at"))
    suffix = F.substring("context", F.col("at") + 1, F.lit(length))
    each = each.select(
        "d", "r", (F.col("place") - (length - seed) + F.col("at")).alias("a"),
        F.xxhash64("at", suffix).alias("w1"), F.xxhash64(F.lit(1), "at", suffix).alias("w2"),
    )
    least = each.groupBy(F.col("w1").alias("v1"), F.col("w2").alias("v2")).agg(F.min("d").alias("least"))
    met = each.join(least, (F.col("w1") == F.col("v1")) & (F.col("w2") == F.col("v2"))).where("least < d")
    return met.select("d", "r", "a", (F.col("a") + length).alias("b"))


def without_repeats(
    docs: DataFrame,
    key: str,
    text: str,
    length: int = LENGTH,
    period: int = PERIOD,
    seed: int = SEED,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``docs`` plus ``kept`` (the bytes that remain) and ``spans`` (removed runs, a to b, in order).

    A byte goes when a string of ``length`` bytes over it also starts in a document with a smaller
    key. Texts are UTF-8 bytes; null is empty. Null keys count as the largest. Rows of one key do
    not remove from each other; repeated rows are treated alike. Texts shorter than ``length``
    stay. Keys must be whole numbers. Other columns stay; of the new names, ``kept`` and ``spans``
    are replaced where they exist. An empty table gives no rows. Strings are compared by 64 bits of
    hash beside their sample's, phrases by 128.
    """
    shipped(docs.sparkSession)
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key} must hold whole numbers")
    docs = docs.drop("kept", "spans")
    names = docs.columns
    order: Column = F.coalesce(docs[key].cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(order.alias("d"), F.encode(whole(docs[text]), "UTF-8").alias("data"))
    rows = rows.select("d", F.xxhash64("data").alias("r"), "data")

    phrases = written(parse(rows, length, period), "phrases")
    least = phrases.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")).agg(F.min("d").alias("least"))
    repeated = phrases.join(least, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).where("least < d")
    repeated = written(repeated.select("d", "r", "a", "b"), "repeated")

    # The same columns meet the places and, later, the spans, so that Spark sends the texts once.
    full = docs.select(
        *[docs[c].alias(f"c{i}") for i, c in enumerate(names)], order.alias("d"),
        F.xxhash64(F.encode(whole(docs[text]), "UTF-8")).alias("r"),
    )
    body = f"c{names.index(text)}"
    places = written(shared(samples(full, body, repeated, length, seed), split_rows), "samples")
    cold, hot = places.where("NOT hot"), places.where("hot")
    spans = suffix_spans(contexts(full, body, cold, length, seed), length, seed).unionByName(repeated)
    if not hot.isEmpty():
        found = written(contexts(full, body, hot, length, seed, "inner"), "hot_contexts")
        spans = spans.unionByName(hot_spans(found, length, seed))
    # Rows of equal key and text have the same spans, which are one set.
    by_doc = spans.groupBy(F.col("d").alias("sd"), F.col("r").alias("sr")).agg(F.collect_set(F.struct("a", "b")).alias("found"))
    joined = full.join(by_doc, (F.col("d") == F.col("sd")) & (F.col("r") == F.col("sr")), "left")
    joined = joined.withColumn("data", F.encode(whole(F.col(body)), "UTF-8"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for value, found in zip(batch.column("data"), batch.column("found")):
                value = value.as_buffer().to_pybytes()
                if not found.is_valid:
                    kept.append(value)
                    removed.append([])
                    continue
                a, b = found.values.field("a").to_numpy(), found.values.field("b").to_numpy()
                by_start = np.argsort(a, kind="stable")
                a, b = a[by_start], np.maximum.accumulate(b[by_start]) if len(b) else b
                head = np.append(True, a[1:] > b[:-1]) if len(a) else np.empty(0, bool)
                begins, ends = a[head], b[np.append(head[1:], True)] if len(a) else b
                kept.append(b"".join(value[x:y] for x, y in zip([0, *ends], [*begins, len(value)])))
                removed.append([{"a": int(x), "b": int(y)} for x, y in zip(begins, ends)])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f"c{i}") for i in range(len(names))], pa.array(kept, pa.binary()),
                 pa.array(removed, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                [*[f"c{i}" for i in range(len(names))], "kept", "spans"],
            )

    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    out = joined.mapInArrow(cut, f"{kinds}, kept binary, spans array<struct<a:long,b:long>>")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "kept", "spans")
