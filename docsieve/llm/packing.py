"""Best-fit packing of tokenised documents by minimum bin slack.

A sequence is filled by a subset-sum over the lengths still available: bit s of an integer says
that s tokens can be filled exactly. The fullest combination is taken out, and so on. Pieces of
one length are alike, so this needs only how many pieces there are of each length: at most
``capacity`` numbers, whatever the corpus. A combination is taken as often as its lengths last,
which gives the bins that taking it one by one would give. The pieces then find their places by
their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsieve.llm.common import group_offsets, shipped, spread_key, whole, written

CAPACITY = 1024
END_ID = 2
# Texts are encoded some at a time, so that ids of a whole batch are never held at once.
ENCODE_AT_ONCE = 64


# Names of special tokens that rank files leave out, with their ids.
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def encoder(path: str):
    """Texts to lists of ids; the file's kind is told by its ending. A special token's name in a text is that token."""
    if path.endswith(".tiktoken"):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        has_special = lambda t: any(name in t for name in SPECIAL)
        return lambda texts: [enc.encode(t, allowed_special="all") if has_special(t) else enc.encode_ordinary(t) for t in texts]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def pieces(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """(key, piece, start, length, ids_crc32): every document's ids and ``end``, cut where longer than ``capacity``.

    All pieces but the first have ``capacity`` ids. ``tokenizer`` is a file that all executors have.
    """
    shipped(docs.sparkSession)
    rows = docs.select(docs[key].alias("key"), whole(docs[text]).alias("text"))
    kind = pa.schema([pa.field("piece", pa.int32()), pa.field("start", pa.int64()),
                      pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_AT_ONCE):
                part = batch.slice(at, ENCODE_AT_ONCE)
                owner, out = [], []
                for row, ids in enumerate(encode(part.column("text").to_pylist())):
                    ids = np.array([*ids, end], dtype="<u4")
                    starts = range(len(ids) % capacity or capacity, len(ids), capacity)
                    for n, (a, b) in enumerate(zip([0, *starts], [*starts, len(ids)])):
                        owner.append(row)
                        out.append((n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out), kind)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(owner)), *columns], ["key", *kind.names]
                )

    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(cut, f"key {key_type}, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """(length, uses): the longest available length and what fills its bin best with it."""
    first = max(counts)
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    sums = 1
    steps: list[tuple[int, int, int]] = []  # length, uses allowed, sums reachable before it
    for length in sorted((x for x in counts if x <= room), reverse=True):
        uses = min(counts[length] - (length == first), room // length)
        if uses <= 0:
            continue
        steps.append((length, uses, sums))
        left, block = uses, 1
        while left:
            take = min(block, left)
            sums |= (sums << (take * length)) & mask
            left -= take
            block *= 2
        if sums >> room & 1:
            break
    best = sums.bit_length() - 1
    chosen = {first: 1}
    for length, uses, before in reversed(steps):
        n = next(n for n in range(uses + 1) if best >= n * length and before >> (best - n * length) & 1)
        if n:
            chosen[length] = chosen.get(length, 0) + n
            best -= n * length
    return sorted(chosen.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """(combination, times): all bins of the histogram ``length -> pieces``."""
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        combination = fullest(left, capacity)
        times = min(left[length] // uses for length, uses in combination)
        for length, uses in combination:
            left[length] -= uses * times
            if not left[length]:
                del left[length]
        out.append((combination, times))
    return out


def slots(bins: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, uses, first sequence, offset) for the pieces of each length."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for combination, times in bins:
        offset = 0
        for length, uses in combination:
            a = rank.get(length, 0)
            rank[length] = a + uses * times
            out.append((length, a, rank[length], uses, sequence, offset))
            offset += uses * length
        sequence += times
    return out


def pack(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, no sequence longer than ``capacity``.

    A null text is empty and takes one token, the end. Repeated rows are documents of their own.
    Null keys stay null; other columns are not used; an empty table gives no rows. The histogram,
    at most ``capacity`` rows, is the only thing that reaches the driver, and the slots made from
    it, at most a few per length, the only thing that is broadcast.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, key, text, tokenizer, capacity, end), "pieces")
    cut = cut.withColumn("block", spread_key(F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("piece")))
    blocks = cut.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        slots(plan(counts, capacity)), "slot_length long, low long, high long, uses long, first long, at long"
    )
    before = group_offsets(blocks, ["length"], "block", "n").drop("n")
    in_block = Window.partitionBy("length", "block").orderBy("key", "piece")
    ranked = cut.join(before, ["length", "block"]).withColumn(
        "rank", F.row_number().over(in_block) - 1 + F.col("before")
    )
    fits = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return ranked.join(F.broadcast(places), fits).select(
        "key", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("uses"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("uses") * F.col("length")).cast("long").alias("offset"),
    )
