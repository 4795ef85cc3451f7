"""Removal of lines that an earlier document has, by two Bloom filters.

A line's hash that comes up first enters the filter of hashes seen once; one that is found there
enters the filter of hashes seen twice. The first filter is cut into segments of the hash space, each
filled in one task from 8-byte hashes and dropped with it. Only the second goes back to the documents,
as one table of a fixed size. Lines that it lets pass are suspected repeats; they alone are shuffled as
text, where equal lines are counted exactly and the first document is chosen. A full filter lets more
lines pass and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from docsieve.llm.common import lower_ascii, shipped, whole, written

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
LEAST_CHARS = 10
TWICE_WORDS = 1 << 21  # 16 MB of bits, whatever the input
ONCE_WORDS = 1 << 18  # 2 MB of bits for each segment of hashes seen once
SEGMENTS = 1 << 10
PROBES = 4


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _bits(hashes: np.ndarray, n_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, mask) of each probe."""
    a = hashes.view(np.uint64)
    b = (a ^ (a >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    b = (b ^ (b >> np.uint64(29))) | np.uint64(1)
    for i in range(PROBES):
        bit = (a + np.uint64(i + 1) * b) >> np.uint64(17)
        yield ((bit >> np.uint64(6)) % np.uint64(n_words)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold."""
    found = np.ones(len(hashes), dtype=bool)
    for word, mask in _bits(hashes, len(table)):
        found &= (table[word] & mask) != 0
    return found


def put(table: np.ndarray, hashes: np.ndarray) -> None:
    for word, mask in _bits(hashes, len(table)):
        np.bitwise_or.at(table, word, mask)


def _segment(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(54)).astype(np.int32) % SEGMENTS


def twice_seen(hashes: DataFrame, n_words: int = TWICE_WORDS) -> np.ndarray:
    """The filter of the values of ``hashes(h)`` that occur at least twice, as 64-bit words.

    A batch sends each of its hashes once, marked if the batch has it again, so that a hash of a third
    of all rows costs a row per batch. The driver receives the words that are not zero.
    """
    shipped(hashes.sparkSession)

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = np.unique(batch.column("h").to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_segment(h)), pa.array(h), pa.array(n > 1)], ["segment", "h", "again"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by segment; the table of hashes seen twice is the task's own share of the whole.
        once, at, twice = np.zeros(ONCE_WORDS, dtype=np.uint64), None, np.zeros(n_words, dtype=np.uint64)
        for batch in batches:
            segment, h, again = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("segment", "h", "again"))
            cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(h) else []
            for a, b in zip(cuts, [*cuts[1:], len(h)]):
                if segment[a] != at:
                    at = segment[a]
                    once[:] = 0
                mine, n = np.unique(h[a:b], return_counts=True)
                put(twice, np.concatenate([mine[(n > 1) | has(once, mine)], h[a:b][again[a:b]]]))
                put(once, mine)
        word = np.flatnonzero(twice)
        if len(word):
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(twice[word].view(np.int64))], ["word", "mask"])

    sent = hashes.select("h").mapInArrow(different, "segment int, h long, again boolean")
    filled = sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(fill, "word long, mask long")
    rows = filled.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(n_words, dtype=np.uint64)
    table[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return table


def suspected(lines: DataFrame, table: np.ndarray) -> DataFrame:
    """The rows of ``lines(h, ...)`` whose hash the filter lets pass."""
    shared = lines.sparkSession.sparkContext.broadcast(table)

    @pandas_udf("boolean")
    def passes(h: pd.Series) -> pd.Series:
        return pd.Series(has(shared.value, h.to_numpy(np.int64)))

    return lines.where(passes("h"))


@pandas_udf(StringType())
def _without(text: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for value, gone in zip(text, dropped):
        if value is None:
            out.append(None)
            continue
        left = value.split("\n")
        gone = set(gone.tolist())
        # A document all of whose lines go is left without text.
        out.append("\n".join(line for i, line in enumerate(left) if i not in gone))
    return pd.Series(out, dtype=object)


def without_repeated_lines(
    docs: DataFrame, key: str, text: str, least_chars: int = LEAST_CHARS, n_words: int = TWICE_WORDS
) -> DataFrame:
    """``docs`` plus ``kept`` (the text that remains), ``n_lines`` (before) and ``n_dropped``.

    Lines lie between line feeds; a null or empty text is one empty line. Lines equal but for blanks at
    their ends and the case of A-Z are one line. One of ``least_chars`` code points or more that several
    documents have stays only in that of smallest key, there as often as it stands. Null keys are one
    document, the last; rows of one key are one document as well and do not lose lines to each other.
    Very long texts and lines are treated like others. Repeated rows are all returned. Other columns
    stay; existing columns of the three new names are replaced. An empty table gives no rows.
    """
    shipped(docs.sparkSession)
    docs = docs.drop(*[c for c in ("kept", "n_lines", "n_dropped") if c not in (key, text)])
    names = docs.columns
    # The rows travel as one column, so that no name of theirs can clash; the text is in it once.
    rows = docs.select(
        docs[key].alias("d"), F.xxhash64(whole(docs[text])).alias("r"),
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)]).alias("row"),
    )
    told = whole(F.col(f"row.c{names.index(text)}"))
    each = rows.select("d", "r", F.posexplode(F.split(told, "\n", -1)).alias("i", "line"))
    lines = each.select("d", "r", "i", line_key(F.col("line")).alias("k")).where(F.length("k") >= least_chars)
    lines = lines.withColumn("h", F.xxhash64("k"))
    doubtful = written(suspected(lines, twice_seen(lines, n_words)).drop("h"), "suspected_lines")
    # The smallest key comes before null; a line of one document only has no smaller one.
    first = doubtful.groupBy("k").agg(
        F.min("d").alias("first"), F.max("d").alias("last"), F.count_if(F.col("d").isNull()).alias("nulls")
    )
    first = written(first.where("first < last OR nulls > 0 AND first IS NOT NULL").select(F.col("k").alias("fk"), "first"), "first_lines")
    gone = doubtful.join(first, F.col("k") == F.col("fk")).where(~F.col("d").eqNullSafe(F.col("first")))
    # Rows of equal key and text drop the same lines, so their places are one set.
    gone = gone.groupBy(F.col("d").alias("gd"), F.col("r").alias("gr")).agg(F.collect_set("i").alias("gone"))
    joined = rows.join(gone, F.col("d").eqNullSafe(F.col("gd")) & (F.col("r") == F.col("gr")), "left")
    left = _without(F.when(F.col("gone").isNotNull(), told), F.col("gone"))
    return joined.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)],
        F.coalesce(left, told).alias("kept"),
        (F.regexp_count(told, F.lit("\n")) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
