"""Collocations: phrases of two and three words that stand together more often than their parts suggest.

Words are 64-bit hashes of language and bytes. One pass counts the words and finds phrases that some
stretch of text repeats. The most repeated of these (at most ``TRIE_PHRASES``) become a double-array trie
over words, which is broadcast. In the next pass the states of all text positions are advanced through the
trie together, a level a step, and the accepting states are counted; the counts of all tasks are summed.

A table grows more frequent phrases than one trie may hold, so phrases outside the trie are counted exactly
as well, by summing over what the tasks have seen, level by level: of two words where both words are
frequent enough, of three where both pairs are. These tests use filters of a fixed size, which may let too
much pass and never too little. Which phrases the trie holds decides how much is shuffled, not what comes out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsieve.llm.common import shipped, whole, written
from docsieve.llm.linededup import has, put

LEAST = 10  # occurrences of a candidate
TOP = 2000
TRIE_PHRASES = 1 << 17
FILTER_WORDS = 1 << 21  # 16 MB of bits
REPEATED = 4  # times in one stretch that propose a phrase for the trie
_AT_ONCE = 1 << 21  # bytes of text worked on together
_HASHED = 1 << 19  # bytes hashed together
_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)
# Kinds of bytes: 0 in a word, 1 blank between words, 2 end of a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power(multiplier: int, n: int) -> np.ndarray:
    have = _powers.get(multiplier)
    if have is None or len(have) < n:
        size = max(n, _HASHED)
        have = np.full(size, multiplier, dtype=np.uint64)
        have[0] = 1
        have = _powers[multiplier] = np.cumprod(have)
    return have[:n]


def mixed(*hashes: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several in order."""
    out = np.zeros(len(hashes[0]), dtype=np.uint64)
    for h in hashes:
        out = (out + h.view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges in order, the same wherever the bytes lie; some words at a time to save memory."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(int(np.searchsorted(end, start[i] + _HASHED, side="right")), i + 1)
        a, b = int(start[i]), int(end[j - 1])
        sums = np.append(np.uint64(0), np.cumsum(_BYTES[data[a:b]] * _power(_MULTIPLIER, b - a)))
        back = _power(pow(_MULTIPLIER, -1, 1 << 64), b - a)
        out[i:j] = (sums[end[i:j] - a] - sums[start[i:j] - a]) * back[start[i:j] - a]
        i = j
    return out


class Words:
    """The words of a stretch of documents: where they lie, their hashes, and which follow each other in a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray):
        self.data = data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
        before[edges], after[edges - 1] = False, False
        self.start, self.end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.owner = np.searchsorted(offsets, self.start, side="right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        self.joined = (piece[1:] == piece[:-1]) & (self.owner[1:] == self.owner[:-1])
        h = _hashes(data, self.start, self.end)
        self.hash = mixed(h, (self.end - self.start).astype(np.uint64), lang[self.owner].view(np.uint64))

    def __len__(self) -> int:
        return len(self.start)

    def pairs(self) -> np.ndarray:
        """Places of words with a next word in the same piece."""
        return np.flatnonzero(self.joined)

    def triples(self) -> np.ndarray:
        return np.flatnonzero(self.joined[:-1] & self.joined[1:]) if len(self.joined) else np.empty(0, np.int64)


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[Words, pa.Array]]:
    """The words of whole documents, some megabytes of text at a time, and the documents' languages."""
    column = batch.column("data").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    lang = batch.column("lh").to_numpy()
    i = 0
    while i < len(column):
        j = max(int(np.searchsorted(offsets, offsets[i] + _AT_ONCE, side="right")) - 1, i + 1)
        yield Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lang[i:j]), batch.column("lang").slice(i, j - i)
        i = j


def tallied(words: Words, at: np.ndarray, n_words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The different phrases at the places ``at`` as word hashes, and how often they occur there."""
    parts = [words.hash[at + i] for i in range(n_words)]
    _, first, n = np.unique(mixed(*parts), return_index=True, return_counts=True)
    return [p[first] for p in parts], n


class Trie:
    """A double-array trie over word hashes; ``phrases`` are rows of two or three, 0 for no third word."""

    def __init__(self, phrases: np.ndarray):
        rng = np.random.default_rng(13)
        self.phrases = phrases
        self.vocabulary = np.unique(phrases[phrases != 0])
        size = len(self.vocabulary)
        self.base, self.check, self.accept = (np.full(size + 1, -1, dtype=np.int32) for _ in range(3))
        if not len(phrases):
            return
        codes = np.searchsorted(self.vocabulary, phrases).astype(np.int64)
        three = phrases[:, 2] != 0
        # The root is state 0; its children lie at 1 + code.
        self.base[0] = 1
        firsts = np.unique(codes[:, 0])
        self.check[1 + firsts] = 0
        state = 1 + codes[:, 0]
        state, child = self._placed(state, codes[:, 1], rng)
        two = np.flatnonzero(~three)
        self.accept[child[two]] = two
        third = np.flatnonzero(three)
        if len(third):
            _, child = self._placed(child[third], codes[third, 2], rng)
            self.accept[child] = third

    def _placed(self, parents: np.ndarray, codes: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        """Give all ``parents`` a base where the slots of their children are free; (parent, child) by row."""
        size = len(self.vocabulary)
        keys, inverse = np.unique(parents * np.int64(size) + codes, return_inverse=True)
        parent, code = keys // size, keys % size
        nodes, first, n = np.unique(parent, return_index=True, return_counts=True)
        low = len(self.check)
        room = size + 4 * len(keys)
        self._grow(low + room + size)
        slots = np.empty(len(keys), dtype=np.int64)
        for k in np.unique(n)[::-1].tolist():
            waiting = np.flatnonzero(n == k)
            mine = first[waiting][:, None] + np.arange(k)
            tries = 0
            while len(waiting):
                tries += 1
                if tries > 200:
                    # Too full for so many children: fresh space always fits.
                    low, room = len(self.check), size * len(waiting) + size
                    self._grow(low + room + size)
                    tries = 0
                base = low + rng.integers(0, room, len(waiting))
                at = base[:, None] + code[mine]
                # Among nodes that want one slot the first gets it.
                wanted, owner = np.unique(at.ravel(), return_index=True)
                got = np.zeros(at.size, dtype=bool)
                got[owner] = self.check[wanted] < 0
                good = got.reshape(at.shape).all(axis=1)
                slots[mine[good]] = at[good]
                node = nodes[waiting[good]]
                self.base[node] = base[good]
                self.check[at[good]] = node[:, None]
                waiting, mine = waiting[~good], mine[~good]
        return parent[inverse], slots[inverse]

    def _grow(self, size: int) -> None:
        for name in ("base", "check", "accept"):
            have = getattr(self, name)
            if len(have) < size:
                setattr(self, name, np.append(have, np.full(size - len(have), -1, dtype=np.int32)))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words that the trie knows, -1 for the others."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.searchsorted(self.vocabulary, hashes).clip(max=len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states behind ``state`` by ``code``, -1 where there is none."""
        to = np.where((state >= 0) & (code >= 0) & (self.base[state] >= 0), self.base[state] + code, 0)
        to = to.clip(max=len(self.check) - 1)
        return np.where((to > 0) & (self.check[to] == state), to, -1)

    def accepted(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """For every word, the phrase of two and of three words that begins there, -1 for none of the trie."""
        n = len(words)
        two, three = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        code = self.codes(words.hash)
        state = self.step(np.zeros(n, dtype=np.int64), code)
        for level, out in ((1, two), (2, three)):
            if n <= level:
                break
            going = np.where(words.joined[level - 1 :], state[: n - level], -1)
            state = self.step(going, code[level:])
            found = np.where(state >= 0, self.accept[state], -1)
            out[: n - level] = found
        return two, three


KINDS = "kind int, h1 long, h2 long, h3 long, n long, lang string, word string"
COUNTS = "kind int, h1 long, h2 long, h3 long, n long"


def _rows(kind: int, parts: list[np.ndarray], n: np.ndarray, lang=None, word=None) -> pa.RecordBatch:
    parts = [*parts, *[np.zeros(len(n), dtype=np.uint64)] * (3 - len(parts))]
    columns = [pa.array(np.full(len(n), kind, dtype=np.int32)), *[pa.array(p.view(np.int64)) for p in parts], pa.array(n.astype(np.int64))]
    names = ["kind", "h1", "h2", "h3", "n"]
    if lang is not None:
        return pa.RecordBatch.from_arrays([*columns, lang, word], [*names, "lang", "word"])
    return pa.RecordBatch.from_arrays(columns, names)


def words_and_repeats(texts: DataFrame) -> DataFrame:
    """Counts by stretch: every word (kind 1), and phrases that the stretch repeats (kinds 2 and 3)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, lang in stretches(batch):
                if not len(words):
                    continue
                h, first, n = np.unique(words.hash, return_index=True, return_counts=True)
                raw = words.data.tobytes()
                spelled = [raw[a:b] for a, b in zip(words.start[first].tolist(), words.end[first].tolist())]
                yield _rows(1, [h], n, lang.take(pa.array(words.owner[first])), pa.array(spelled, pa.binary()).cast(pa.string()))
                for kind, at in ((2, words.pairs()), (3, words.triples())):
                    parts, n = tallied(words, at, kind)
                    often = n >= REPEATED
                    none = pa.nulls(int(often.sum()), pa.string())
                    yield _rows(kind, [p[often] for p in parts], n[often], none, none)

    found = texts.mapInArrow(count, KINDS)
    return found.groupBy("kind", "h1", "h2", "h3", "lang", "word").agg(F.sum("n").alias("n"))


def proposed(repeats: DataFrame, most: int) -> np.ndarray:
    """The most repeated phrases, at most ``most``, as rows of three hashes."""
    steps = repeats.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().toArrow().sort_by([("n", "descending")])
    enough = np.cumsum(steps.column("count").to_numpy()) <= most
    if not enough.any():
        return np.empty((0, 3), dtype=np.uint64)
    least = int(steps.column("n").to_numpy()[enough][-1])
    rows = repeats.where(F.col("n") >= least).select("h1", "h2", "h3").toArrow()
    return np.stack([rows.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2", "h3")], axis=1)


def filter_of(phrases: DataFrame, n_parts: int, n_words: int = FILTER_WORDS) -> np.ndarray:
    """A Bloom filter of the mixed hashes of the first ``n_parts`` columns h1, h2, h3."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(n_words, dtype=np.uint64)
        for batch in batches:
            put(table, mixed(*[batch.column(i).to_numpy() for i in range(n_parts)]).view(np.int64))
        word = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(table[word].view(np.int64))], ["word", "mask"])

    parts = phrases.select("h1", "h2", "h3").mapInArrow(fill, "word long, mask long")
    rows = parts.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(n_words, dtype=np.uint64)
    table[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return table


def _passes(table: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    return has(table, mixed(*hashes).view(np.int64))


def counted_pairs(texts: DataFrame, trie: Trie, frequent: np.ndarray) -> DataFrame:
    """Counts of the trie's phrases, and of pairs outside it whose words both pass ``frequent``."""
    shared = texts.sparkSession.sparkContext.broadcast((trie, frequent))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, frequent = shared.value
        total = np.zeros(len(trie.phrases), dtype=np.int64)
        for batch in batches:
            for words, _ in stretches(batch):
                two, three = trie.accepted(words)
                for found in (two, three):
                    total += np.bincount(found[found >= 0], minlength=len(total))
                at = words.pairs()
                at = at[two[at] < 0]
                passes = _passes(frequent, words.hash)
                at = at[passes[at] & passes[at + 1]]
                if len(at):
                    yield _rows(2, *tallied(words, at, 2))
        for kind, which in ((2, trie.phrases[:, 2] == 0), (3, trie.phrases[:, 2] != 0)):
            some = np.flatnonzero(which & (total > 0))
            yield _rows(kind, [trie.phrases[some, i].copy() for i in range(3)], total[some])

    return texts.mapInArrow(count, COUNTS)


def counted_triples(texts: DataFrame, trie: Trie, pairs: np.ndarray) -> DataFrame:
    """Counts of phrases of three words outside the trie both pairs of which pass ``pairs``."""
    shared = texts.sparkSession.sparkContext.broadcast((trie, pairs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, pairs = shared.value
        for batch in batches:
            for words, _ in stretches(batch):
                at = words.triples()
                if not len(at):
                    continue
                passes = np.append(_passes(pairs, words.hash[:-1], words.hash[1:]), False)
                at = at[passes[at] & passes[at + 1]]
                _, three = trie.accepted(words)
                at = at[three[at] < 0]
                if len(at):
                    yield _rows(3, *tallied(words, at, 3))

    return texts.mapInArrow(count, COUNTS)


def _exact(score: str, a: str, left: str, right: str) -> str:
    # floor(1000000 * a * a / (l * r)); the products may need more than 64 bits.
    wide = lambda c: f"CAST({c} AS DECIMAL(38, 0))"
    return f"({wide(a)} * {wide(a)} * {wide(1_000_000)}) div ({wide(left)} * {wide(right)}) AS {score}"


def collocations(
    docs: DataFrame, text: str, lang: str, least: int = LEAST, top: int = TOP, trie_phrases: int = TRIE_PHRASES,
    filter_words: int = FILTER_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of each language.

    Texts are split at ``. , ; : ! ?`` and line ends, pieces at blanks; A-Z count as lower case. A phrase of
    two or three words counts wherever its words follow each other in a piece. Of the cuts of a phrase the one
    of lowest score counts, on ties the first. A pair inside a counted phrase of three words that occurs at
    least half as often is left out. Equal scores go by ``a``, then by the phrase's bytes. Null languages are
    ``und``, null texts empty; repeated rows count each time; texts of any length are read whole; other
    columns are not used. Tables without a phrase of ``least`` occurrences, or empty, give no rows. Words are
    told apart by 64 bits of hash, phrases by that of each word.
    """
    spark = docs.sparkSession
    shipped(spark)
    language = F.coalesce(docs[lang].cast("string"), F.lit("und"))
    texts = docs.select(
        language.alias("lang"), F.xxhash64(language).alias("lh"), F.encode(whole(docs[text]), "UTF-8").alias("data")
    )
    seen = written(words_and_repeats(texts), "words")
    words = seen.where("kind = 1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    often = words.where(F.col("n") >= least)
    trie = Trie(proposed(seen.where("kind > 1"), trie_phrases))
    summed = lambda df: (
        df.groupBy("kind", "h1", "h2", "h3").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    )
    found = written(summed(counted_pairs(texts, trie, filter_of(often, 1, filter_words))), "pairs")
    pairs = found.where("kind = 2").select("h1", "h2", F.col("n").alias("a"))
    rest = counted_triples(texts, trie, filter_of(found.where("kind = 2"), 2, filter_words))
    # A phrase is counted by the trie or by the sums, never by both.
    triples = found.where("kind = 3").unionByName(summed(rest)).select("h1", "h2", "h3", F.col("n").alias("a"))
    triples = written(triples, "triples")

    def named(df: DataFrame, i: int) -> DataFrame:
        word = often.select(F.col("h1").alias("_h"), F.col("lang").alias(f"lang{i}"), F.col("word").alias(f"w{i}"), F.col("n").alias(f"f{i}"))
        return df.join(word, df[f"h{i}"] == word["_h"]).drop("_h")

    two = named(named(pairs, 1), 2)
    inside = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    inside = inside.groupBy(F.col("h1").alias("i1"), F.col("h2").alias("i2")).agg(F.max("a").alias("longer"))
    two = two.join(inside, (two["h1"] == inside["i1"]) & (two["h2"] == inside["i2"]), "left")
    two = two.where("longer IS NULL OR 100 * longer < 50 * a")
    two = two.selectExpr("lang1 AS lang", "concat_ws(' ', w1, w2) AS phrase", "a", "f1 AS l", "f2 AS r", _exact("score", "a", "f1", "f2"))

    three = named(named(named(triples, 1), 2), 3)
    front = pairs.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("a").alias("f12"))
    back = pairs.select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("a").alias("f23"))
    three = three.join(front, (F.col("h1") == F.col("p1")) & (F.col("h2") == F.col("p2")))
    three = three.join(back, (F.col("h2") == F.col("q1")) & (F.col("h3") == F.col("q2")))
    three = three.selectExpr("*", _exact("s1", "a", "f1", "f23"), _exact("s2", "a", "f12", "f3"))
    three = three.selectExpr(
        "lang1 AS lang", "concat_ws(' ', w1, w2, w3) AS phrase", "a", "IF(s1 <= s2, f1, f12) AS l",
        "IF(s1 <= s2, f23, f3) AS r", "least(s1, s2) AS score",
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = two.unionByName(three).withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
