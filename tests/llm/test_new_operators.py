"""Collocations, prefix trie and line removal against plain Python, with nulls, ties, repeats and odd names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsieve.llm import collocations, linededup, prefixtrie
from tests.llm.brute import LOWER

CLASH = "k string, h long, n long, d int, r int, first int, kind int, kept int, row int, path string, gone int"


def clashing(df):
    for column in CLASH.split(", "):
        name, kind = column.split()
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df.repartition(3)


# Collocations


def best_phrases(rows, least, top):
    pieces = defaultdict(list)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            if words:
                pieces["und" if lang is None else lang].append(words)
    out = []
    for lang, of in pieces.items():
        f = Counter(tuple(w[i : i + k]) for w in of for k in (1, 2, 3) for i in range(len(w) - k + 1))
        n = sum(len(w) for w in of)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in candidates.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:c]] * f[p[c:]]), c) for c in range(1, len(p))]
            score, c = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:c]], f[p[c:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrases():
    rng = random.Random(4)
    words = ["new", "york", "city", "hall", "é", "the", "The", "of", "a'b", "x\x0by"]
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choice(words) + rng.choice(["", "", ".", ",\t", "\n"]) for _ in range(rng.randint(0, 60))))
            for _ in range(120)]
    rows += [("en", None), ("en", ""), ("en", " . ,\n"), (None, "New York City " * 3000), ("und", "new york"), ("en", "a b " * 40)]
    return rows + rows[:5] + [("fr", "lone words only once")]


@pytest.mark.parametrize("trie_phrases, filter_words", [(0, 1), (3, 1 << 10), (1 << 10, 1 << 10)])
def test_collocations(spark, monkeypatch, trie_phrases, filter_words):
    rows = phrases()
    docs = clashing(spark.createDataFrame(rows, "lang string, text string"))
    found = collocations.collocations(docs, "text", "lang", least=3, top=15, trie_phrases=trie_phrases, filter_words=filter_words)
    assert sorted(tuple(r) for r in found.collect()) == best_phrases(rows, 3, 15)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty, "text", "lang").count() == 0
    rare = spark.createDataFrame([("en", "all of these words are rare")], "lang string, text string")
    assert collocations.collocations(rare, "text", "lang").count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a = 3_000_000_007
    row = spark.range(1).selectExpr(f"{a}L AS a", f"{a + 5}L AS l", f"{a + 9}L AS r")
    got = row.selectExpr(collocations._exact("score", "a", "l", "r")).first()["score"]
    assert got == 1_000_000 * a * a // ((a + 5) * (a + 9))


def test_trie_accepts_its_phrases_and_no_others():
    rng = np.random.default_rng(2)
    words = rng.integers(1, 1 << 62, 300, dtype=np.uint64)
    # One word begins very many phrases.
    pairs = {(words[0], w, np.uint64(0)) for w in words} | {(words[int(rng.integers(300))], words[int(rng.integers(300))], np.uint64(0)) for _ in range(900)}
    triples = {(words[int(rng.integers(5))], words[int(rng.integers(20))], words[int(rng.integers(300))]) for _ in range(2000)}
    every = np.array(sorted(pairs | triples), dtype=np.uint64)
    trie = collocations.Trie(every)
    known = {tuple(p) for p in every.tolist()}
    text = type("Text", (), {})()
    text.hash = rng.choice(np.concatenate([words[:25], rng.integers(1, 1 << 62, 5, dtype=np.uint64)]), 5000)
    text.joined = rng.random(4999) < 0.9
    two, three = trie.accepted(type("W", (), {"__len__": lambda self: 5000, "hash": text.hash, "joined": text.joined})())
    for i in range(4998):
        pair = (int(text.hash[i]), int(text.hash[i + 1]), 0)
        assert (two[i] >= 0) == (bool(text.joined[i]) and pair in known)
        assert two[i] < 0 or tuple(every[two[i]].tolist()) == pair
        triple = (*pair[:2], int(text.hash[i + 2]))
        assert (three[i] >= 0) == (bool(text.joined[i] and text.joined[i + 1]) and triple in known)


# Prefix trie


def nodes_of(rows, group=5, spread=9):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % spread
        paths[c] = own.get(c - c % group, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks():
    rng = random.Random(8)
    rows = []
    for conv in range(140):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 12])):
            rows.append((conv, turn, ["user", "assistant", None][turn % 3], rng.choice(["hi", "hello é", "", None, "why?"]) if turn < 3 else f"t{rng.randint(0, 2)}"))
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1400, 5) for t in range(4)]
    rows += [(7, None, "user", "before all"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (None, 0, "user", "nowhere"), (3, 500, "a", "x" * 50_000)]
    rows += [(2000, t, "user", f"deep {t}") for t in range(400)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [1, 7, 100, 1 << 20])
def test_prefix_trie(spark, monkeypatch, shard_turns):
    rows = talks()
    monkeypatch.setattr(prefixtrie, "ENDS_CHARS", 64)
    turns = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = prefixtrie.trie(prefixtrie.rebuilt(turns, "conv_id", "turn", "role", "text"), shard_turns)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == nodes_of(rows)


def test_prefix_trie_of_nothing(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefixtrie.trie(prefixtrie.rebuilt(turns, "conv_id", "turn", "role", "text")).count() == 0


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_find_close(block):
    rng = random.Random(block)
    signs, depth = [1], 1
    while depth:
        step = 1 if len(signs) < 3000 and rng.random() < 0.52 else -1
        signs.append(step)
        depth += step
    stack, close = [], {}
    for i, s in enumerate(signs):
        if s == 1:
            stack.append(i)
        else:
            close[stack.pop()] = i
    signs = np.array(signs)
    opens = np.flatnonzero(signs == 1)
    found = prefixtrie.find_close(np.cumsum(signs, dtype=np.int32), opens, block)
    assert found.tolist() == [close[i] for i in opens.tolist()]


# Lines


def kept_lines(rows):
    strip = "\x20\x09\x0a\x0b\x0c\x0d"
    order = lambda d: (d is None, d or 0)
    key = lambda line: line.strip(strip).translate(LOWER)
    first = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), order(d)), order(d))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == order(d)]
        out.append((d, text, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


LINES = [
    (1, "A line of some length\nshort\nanother line of length\n"), (2, "short\n  a LINE of some length \r\nits own line here"),
    (2, "its own line here\nand more of that kind"), (3, "its own line here\nits own line here\n\n"), (None, "its own line here"),
    (None, "only among nulls, twice"), (None, "only among nulls, twice"), (4, None), (5, ""), (6, "\n"), (7, "É accented line here\nonce"),
    (8, "é accented line here"), (9, "\n".join(f"numbered line {i % 300}" for i in range(3000))), (10, "numbered line 7\n" + "long " * 40_000),
    (11, "ninechars\nten chars."), (12, "ninechars\nten chars."), (12, "ninechars\nten chars."), (13, "a line of some length"),
]


@pytest.mark.parametrize("n_words", [1, 1 << 12])
def test_line_dedup(spark, n_words):
    docs = clashing(spark.createDataFrame(LINES, "doc_id long, text string"))
    cut = linededup.without_repeated_lines(docs, "doc_id", "text", n_words=n_words)
    assert set(cut.columns) == {*docs.columns, "kept", "n_lines", "n_dropped"}
    got = cut.select("doc_id", "text", "kept", "n_lines", "n_dropped").collect()
    assert sorted((tuple(r) for r in got), key=repr) == kept_lines(LINES)


def test_line_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert linededup.without_repeated_lines(empty, "doc_id", "text").count() == 0


def test_filter_of_twice_seen_hashes_lets_few_others_pass(spark):
    lines = spark.range(30_000).selectExpr("xxhash64(id % 20000) AS h", "id").repartition(5)
    table = linededup.twice_seen(lines, 1 << 14)
    passed = {r["id"] for r in linededup.suspected(lines, table).select("id").collect()}
    again = {i for i in range(30_000) if i % 20_000 < 10_000}
    assert again <= passed and len(passed) < len(again) + 200
