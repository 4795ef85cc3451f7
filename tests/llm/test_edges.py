"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, by operator."""

import hashlib
import random
import re
import time
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docsieve.llm import components, fingerprints, htmltext, licenses, mixing, nearjoin, packing, quality, repeats, urls, warc
from docsieve.llm.common import n_words, whole
from docsieve.session import scratch_path
from tests.llm import brute

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(400)]
CLASH = "node int, n int, block string, d int, r int, size long, mix_size long, spans int, kept int, host string, piece int, _low string, before int, smaller int, mix_before int, sd long, found int, covered int, pd int, c0 int"


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


LONG = prose(9000, 1)
BASE = prose(120, 2)
PASSAGE = prose(70, 3)
TEXTS = [
    (5, BASE), (3, BASE), (3, BASE), (9, BASE + " one more word"), (None, BASE), (1, None), (2, ""), (4, " \t\n "),
    (7, LONG), (8, LONG[:40_000] + " changed " + LONG[40_000:]), (10, "Short é text"), (11, "short É text"), (12, "word"),
    (13, prose(60, 4) + " " + PASSAGE + " " + prose(50, 6)), (14, PASSAGE + "\n" + prose(80, 7)), (15, "é" * 60), (16, "x" + "é" * 55),
    (17, "a" * 300), (18, "b" + "a" * 120), (None, None),
]


def frame(spark, rows, extra=True):
    docs = spark.createDataFrame([(k, t, "src" if (k or 0) % 2 else None, "en") for k, t in rows],
                                 "doc_id long, text string, source string, lang string")
    if extra:
        for column in CLASH.split(", "):
            name, kind = column.split()
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.repartition(3)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string")


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_near_groups(spark, k, percent):
    rng = random.Random(k)
    more = []
    for i in range(40):
        w = prose(rng.choice([6, 12, 40, 90]), i % 9).split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        more.append((100 + i, " ".join(w)))
    rows = TEXTS + more
    found = nearjoin.near_groups(frame(spark, rows), "doc_id", "text", k=k, percent=percent, counters=64, tile_rows=3)
    got = sorted((tuple(r) for r in found.drop("text_hash").collect()), key=repr)
    assert got == sorted(brute.groups(rows, k, percent), key=repr)
    assert nearjoin.near_groups(empty(spark), "doc_id", "text").count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == root


def test_rounds_of_components_write_files_by_their_edges(spark):
    edges = spark.range(1, 3000).select(F.col("id").alias("a"), (F.col("id") - F.least(F.col("id") % 5, F.lit(1))).alias("b"))
    settings = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = components.components(edges)
        rows = found.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {tuple(r) for r in rows} == {(i, i - i % 5) for i in range(3000)} and len(rows) == 3000
    assert len(found.inputFiles()) <= 12


def test_components_that_are_stars_need_no_round(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(components, "_large_star", lambda edges, f=components._large_star: rounds.append(1) or f(edges))
    stars = [(1, 2), (3, 1), (1, 3), (5, 4), (5, 5), (None, 4), (7, None)]
    found = components.components(spark.createDataFrame(stars, "a long, b long"))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)] and not rounds
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0 and not rounds
    found = components.components(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(i, 1) for i in range(1, 5)} and rounds


def test_a_round_of_components_reads_its_edges_eight_times_at_most(spark):
    edges = spark.createDataFrame([(2, 1), (3, 1), (3, 2), (5, 4), (6, 5)], "u long, v long")
    edges.write.parquet(path := scratch_path(spark, "round"))
    done = components._small_star(components._large_star(spark.read.parquet(path)))
    assert sorted(tuple(r) for r in done.collect()) == [(2, 1), (3, 1), (5, 4), (6, 4)]
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 8 and plan.count("Join Inner") <= 3


@pytest.mark.parametrize("split_rows", [20_000, 0])
def test_repeats(spark, split_rows):
    expected = sorted(
        ((k, t, kept, spans) for (k, t), (kept, spans) in zip(TEXTS, brute.repeats(TEXTS, 50))), key=repr
    )
    cut = repeats.without_repeats(frame(spark, TEXTS), "doc_id", "text", split_rows=split_rows)
    got = cut.select("doc_id", "text", "kept", "spans").collect()
    assert sorted(((r[0], r[1], bytes(r[2]), [tuple(s) for s in r[3]]) for r in got), key=repr) == expected
    assert repeats.without_repeats(empty(spark), "doc_id", "text").count() == 0


def test_repeats_with_many_null_keys(spark):
    """A third of the rows without a key, many of them alike, are no group of their own."""
    rows = [(None if i % 3 == 0 else i, f"{prose(12, i % 400)} {PASSAGE if i % 50 == 0 else ''}") for i in range(3000)]
    start = time.time()
    cut = repeats.without_repeats(frame(spark, rows), "doc_id", "text").select("doc_id", "text", "kept").collect()
    assert time.time() - start < 120
    expected = sorted(((k, t, kept) for (k, t), (kept, _) in zip(rows, brute.repeats(rows, 50))), key=repr)
    assert sorted(((r[0], r[1], bytes(r[2])) for r in cut), key=repr) == expected
    with pytest.raises(ValueError, match="whole numbers"):
        repeats.without_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"), "doc_id", "text")


def test_long_documents_are_parsed_in_stretches(monkeypatch):
    import numpy as np

    data = np.frombuffer(LONG.encode(), dtype=np.uint8)
    offsets = np.array([0, 100, 100, len(data)])
    whole_starts = repeats.phrase_starts(data, offsets, 50, 64)
    whole_places = repeats.sample_places(data, offsets, 50, 16)
    monkeypatch.setattr(repeats, "_AT_ONCE", 1000)
    monkeypatch.setattr(repeats, "_powers", [])
    assert (repeats.phrase_starts(data, offsets, 50, 64) == whole_starts).all()
    for a, b in zip(repeats.sample_places(data, offsets, 50, 16), whole_places):
        assert (a == b).all()


def test_repeats_across_the_edge_of_a_stretch(spark):
    edge = repeats._AT_ONCE
    long = "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyz ", k=edge + 500))
    # Passages that begin at, end at and lie across the edge; a stretch has places of its own.
    for n, (a, b) in enumerate([(edge - 30, edge + 40), (edge - 26, edge + 24), (edge - 5, edge + 200)]):
        cut = repeats.without_repeats(frame(spark, [(1, long[a:b]), (2, long)]), "doc_id", "text")
        assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in cut.collect()} == {1: [], 2: [(a, b)]}, n


def test_quality(spark):
    docs = frame(spark, [*TEXTS, (30, "a b c\n" * 40), (31, "x y\nx y\n \nz"), (32, "# * <b> & 100%")])
    found = quality.features(docs, "text")
    for r in found.collect():
        t, w = r["text"] or "", brute.words(r["text"])
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        lines = [x for x in t.split("\n") if brute.words(x)]
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        at = {}
        for i in range(len(w) - 2):
            at.setdefault(tuple(w[i : i + 3]), []).append(i)
        assert r["n_repeat_words"] == len({i + j for p in at.values() if len(p) > 1 for i in p for j in range(3)})
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (13, None), (7, 1)], "doc_id long, quality int")
    for use in (labels, labels.limit(0)):
        judged = quality.judged(found, use, "doc_id", "lang", F.col("quality") == 1).collect()
        assert len(judged) == 23
        for r in judged:
            assert r["kept"] == (not r["base_failed"])
    assert quality.judged(quality.features(empty(spark), "text"), labels, "doc_id", "lang", F.col("quality") == 1).count() == 0


def test_cutoffs_hold_their_risk(spark):
    """The exact bound, against a sum of binomial terms, and a cutoff that must not be admitted."""
    from math import comb

    frame_ = spark.createDataFrame([(n,) for n in (1, 50, 200, 900, 2000)], "n long")
    got = {r["n"]: r["k"] for r in frame_.withColumn("k", quality.most_losses(F.col("n"), 0.05, F.lit(0.001))).collect()}
    for n, k in got.items():
        cdf = lambda m: sum(comb(n, i) * 0.05**i * 0.95 ** (n - i) for i in range(m + 1))
        assert (k == -1 or cdf(k) <= 0.001) and cdf(k + 1) > 0.001
    rules = {"score": ("v", (1.0, 2.0, 3.0))}
    good = spark.range(3000).select(F.lit("en").alias("s"), (F.col("id") % 100 / 30).alias("v"))
    cut = quality.cutoffs(good, "s", rules, max_loss=0.15, error=0.05).first()
    assert cut["_cut_score"] == 3.0  # 2.0 would lose four in ten


def test_licenses(spark):
    rows = [
        (1, "Under the MIT License. under the mit license; Apache License, Version 2.0 cc by-nc 4.0"), (2, None), (3, ""),
        (4, "SPDX-License-Identifier: GPL-3.0-or-later"), (5, "Licensed under the GNU General Public License v3"),
        (None, "cc BY nc"), (4, "plain"), (4, "plain"), (6, "under the mitlicense"), (7, "Unter the mit license é under the mit licenseé"),
    ]
    found = licenses.scan(frame(spark, rows), "doc_id", "text").collect()
    assert len(found) == len(rows)
    by = {(r["key"], r["n_words"]): r for r in found}
    first = by[(1, 18)]
    assert (first["n_base"], first["first_word"], first["last_word"]) == (4, 0, 13)
    assert first["base_labels"] == "apache-2,cc-by-nc,mit" and "cc-by-nc-4" in first["labels"] and first["score"] == 1.0
    assert by[(2, 0)]["labels"] == "" and by[(2, 0)]["first_word"] is None and by[(3, 0)]["score"] == 0.0
    assert by[(4, 8)]["labels"] == "gpl-3" and by[(4, 8)]["n_base"] == 0
    assert by[(5, 8)]["labels"] == "gpl-3" and by[(5, 8)]["score"] == 0.8
    assert by[(None, 3)]["base_labels"] == "cc-by-nc"
    assert by[(6, 3)]["n_base"] == 0 and by[(7, 9)]["n_base"] == 0
    assert licenses.scan(empty(spark), "doc_id", "text").count() == 0


def spelled(pattern):
    """All texts that a rule's pattern matches."""
    out = [""]
    for kind, value in pattern:
        kind = str(kind)
        if kind == "LITERAL":
            parts = [chr(value)]
        elif kind == "IN":
            parts = [chr(c) for k, v in value for c in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1))]
        elif kind == "SUBPATTERN":
            parts = spelled(value[3])
        elif kind == "BRANCH":
            parts = [t for branch in value[1] for t in spelled(branch)]
        else:
            assert kind == "MAX_REPEAT" and value[:2] == (0, 1)
            parts = ["", *spelled(value[2])]
        out = [a + b for a in out for b in parts]
    return out


def test_every_match_passes_its_gate():
    for rule in licenses.RULES:
        # The grants before a name are alike and hold no keyword.
        pattern = rule.pattern.replace(licenses._GRANT, "licensed under ")
        for text in spelled(re._parser.parse(pattern)):
            marked = "".join(f" {i}:{w} " for i, w in enumerate(text.split()))
            assert re.fullmatch(licenses.regex(rule.pattern), marked), (rule, text)
            # The sentence of the GNU notices names no license; there the keyword is a condition of its own.
            assert rule.keyword == "gnu" or any(g in marked for g in licenses.gates(rule)), (rule, text)


def test_license_names_run_on(spark):
    texts = {
        "Licensed under the GPLv2": ("gpl-2", 0.8), "GPL3 license": ("gpl-3", 0.5), "released under LGPLv2.1": ("lgpl-2.1", 0.8),
        "the AGPLv3 licence": ("agpl-3", 0.5), "under Apache2: available under Apache2": ("apache-2", 0.8), "FreeBSD license": ("bsd-2-clause", 0.5),
        "Apache1.1 license": ("apache-1.1", 0.5), "LGPL3 license": ("lgpl-3", 0.5), "gplv": ("", 0.0),
    }
    rows = list(enumerate(texts))
    got = {r["key"]: (r["labels"], r["score"]) for r in licenses.scan(frame(spark, rows), "doc_id", "text").collect()}
    assert got == {i: texts[t] for i, t in rows}
    open_rules = [r._replace(gates=(":",)) for r in licenses.RULES]
    open_got = {r["key"]: (r["labels"], r["score"]) for r in licenses.scan(frame(spark, rows), "doc_id", "text", open_rules).collect()}
    assert open_got == got


def test_mixing(spark):
    docs = frame(spark, TEXTS + [(200 + i, prose(5 + i % 7, i)) for i in range(300)])
    sized = docs.withColumn("words", n_words(whole(F.col("text"))))
    a = mixing.copies(sized, "doc_id", "source", "words").select("doc_id", "source", "words", "mix_source_size", "mix_target", "mix_copies").collect()
    b = mixing.copies(sized.repartition(7), "doc_id", "source", "words").select("doc_id", "source", "words", "mix_source_size", "mix_target", "mix_copies").collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))
    total = sum(r["words"] for r in a)
    per = {}
    for r in a:
        per.setdefault(r["source"], [r["mix_target"], 0, r["mix_source_size"]])[1] += r["words"] * r["mix_copies"]
        assert 0 <= r["mix_copies"] <= 3
    assert abs(sum(t for t, _, _ in per.values()) - total) < 1e-6
    longest = max(r["words"] for r in a)
    assert all(abs(t - taken) <= longest and t <= 3 * size + 1e-9 for t, taken, size in per.values())
    assert per["src"][0] * 2 == pytest.approx(per[None][0]) or per[None][0] == 3 * per[None][2]
    assert mixing.mix(docs, "doc_id", "source", n_words(whole(F.col("text")))).columns == docs.columns
    assert mixing.mix(empty(spark), "doc_id", "source", n_words(whole(F.col("text")))).count() == 0


def test_targets_share_what_capped_sources_leave(spark):
    sizes = spark.createDataFrame([("a1", 10), ("a2", 1), ("a3", 200), ("a4", 0), ("b", 5)], "skey string, source_size long")
    got = {r["skey"]: r["target"] for r in mixing.targets(sizes).collect()}
    assert got["a2"] == 3 and got["a4"] == 0 and got["b"] == 15 and got["a1"] == 30
    assert sum(got.values()) == pytest.approx(216)


def plain_bins(lengths, capacity):
    """Number of bins when each takes the longest piece left and what fills it best, one bin at a time."""
    left = sorted(lengths, reverse=True)
    n = 0
    while left:
        n += 1
        first = left.pop(0)
        # Sums that can be reached, each by the pieces tried first: every longest one as often as it goes.
        reach = {0: ()}
        room = capacity - first
        for i, length in enumerate(left):
            for total, chosen in list(reach.items()):
                if total + length <= room and total + length not in reach:
                    reach[total + length] = (*chosen, i)
            if room in reach:
                break
        for i in sorted(reach[max(reach)], reverse=True):
            left.pop(i)
    return n


def test_packing(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path
    rows = TEXTS + [(300 + i, prose(20 + 37 * i % 900, i)) for i in range(120)]
    end = "<|endoftext|>"
    rows += [(500, f"hello {end} x"), (501, f"{end}a b"), (502, f"a b {end}"), (503, f"{end}{end} c\n{end}"), (504, "<|endof" + end), (505, end + "text|>")]
    packed = packing.pack(frame(spark, rows), "doc_id", "text", path("byte_bpe_50k.tiktoken")).collect()
    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    expected = []
    for k, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 or 1024
        edges = [0, *range(head, len(ids), 1024), len(ids)]
        for n, (a, b) in enumerate(zip(edges, edges[1:])):
            expected.append((k, n, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))))
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == sorted(expected, key=repr)
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-sum(r["length"] for r in packed) // 1024) * 1.02 + 1
    assert len(bins) == plain_bins([r["length"] for r in packed], 1024)
    assert packing.pack(empty(spark), "doc_id", "text", path("byte_bpe_50k.tiktoken")).count() == 0


def test_fullest_is_optimal():
    rng = random.Random(9)
    for _ in range(60):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(1, 7))}
        first, sums = max(counts), {0}
        for length, n in counts.items():
            for _ in range(n - (length == first)):
                sums |= {s + length for s in sums}
        best = max(s for s in sums if s + first <= 40) + first
        chosen = packing.fullest(counts, 40)
        assert sum(a * b for a, b in chosen) == best and all(counts[a] >= b for a, b in chosen)


PAGES = [
    (1, "http://a.example.net/en/1?utm_source=x", "<p>one</p>"), (2, "http://a.example.net/fr/1", "<p>one</p>"), (3, None, None),
    (4, "no scheme", ""), (5, "HTTP://WWW.Other.com/x/", "é" * 3000), (6, "https://other.com/x?utm_source=q", "<p>two"),
    (None, "http://x.org/fr/", "<p>one</p>"), (7, "http://x.org/fr/?b=2&a=1#f", "WARC/1.1\r\n\r\nbody\r\n\r\nWARC/1.1\r\n"), (7, "http://example.com", "<p>one</p>"),
]


def pages(spark):
    docs = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for column in CLASH.split(", "):
        name, kind = column.split()
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.repartition(2)


def test_warc(spark):
    for chunk in (1 << 20, 7):
        records = warc.record_table(pages(spark), "page_id", "url", "html", chunk=chunk)
        from docsieve.session import scratch_path

        chunks = warc.read(warc.write(records, scratch_path(spark, "warc")), chunk=chunk)
        got = warc.digests(chunks).collect()
        expected = []
        for k, _, html in PAGES:
            data = (html or "").encode()
            keys = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
            keeper = max(keys) if keys else None
            digest = warc.base32(hashlib.sha1(data).digest())
            name = lambda x: None if x is None else str(x)
            expected.append((name(k), len(data), digest, "response" if k == keeper else "revisit", None if k == keeper else name(keeper)))
        assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
        texts = {}
        for r in chunks.where("type = 'response'").collect():
            assert len(r["payload"]) <= chunk
            texts.setdefault((r["record"], r["declared_digest"]), {})[r["chunk"]] = bytes(r["payload"])
        for (_, digest), parts in texts.items():
            assert warc.base32(hashlib.sha1(b"".join(parts[i] for i in sorted(parts))).digest()) == digest
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.digests(warc.read(warc.archive(spark, none, "page_id", "url", "html"))).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow")], "host string, path string, verdict string")
    listed = spark.createDataFrame([("other.com/x",), ("other.com/x",), ("x.org/fr?a=1&b=2",)], "key string")
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(pages(spark), "url", rules, listed).collect()}
    assert got == {
        "http://a.example.net/en/1?utm_source=x": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://a.example.net/fr/1": ("a.example.net", "/fr/1", "net/", "block"),
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "HTTP://WWW.Other.com/x/": ("www.other.com", "/x/", None, "block"),
        "https://other.com/x?utm_source=q": ("other.com", "/x", None, "block"),
        "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
        "http://x.org/fr/?b=2&a=1#f": ("x.org", "/fr/", "org/fr/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
    }
    none = urls.judged(pages(spark), "url", rules.limit(0), listed.limit(0))
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert urls.judged(pages(spark).limit(0), "url", rules, listed).count() == 0


def test_a_filter_that_is_full_changes_nothing(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    listed = spark.range(500).select(F.concat(F.lit("h.com/"), F.col("id").cast("string")).alias("key"))
    seen = spark.range(1000).select(F.concat(F.lit("http://h.com/"), F.col("id").cast("string")).alias("url"))
    got = urls.judged(seen, "url", rules, listed, max_bytes=64)
    assert got.where("verdict = 'block'").count() == 500


SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="top"><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<div class="page"><div class="side-bar sidebar">Side</div><article class="post post-%d"><h1>Title &amp; %d</h1>
<p>One<br>two <a href="x">link</a> &lt;b&gt;.<p>Two   &#233;
 x &nbsp;y<ul><li>a<li>b</ul><script>if (a<b) {"</p>"}</script><!-- <p>no</p> --><form><input><p>no</form>
<div class="comments"><p>reader</div></article></div><aside>x</aside><footer>f</footer></body></html>"""


def test_main_text(spark):
    rows = [(i, f"http://a.com/{i}", SITE % (i, i)) for i in range(1, 5)]
    rows += [(9, None, None), (10, "http://b.org/", ""), (11, "http://b.org/x", "plain &eacute; <b>text</b>"), (4, "http://a.com/4", SITE % (4, 4)),
             (12, "http://c.org/", "<p>a</p><p>b <i>c</i></p>unclosed <b>x"), (13, "http://c.org/", "<div>" * 2000 + "deep" )]
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, page string"), "url", "page", ["page_id"]).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows)
    for i in range(1, 5):
        assert texts[i] == f"Title & {i}\n\nOne two link <b>.\n\nTwo é x y\n\na\n\nb"
    assert texts[9] == "" and texts[10] == "" and texts[11] == "plain é text"
    assert texts[12] == "a\n\nb c\n\nunclosed x" and texts[13] == "deep"


def test_consensus_beats_a_page_of_its_own():
    """Where a page's largest container is not the host's, the host's path is taken."""
    odd = '<body><div class="story"><p>short text</p></div><div class="pile"><p>' + "noise " * 50 + "</p></div></body>"
    assert htmltext.extract(odd).startswith("noise")
    assert htmltext.extract(odd, "/body/div.story") == "short text"


@pytest.mark.parametrize("tag", [
    """<p title='5" disk'>""", """<p class="x"">""", """<p title='a > b'>""", """<p title="it's > that">""", '<p title=5">', "<p it's>",
    """<p a = 'x"' b="'>"/>""", '<p a=">" ">', "<p a= >",
])
def test_quotes_in_a_tag_lose_no_text(tag):
    page = f'<body><div class="story"><p>before</p>{tag}inside</p><p class="z">after</p><p id="q">end</p></div></body>'
    assert htmltext.extract(page) == "before\n\ninside\n\nafter\n\nend"
    assert htmltext.extract(page.replace("</p><p class", "</p x='>'><p class")) == "before\n\ninside\n\nafter\n\nend"


def test_a_quote_without_end_opens_nothing():
    assert htmltext.extract("<div><p>a</p><p title='b>c</p><p>d</p></div>") == "a\n\nc\n\nd"


ARTICLE = "<p>" + "the story goes on " * 9 + "</p><p>and ends</p>"
STORY = ("the story goes on " * 9).strip() + "\n\nand ends"


@pytest.mark.parametrize("name", [
    'class="overflow-hidden"', 'class="has-sidebar"', 'class="no-comments"', 'id="content-with-menu"', 'class="page-header-fixed"',
    'class="md:hidden"', 'class="sidebar-left"', 'class="hidden"', 'class="menu"', 'id="comments"',
])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_a_wrapper_of_the_article_is_no_side_matter(name, inner):
    """Neither by a part of its name, nor by its name where it holds the article or most of the text."""
    page = f'<body><nav>n</nav><div {name}><{inner} class="x">{ARTICLE}</{inner}></div><p>bye</p></body>'
    assert htmltext.extract(page).startswith(STORY)
    assert any(p.size for p in htmltext.blocks(page)[1] if p.tag == inner and p.path.endswith(".x"))


@pytest.mark.parametrize("name", [
    'class="sidebar"', 'class="site-header"', 'id="cookie-notice"', 'class="main-menu"', 'id="sidebar-1"', 'class="entry-footer"',
    'class="visually-hidden"', 'class="siteFooter"', 'class="comments-area"', 'class="related-posts"',
])
def test_side_matter_goes(name):
    page = f'<body><div class="x">{ARTICLE}<div {name}><p>side matter</p></div></div></body>'
    assert htmltext.extract(page) == STORY


def test_long_comments_and_cards_are_no_article():
    talk = '<div class="comments"><article>' + "<p>I say so too</p>" * 99 + "</article></div>"
    cards = '<div class="widget"><article>a card</article><article>a card</article></div>'
    assert htmltext.extract(f"<body><article>{ARTICLE}</article>{talk}</body>") == STORY
    assert htmltext.extract(f"<body><article>{ARTICLE}{talk}</article></body>") == STORY
    assert htmltext.extract(f"<body><main><article>{ARTICLE}</article>{cards}</main></body>") == STORY
    assert htmltext.extract(f'<body><div class="has-sidebar"><div class="x">{ARTICLE}</div>{cards[:19]}side</div></div></body>') == STORY


@pytest.mark.parametrize("block_rows", [2000, 3])
def test_fingerprints(spark, block_rows):
    rows = [(k, t) for k, t in TEXTS if k not in (3, None)] + [(None, "last words here")]
    pairs = fingerprints.edited_pairs(frame(spark, rows), "doc_id", "text", block_rows=block_rows)
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    expected = {}
    for (k, t), (_, following) in zip(ordered, [*ordered[1:], ordered[0]]):
        t, following = t or "", following or ""
        half = len(t) // 2
        expected[k] = (len(t), t[: len(t) - half] + following[:half])
    assert {r["key"]: (r["n_chars"], r["edited"]) for r in pairs.collect()} == expected
    assert fingerprints.edited_pairs(empty(spark), "doc_id", "text").count() == 0
    one = fingerprints.edited_pairs(frame(spark, [(1, "abcdef")]), "doc_id", "text").first()
    assert one["edited"] == "abcabc"
    alike = fingerprints.edited_pairs(frame(spark, [(3, BASE), (3, BASE), (3, "x")]), "doc_id", "text")
    assert alike.count() == 3


def test_sketches_estimate_and_merge(spark):
    a, b = prose(3000, 11), prose(3000, 12)
    both = spark.createDataFrame([(a, a[: len(a) // 2] + " " + b[len(b) // 2 :])], "a string, b string")
    s = both.select(fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    row = s.select(
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("near"), fingerprints.distinct_shingles(F.col("a")).alias("n"),
        fingerprints.containment(F.col("a"), F.col("b")).alias("inside"),
        (fingerprints.from_text(fingerprints.as_text(F.col("a"))) == F.col("a")).alias("back"),
        (fingerprints.merged(F.col("a"), F.col("a")) == F.col("a")).alias("same"),
    ).first()
    x, y = brute.shingles(a, 5), brute.shingles(both.first()["b"], 5)
    assert abs(row["near"] - len(x & y) / len(x | y)) < 0.15 and abs(row["n"] / len(x) - 1) < 0.3
    assert abs(row["inside"] - len(x & y) / len(x)) < 0.2 and row["back"] and row["same"]


def test_a_path_with_a_space_is_one_folder():
    for path in ("/tmp/a b", "file:/tmp/a%20b"):
        assert warc.fs.FileSystem.from_uri(warc._uri(path))[1] == "/tmp/a b"
    assert warc._target("http://h/a b") == "http://h/a%20b"


def test_paths_and_limits_that_are_refused_or_read_alike(spark):
    assert {warc._uri(p) for p in ("/a/b", "file:/a/b", "file:///a/b")} == {"file:///a/b"}
    assert warc._uri("s3://b/a") == "s3://b/a"
    with pytest.raises(ValueError, match="percent"):
        nearjoin.near_groups(empty(spark), "doc_id", "text", percent=40)
