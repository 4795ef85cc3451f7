"""Query texts against a plain Python reading of the same trees, and what is refused."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docsieve.functions import querytext
from docsieve.functions.querytext import Group, Leaf, parsed
from docsieve.functions.text import STOP_WORDS, SYNONYM_GROUPS, synonym_graph
from docsieve.operators import querysearch as Q

WORDS = ["red", "green", "blue", "ring", "ring bolt", "the", "gold"]
DOCS = [
    (i, " ".join(random.Random(i).choice(WORDS) for _ in range(random.Random(-i).randint(0, 7))) if i % 9 else None, random.Random(i).choice("xyz"), i % 11)
    for i in range(160)
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, text string, kind string, n int").cache()


def terms(text):
    return [w for w in (text or "").split() if w not in STOP_WORDS]


def holds(node, row):
    """None for clauses of stop words only, which do not count."""
    _, text, kind, n = row
    have = terms(text)
    if isinstance(node, Leaf):
        if node.kind == "all":
            return True
        if node.field == "kind":
            return kind in node.value.split()
        if node.kind == "range":
            low, high, a, b = node.bounds
            ok_low = low == "*" or (n >= int(low) if a else n > int(low))
            return ok_low and (high == "*" or (n <= int(high) if b else n < int(high)))
        if node.kind == "pattern":
            expression = node.value.replace("*", ".*").replace("?", ".")
            return any(re.fullmatch(expression, w) for w in have)
        asked = terms(node.value)
        if not asked:
            return None
        if node.kind == "words":
            return any(w in have for w in asked)
        if node.near:
            places = [[i - k for i, w in enumerate(have) if w == a] for k, a in enumerate(asked)]
            return any(all(any(low <= p <= low + node.near for p in ps) for ps in places) for low in range(-node.near - 5, len(have) + 1))
        return any(have[i : i + len(asked)] == asked for i in range(len(have)))
    must, should, must_not = ([v for n_ in part if (v := holds(n_, row)) is not None] for part in (node.must, node.should, node.must_not))
    if not (must or should or must_not):
        return None
    return all(must) and (bool(must) or not should or any(should)) and not any(must_not)


def random_query(rng, depth=0):
    def clause():
        pick = rng.random()
        if depth < 2 and pick < 0.3:
            return f"({random_query(rng, depth + 1)})"
        return rng.choice([
            rng.choice(WORDS).split()[0], f'"{rng.choice(["ring bolt", "red ring", "the red", "bolt bolt"])}"',
            f'"{rng.choice(["red ring", "bolt red", "gold blue red"])}"~{rng.randint(1, 4)}', "kind:x", "kind:(x y)", "n:[3 TO 7]",
            "n:{3 TO *]", "gr*", "?ol*", "*:*",
        ])

    parts = []
    for i in range(rng.randint(1, 4)):
        if i:
            parts.append(rng.choice(["AND", "OR", "", "", "&&", "||"]))
        parts.append(rng.choice(["", "", "", "-", "NOT ", "+", "! "]) + clause())
    return " ".join(p for p in parts if p)


@pytest.mark.parametrize("seed", range(12))
def test_matches_are_those_of_the_tree(docs, seed):
    rng = random.Random(seed)
    texts = [random_query(rng) for _ in range(6)]
    flags = [Q.condition(docs, Q.prepared(docs, t, ["text"])).alias(f"q{i}") for i, t in enumerate(texts)]
    got = {r["id"]: r for r in docs.select("id", *flags).collect()}
    for i, text in enumerate(texts):
        tree = parsed(text)
        for row in DOCS:
            # A query of stop words only finds nothing.
            assert got[row[0]][f"q{i}"] == (holds(tree, row) or False), (text, row)


@pytest.mark.parametrize("text", ["", "  ", "(", "a)", "(a", "AND a", "a AND", "a OR OR b", '"open', "nofield:x", "a [1 TO 2", "()", "a ^"])
def test_unreadable_texts_are_errors(docs, text):
    with pytest.raises(ValueError):
        Q.prepared(docs, text, ["text"])


def test_trees():
    word = lambda value, **more: Leaf("words", value, **more)
    assert parsed("a b") == word("a b")
    assert parsed("a AND b c") == Group(should=(Group(must=(word("a"), word("b"))), word("c")))
    assert parsed("a -b") == Group(should=(word("a"),), must_not=(word("b"),))
    assert parsed("NOT NOT a") == word("a")
    assert parsed("x:(a OR b)^2") == Group(should=(word("a", field="x", boost=2.0), word("b", field="x", boost=2.0)))
    assert parsed(r"a\:b\(c") == word("a:b(c")
    assert parsed("wi-fi ANDROID") == word("wi-fi ANDROID")
    assert querytext.positive(parsed("a -b +c")) == [word("c"), word("a")]


def test_synonym_graph_takes_the_longest_phrase(spark):
    words = F.array(*[F.lit(w) for w in "The Proof of Work of double spend spending".split()])
    got = spark.range(1).select(synonym_graph(words).alias("g")).first()["g"]
    assert [a[0] for a in got] == ["the", "proof of work", "of", "double spend", "spending"]
    assert set(got[1]) == {"proof of work", "pow"}
    assert spark.range(1).select(synonym_graph(F.array().cast("array<string>"))).first()[0] == []
    assert spark.range(1).select(synonym_graph(words, []).alias("g")).first()["g"][0] == ["the"]


def test_synonyms_of_several_words_find_each_other(spark):
    docs = spark.createDataFrame(
        [(1, "A blockchain"), (2, "distributed ledgers"), (3, "ledger, distributed"), (4, "the P2P net"), (5, "peer-to-peer nets")], "id int, text string"
    )
    found = lambda q: {r["id"] for r in Q.search(docs, q, ["text"], "id", synonyms=SYNONYM_GROUPS).collect()}
    assert found("distributed ledger") == found("Blockchains OR blockchain") == {1, 2}
    assert found('"distributed ledger"') == {2}
    assert found("peer to peer") == found("p2p") == {4, 5}
    asked = Q.prepared(docs, "blockchain", ["text"], synonyms=SYNONYM_GROUPS)
    assert Q.highlight_text(asked) == "blockchain distributed ledger"


def test_one_concept_in_one_field_scores_as_before(spark, docs):
    from docsieve.operators import keyword as K

    old = {r["id"]: r["score"] for r in K.score(docs, "text", "red gold").collect()}
    new = {r["id"]: r["score"] for r in Q.scored(docs, Q.prepared(docs, "red gold", ["text"])).collect()}
    assert new.keys() == old.keys() and len(new) > 20
    # Null texts count as empty here and not at all there, which moves the mean length.
    filled = docs.fillna({"text": ""})
    old = {r["id"]: r["score"] for r in K.score(filled, "text", "red gold").collect()}
    assert all(abs(new[i] - old[i]) < 1e-9 for i in old)


def test_fields_are_analysed_once_and_values_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame(DOCS, "id int, text string, kind string, n int").write.parquet(path)
    stored = spark.read.parquet(path)
    plans = []
    for text in ('red "red ring"', 'red AND green AND (blue OR gold) -"red ring" OR "gold bolt"'):
        found = Q.matching(stored.where("n > 3"), Q.prepared(stored, text, ["text"]))
        plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert plans[0].count("regexp_extract_all(") == plans[1].count("regexp_extract_all(")
    assert "PushedFilters: [IsNotNull(n), GreaterThan(n,3)]" in plans[1]
