import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from docsieve.functions import predicates as P
from docsieve.functions import scalars as C
from docsieve.functions import text as X
from docsieve.functions import vectors as V
from docsieve.operators import keyword as K


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "word,stem",
    [
        ("ponies", "pony"), ("horses", "horse"), ("cats", "cat"), ("glass", "glass"), ("bus", "bus"),
        ("shoes", "shoes"), ("employees", "employees"), ("is", "is"), ("ties", "ty"), ("ies", "ies"),
    ],
)
def test_stem(spark, word, stem):
    assert one(spark, X.stem(F.lit(word))) == stem


def test_word_parts(spark):
    assert one(spark, X.word_parts(F.lit("PowerShot500"))) == ["Power", "Shot", "500", "PowerShot"]
    assert one(spark, X.word_parts(F.lit("PowerShot500"), joined=False)) == ["Power", "Shot", "500"]


def test_index_terms_paths_agree(spark):
    """The short path for texts without inner borders gives what the long one gives."""
    for text in ["The cats AND the Ponies", "iPhone12 cats PowerShots the A1b", "", "of the"]:
        long = one(spark, F.flatten(X.terms_by_position(F.lit(text))))
        assert one(spark, X.index_terms(F.lit(text))) == long
    assert one(spark, X.index_terms(F.lit("The catsCats"))) == ["cat", "catscat"]


def test_duplicates_only_at_one_position(spark):
    df = spark.createDataFrame([([(0, "a"), (0, "a"), (1, "a")],)], "p array<struct<pos:int,term:string>>")
    assert len(df.select(X.dedupe_at_position("p")).first()[0]) == 2


def test_duplicates_go_in_order_and_at_any_length(spark):
    rows = [(2, "b"), (None, "a"), (2, "a"), None, (2, "b"), (1, None), (None, "a"), (1, None), None, (1, "b")]
    df = spark.createDataFrame([(rows,), ([],), (None,)], "p array<struct<pos:int,term:string>>")
    got = [r[0] if r[0] is None else [x and tuple(x) for x in r[0]] for r in df.select(X.dedupe_at_position("p")).collect()]
    assert got == [[(2, "b"), (None, "a"), (2, "a"), None, (1, None), (1, "b")], [], None]
    # Compared pair by pair, these took minutes.
    long = F.transform(F.sequence(F.lit(0), F.lit(199_999)), lambda i: F.struct(F.floor(i / 4).alias("pos"), (i % 2).alias("term")))
    began = time.monotonic()
    assert one(spark, F.size(X.dedupe_at_position(long))) == 100_000
    assert time.monotonic() - began < 20


def test_synonyms(spark):
    got = one(spark, X.with_synonyms(F.array(F.lit("BTC"), F.lit("crypto"), F.lit("x"))))
    assert got == ["btc", "bitcoin", "crypto", "cryptocurrency", "cryptographic", "cryptography", "x"]


def test_query_terms_and_forms(spark):
    assert X.query_terms(spark, "The Ponies and ponies, cars") == ["pony", "car"]
    assert X.surface_forms(spark, "pony shoes") == ["ponies", "pony", "ponys", "shoes"]


def places_near(tokens, terms, slop):
    spots = [[i - n for i, t in enumerate(tokens) if t == term] for n, term in enumerate(terms)]
    return any(max(c) - min(c) <= slop for c in itertools.product(*spots))


def test_near_and_phrase_by_brute_force(spark):
    rng = random.Random(3)
    texts = [[rng.choice("wxyz") * 3 for _ in range(rng.randint(1, 14))] for _ in range(150)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id int, text string")
    for slop in (0, 1, 3):
        got = {r["id"] for r in K.near(df, "text", "www xxx yyy", slop).collect()}
        assert got == {i for i, t in enumerate(texts) if places_near(t, ["www", "xxx", "yyy"], slop)}
    got = {r["id"] for r in K.phrase(df, "text", "www xxx").collect()}
    assert got == {i for i, t in enumerate(texts) if places_near(t, ["www", "xxx"], 0)}


@pytest.mark.parametrize(
    "given,wanted",
    [
        (None, []), ("", []), ([], []), ({}, []), ("field:value", ["field:value"]),
        ('{"field": "value"}', ["field:value"]), ({"field": "value"}, ["field:value"]),
        ("field;value", ["fieldvalue"]), (["a:1", "", None], ["a:1"]),
    ],
)
def test_filter_forms(given, wanted):
    assert P.filter_list(given) == wanted


@pytest.mark.parametrize(
    "given", ["field1,field2", {"field1": 1, "field2": 2}, '["field1","field2"]', ["field1", "field2", {}]]
)
def test_field_forms(given):
    assert P.field_list(given) == ["field1", "field2"]


def test_shorthand_leaves_literals_alone():
    sql = "SELECT a FROM t WHERE b:c AND d = 'x:y' AND e = 'it''s f:g'"
    assert P.expand_shorthand(sql) == "SELECT a FROM t WHERE b = 'c' AND d = 'x:y' AND e = 'it''s f:g'"


def test_clause_errors(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    for bad in ("nope:1", "a", "a:"):
        with pytest.raises(ValueError):
            P.clause(df, bad)
    assert df.where(P.clause(df, "a:[0 TO 5]")).count() == 1
    assert df.where(P.clause(df, "a:[2 TO *]")).count() == 0
    assert df.where(P.clause(df, "b:(x y)")).count() == 1
    assert df.where(P.clause(df, "*:*")).count() == 1


@pytest.mark.parametrize(
    "given,wanted",
    [
        ("2024-01-02", "2024-01-02T00:00:00Z"), ("2024-01-02T03:04:05", "2024-01-02T03:04:05Z"),
        ("2024-01-02T03:04:05.123456", "2024-01-02T03:04:05Z"), ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05Z"),
    ],
)
def test_dates(spark, given, wanted):
    assert one(spark, C.normalize_date(F.lit(given))) == wanted


def test_scalars(spark):
    assert one(spark, C.preview(F.lit("x" * 151))) == "x" * 150 + "..."
    assert one(spark, C.preview(F.lit("x" * 150))) == "x" * 150
    assert one(spark, C.first_value(F.array().cast("array<string>"))) is None
    assert one(spark, C.lenient_json(F.lit("no json"), "$.a")) == "no json"
    assert one(spark, C.lenient_json(F.lit('{"a": 1}'), "$.a")) == "1"
    pairs = one(spark, C.pairs(F.array(F.lit("a"), F.lit("3"), F.lit("b"), F.lit("1"))))
    assert [tuple(p) for p in pairs] == [("a", 3), ("b", 1)]
    assert C.suffix_of("x_dt") == "_dt" and C.suffix_of("x_ss") == "_ss" and C.suffix_of("_i") is None


def test_vectors(spark):
    v = one(spark, V.embed_text(F.lit("cats and dogs cat"), 768))
    assert len(v) == 768 and abs(sum(x * x for x in v) - 1) < 1e-9
    assert set(one(spark, V.embed_text(F.lit(""), 8))) == {0.0}
    assert one(spark, V.text_to_vector(F.lit("[1, 2.5 ,-3]"))) == [1.0, 2.5, -3.0]
    a = one(spark, V.mock_vector(F.lit("id1"), 16))
    assert a == one(spark, V.mock_vector(F.lit("id1"), 16)) != one(spark, V.mock_vector(F.lit("id2"), 16))
