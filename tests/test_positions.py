"""Phrases from stored positions against the scan of the texts, and what is read for them."""

import random

import pytest
from pyspark.sql import functions as F

from docsieve.operators import keyword as K
from docsieve.sources import positions as P

WORDS = ["red", "ring", "Wi-Fi", "PowerShot", "bolt", "the", "gold2000", "rings"]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    return spark.createDataFrame([*rows, (200, None), (201, "red " * 5000 + "ring")], "id long, text string").repartition(3).cache()


@pytest.fixture(scope="module")
def stored(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("positions"))
    P.build(texts, "id", "text", path, buckets=8)
    return path


@pytest.mark.parametrize("query", ["red ring", "ring", "red red", "wi fi power shot", "gold 2000 red", "ring bolt ring"])
@pytest.mark.parametrize("slop", [0, 1, 3])
def test_same_as_the_scan(spark, texts, stored, query, slop):
    scan = K.near(texts, "text", query, slop) if slop else K.phrase(texts, "text", query)
    got = sorted(r["id"] for r in P.phrase(spark, stored, query, "id", slop).collect())
    assert got == sorted(r["id"] for r in scan.collect())


def test_places_come_back_from_their_gaps(spark):
    terms = F.array(*[F.lit(t) for t in "b a b c b a".split()])
    row = spark.range(1).select(P.term_places(terms).alias("x")).select(F.transform("x", lambda r: F.struct(r["term"], P.places(r["gaps"]))).alias("y"))
    assert [(r[0], list(r[1])) for r in row.first()["y"]] == [("a", [1, 5]), ("b", [0, 2, 4]), ("c", [3])]
    none = spark.range(1).select(P.term_places(F.array().cast("array<string>")).alias("x")).first()["x"]
    assert none == []


def test_gaps_of_many_terms_and_no_expression_per_comparison(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice("abcdéZ") * rng.randint(1, 2) for _ in range(n)]) for i, n in enumerate((0, 1, 2, 50, 400))]
    made = spark.createDataFrame([*rows, (5, None)], "i int, t array<string>").select("i", "t", P.term_places(F.col("t")).alias("x"))
    for i, terms, got in made.collect():
        if terms is None:
            assert got is None
            continue
        at = {t: [p for p, u in enumerate(terms) if u == t] for t in terms}
        assert [(r["term"], r["gaps"]) for r in got] == [
            (t, [b - a for a, b in zip([0, *at[t]], at[t])]) for t in sorted(at, key=str.encode)
        ]
    assert "array_sort(" not in made._jdf.queryExecution().analyzed().toString()


def test_only_the_terms_folders_are_read(spark, stored):
    plan = P.phrase(spark, stored, "red ring", "id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "In(term, [red,ring])" in plan
    assert "text" not in plan[plan.index("ReadSchema") :]
    with pytest.raises(ValueError):
        P.phrase(spark, stored, "the", "id")
