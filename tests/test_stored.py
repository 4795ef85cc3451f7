"""Stored suggestions against the scan, and embedding providers."""

import pytest
from pyspark.sql import functions as F

from docsieve.functions import provider as M
from docsieve.operators import spelling as L
from docsieve.sources import suggestions as S

ENTRIES = [("Red ring", 3.0), ("red bolt", 3.0), ("Ring of gold", 9.0), ("Ring of gold", 1.0), (None, 5.0), ("été chaud", 2.0), ("x", 0.0)] + [
    (f"ring number {i}", float(i % 7)) for i in range(30)
]


def test_stored_suggestions_are_those_of_the_scan(spark, tmp_path):
    df = spark.createDataFrame(ENTRIES, "name string, weight double").repartition(3)
    path = str(tmp_path / "s")
    S.build(df, "name", "weight", path, letters=4, most=5, buckets=3)
    for typed, limit in [("r", 5), ("RI", 3), ("ring", 5), ("ring ", 5), ("numbe", 5), ("é", 5), ("zz", 5), ("ring", 12), ("o", 1)]:
        got = [tuple(r) for r in S.suggest(spark, path, typed, limit).collect()]
        assert got == [tuple(r) for r in L.suggest(df, "name", typed, "weight", limit).collect()], typed
    plan = S.suggest(spark, path, "ring", 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(prefix,ring)" in plan


def counting():
    loads = []

    def load():
        loads.append(1)
        return lambda texts: [[float(len(t)), float(len(loads))] for t in texts]

    return load


def test_a_model_is_loaded_once_a_task_and_carries_its_name(spark):
    df = spark.createDataFrame([(i, "x" * i if i % 3 else None) for i in range(40)], "id int, text string").repartition(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = M.with_vectors(df, "text", M.Provider("lengths", 2, counting())).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {tuple(r["embedding"]) for r in got} == {(float(r["id"] if r["id"] % 3 else 0), 1.0) for r in got}
    assert {(r["vector_model"], r["dimensions"]) for r in got} == {("lengths", 2)}
    assert M.query_vector("abc", M.Provider("lengths", 2, counting())) == [3.0, 1.0]


def test_a_model_runs_once_a_row_on_some_texts_at_a_time(spark):
    provider = M.Provider("calls", 2, lambda: lambda texts: [[float(len(t)), float(len(texts))] for t in texts])
    df = spark.createDataFrame([(i, "x" * (i % 7) if i % 7 else None, "v") for i in range(1000)], "id int, text string, _vector string")
    made = M.with_vectors(df.coalesce(1), "text", provider, vector="TEXT")
    assert made.columns == ["id", "TEXT", "_vector", "vector_model", "dimensions"]
    assert {(r["id"], r["TEXT"][0], r["_vector"]) for r in made.collect()} == {(i, float(i % 7), "v") for i in range(1000)}
    assert made.agg(F.max(F.col("TEXT")[1])).first()[0] <= 256
    dims = made.select("id", F.posexplode("TEXT").alias("dim", "x")).where("x > 0")
    assert dims._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


@pytest.mark.parametrize("model, message", [
    (lambda texts: [[1.0]] * len(texts), "its dimension is 2"), (lambda texts: [[1.0, 2.0]], "gave 1 vectors for 3 texts"),
])
def test_wrong_vectors_are_errors(spark, model, message):
    provider = M.Provider("wrong", 2, lambda: model)
    df = spark.createDataFrame([(i, "t") for i in range(3)], "id int, text string").coalesce(1)
    with pytest.raises(Exception, match=message):
        M.with_vectors(df, "text", provider).collect()
    with pytest.raises(ValueError):
        M.query_vector("t", M.Provider("wrong", 3, lambda: lambda texts: [[1.0]]))
