import pytest
from pyspark.sql import functions as F

from docsieve.operators import schema as H
from docsieve.operators import updates as U

OPS = "id int, seq bigint, field string, op string, value string"


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(
        [(1, 100, "a", ["x", "y", "x"], 1), (2, None, None, None, 1), (3, 5, "c", [], 4)],
        "id int, n int, s string, tags array<string>, version bigint",
    )


def apply(spark, base, ops, rules, **kw):
    out = U.atomic_update(base, spark.createDataFrame(ops, OPS), "id", rules, **kw)
    return {r["id"]: r for r in out.collect()}


def test_inc_and_unknown_keys(spark, base):
    got = apply(spark, base, [(1, 1, "n", "inc", "50"), (2, 2, "n", "inc", "-3"), (9, 3, "n", "inc", "1")],
                {"n": ["inc"]}, version="version")
    assert (got[1]["n"], got[2]["n"], got[3]["n"]) == (150, -3, 5)
    assert [got[i]["version"] for i in (1, 2, 3)] == [2, 2, 4] and 9 not in got
    assert got[1]["s"] == "a" and got[1]["tags"] == ["x", "y", "x"]


def test_set_null_and_set_then_inc(spark, base):
    ops = [(1, 1, "s", "set", None), (1, 2, "n", "inc", "7"), (1, 3, "n", "set", "10"), (1, 4, "n", "inc", "2")]
    got = apply(spark, base, ops, {"s": ["set"], "n": ["set", "inc"]})
    assert got[1]["s"] is None and got[1]["n"] == 12


def test_lists(spark, base):
    ops = [(1, 1, "tags", "add", "z"), (1, 2, "tags", "remove", "y"), (2, 3, "tags", "add", "q"),
           (3, 4, "tags", "removeregex", "^x")]
    got = apply(spark, base, ops, {"tags": ["add", "remove", "removeregex"]})
    assert (got[1]["tags"], got[2]["tags"], got[3]["tags"]) == (["x", "x", "z"], ["q"], [])
    got = apply(spark, base, [(1, 1, "tags", "removeregex", "x|z")], {"tags": ["removeregex"]})
    assert got[1]["tags"] == ["y"]
    got = apply(spark, base, [(1, 1, "tags", "set", '["k"]')], {"tags": ["set"]})
    assert got[1]["tags"] == ["k"]


def test_set_if_null(spark, base):
    ops = [(1, 1, "s", "set-if-null", "n1"), (2, 2, "s", "set-if-null", "n2")]
    got = apply(spark, base, ops, {"s": ["set-if-null"]})
    assert (got[1]["s"], got[2]["s"]) == ("a", "n2")


def test_bad_operations(spark, base):
    changes = spark.createDataFrame([], OPS)
    for rules in ({"nope": ["set"]}, {"n": ["multiply"]}):
        with pytest.raises(ValueError):
            U.atomic_update(base, changes, "id", rules)


def test_hot_key_upsert(spark):
    """A third of a batch on one key: the last row wins and every key appears once."""
    base = spark.createDataFrame([(i, 0) for i in range(50)], "id int, v bigint")
    changes = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("int").alias("id"),
        F.col("id").alias("seq"), F.col("id").alias("v"),
    )
    got = {r["id"]: r["v"] for r in U.upsert(base, changes, "id").collect()}
    assert len(got) == 100 and got[7] == 29997 and got[8] == 29908
    with pytest.raises(ValueError):
        U.upsert(base, changes.limit(0), "id")


def test_delete(spark, base):
    ids = spark.createDataFrame([(1,), (9,)], "id int")
    assert {r["id"] for r in U.delete(base, "id", ids=ids).collect()} == {2, 3}
    assert {r["id"] for r in U.delete(base, "id", condition=F.col("n") > 50).collect()} == {2, 3}
    for kw in ({}, {"ids": ids, "condition": F.lit(True)}):
        with pytest.raises(ValueError):
            U.delete(base, "id", **kw)


def test_versions(spark, base):
    changes = spark.createDataFrame(
        [(1, 1, 1, "new"), (1, 2, 1, "late"), (3, 3, 3, "stale"), (9, 4, 1, "unknown")],
        "id int, seq int, expected bigint, value string",
    )
    got = {r["id"]: (r["s"], r["version"]) for r in U.update_versioned(base, changes, "id", "s").collect()}
    assert got == {1: ("new", 2), 2: (None, 1), 3: ("c", 4)}
    lost = {r["seq"]: r["stored"] for r in U.version_conflicts(base, changes, "id").collect()}
    assert lost == {2: 1, 3: 4, 4: None}


def test_guard(spark, base):
    asked = spark.createDataFrame([(1, 60), (1, 30), (3, 6), (2, 1), (8, 1)], "id int, quantity int")
    got = {r["id"]: (r["new"], r["status"]) for r in U.guarded_decrement(base, asked, "id", "n").collect()}
    assert got == {1: (10, "applied"), 3: (5, "rejected"), 2: (0, "rejected"), 8: (None, "unknown")}
    assert {r["id"]: r["n"] for r in U.apply_decrement(base, asked, "id", "n").collect()} == {1: 10, 2: None, 3: 5}


def test_pending_is_read_before_commit(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    log = spark.createDataFrame(
        [(2, "b2", 1, False), (3, "c", 2, False), (1, "gone", 3, True), (3, "c2", 4, None)],
        "id int, s string, seq int, deleted boolean",
    )
    got = U.realtime_get(base, log, "id", [1, 2, 3, 4], ["s", "id"])
    assert sorted(map(tuple, got.collect())) == [("b2", 2), ("c2", 3)]
    soft = sorted(map(tuple, U.commit(base, log, "id").collect()))
    hard = sorted(map(tuple, U.commit(base, log, "id", str(tmp_path / "snap")).collect()))
    assert soft == hard == [(2, "b2"), (3, "c2")]


def test_schema_operators(spark, base):
    grown = H.add_field(base, "rating", "pfloat", required=True)
    assert grown.schema["rating"].metadata["required"] and grown.schema["rating"].dataType.typeName() == "float"
    assert H.add_field(base, "many", "string", multi_valued=True).schema["many"].dataType.simpleString() == "array<string>"
    for name, kind in (("n", "pint"), ("other", "nokind")):
        with pytest.raises(ValueError):
            H.add_field(base, name, kind)
    with pytest.raises(ValueError):
        H.drop_field(base, "nope")
    vectors = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<float>")
    assert H.find_vector_field(vectors) == "v"
    with pytest.raises(ValueError):
        H.require_dimension(vectors, 2)
    with pytest.raises(ValueError):
        H.find_vector_field(base)
    profile = {r["field"]: r for r in H.field_profile(base).collect()}
    assert profile["tags"]["sortable"] is False and profile["n"]["distinct_values"] == 2
