"""Version chains and requests served one by one against plain Python, with a key that has a third of the batch."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docsieve.operators import ordered as O

RANK = ["set", "set-if-null", "inc", "add", "remove", "removeregex"]


def requests(seed, n=400):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        key = 1 if rng.random() < 0.34 else rng.randint(0, 14)
        expected = rng.choice([None, 3, 3, 4, 5, 6, 2, 7])
        ops = []
        for _ in range(rng.randint(1, 3)):
            ops.append(rng.choice([
                ("stock", "inc", str(rng.randint(-3, 9))), ("stock", "set", rng.choice(["7", None])), ("stock", "set-if-null", "100"),
                ("tags", "add", rng.choice("abc")), ("tags", "remove", rng.choice("abc")), ("tags", "removeregex", "^[ab]"),
                ("name", "set", rng.choice(["x", None])), ("name", "set-if-null", "given"), ("tags", "set", '["q", "a"]'),
            ]))
        # One operation a field and kind, so that the order within a request is plain.
        out.append((key, seq, expected, list({(f, op): (f, op, v) for f, op, v in ops}.values())))
    return out


BASE = [(k, 3 if k % 3 else None, ["a", "b"] if k % 2 else None, f"n{k}" if k % 4 else None, 3, "kept") for k in range(12)]


def applied(value, op, change, number):
    cast = (lambda v: None if v is None else int(v)) if number else (lambda v: v)
    if op == "set":
        return ["q", "a"] if change and change.startswith("[") else cast(change)
    if op == "set-if-null":
        return cast(change) if value is None else value
    if op == "inc":
        return (value or 0) + int(change)
    if op == "add":
        return [*(value or []), change]
    if value is None:
        return None
    return [v for v in value if (v != change if op == "remove" else not re.search(change, v))]


def expected_of(batch):
    rows = {r[0]: list(r) for r in BASE}
    report = []
    for key, seq, expected, ops in sorted(batch, key=lambda r: r[1]):
        row = rows.get(key)
        if row is None:
            report.append((key, seq, "unknown"))
            continue
        if expected != row[4]:
            report.append((key, seq, "conflict"))
            continue
        report.append((key, seq, "applied"))
        row[4] += 1
        for field, op, value in sorted(ops, key=lambda o: RANK.index(o[1])):
            i = {"stock": 1, "tags": 2, "name": 3}[field]
            row[i] = applied(row[i], op, value, field == "stock")
    return sorted(report), sorted((tuple(r) for r in rows.values()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_version_chain(spark, seed):
    batch = requests(seed)
    rng = random.Random(seed)
    flat = [(k, s, e, f, op, v) for k, s, e, ops in batch for f, op, v in ops]
    rng.shuffle(flat)
    base = spark.createDataFrame(BASE, "id long, stock int, tags array<string>, name string, version int, other string")
    changes = spark.createDataFrame(flat, "id long, seq long, expected int, field string, op string, value string").repartition(4)
    report, rows = expected_of(batch)
    got = O.version_chain(base, changes, "id").select("id", "seq", "status").collect()
    assert sorted(tuple(r) for r in got) == report
    assert sum(r[2] == "applied" for r in report) > 10
    after = O.chained_update(base, changes, "id", ["stock", "tags", "name"])
    assert after.schema == base.schema
    assert sorted((tuple(r) for r in after.collect()), key=repr) == rows


def test_chained_update_of_nothing_and_of_unknown_operations(spark):
    base = spark.createDataFrame(BASE, "id long, stock int, tags array<string>, name string, version int, other string")
    none = spark.createDataFrame([], "id long, seq long, expected int, field string, op string, value string")
    assert sorted(map(repr, O.chained_update(base, none, "id", ["stock"]).collect())) == sorted(map(repr, base.collect()))
    for field, op in (("stock", "multiply"), ("other", "set")):
        bad = spark.createDataFrame([(1, 1, 3, field, op, "2")], "id long, seq long, expected int, field string, op string, value string")
        with pytest.raises(Exception, match="unknown field or operation"):
            O.chained_update(base, bad, "id", ["stock"]).collect()


def test_one_by_one(spark):
    rng = random.Random(1)
    stock = {k: rng.choice([None, 0.0, 5.0, 40.0, 300.0]) for k in range(8)}
    batch = [(1 if rng.random() < 0.4 else rng.randint(0, 9), rng.randint(0, 60), rng.choice([None, -1.0, 0.0, 2.0, 7.0, 31.0, 500.0])) for _ in range(500)]
    left = {k: v or 0.0 for k, v in stock.items()}
    expected = []
    for k, seq, q in sorted(batch, key=lambda r: (r[1], r[2] is not None, r[2] or 0)):
        if k not in left:
            expected.append((k, seq, q, None, None, "unknown"))
        elif q is None or q < 0:
            expected.append((k, seq, q, None, None, "invalid"))
        elif q > (stock[k] or 0.0):
            expected.append((k, seq, q, None, None, "rejected"))
        else:
            new = left[k] - q if q <= left[k] else left[k]
            expected.append((k, seq, q, left[k], new, "applied" if q <= left[k] else "rejected"))
            left[k] = new
    base = spark.createDataFrame(list(stock.items()), "id long, stock double").withColumn("other", F.lit("kept"))
    asked = spark.createDataFrame(batch, "id long, seq long, quantity double").repartition(3)
    report = O.served_one_by_one(base, asked, "id", "stock")
    assert sorted((tuple(r) for r in report.collect()), key=repr) == sorted(expected, key=repr)
    after = {r["id"]: r["stock"] for r in O.stock_after(base, report, "id", "stock").collect()}
    assert after == {k: (left[k] if any(e[0] == k and e[5] == "applied" for e in expected) else stock[k]) for k in stock}


def test_only_what_depends_on_the_order_is_folded(spark):
    """A key whose requests all expect the stored version brings one row to the fold."""
    base = spark.createDataFrame([(1, 3)], "id long, version int")
    same = spark.range(5000).selectExpr("1L AS id", "id AS seq", "3 AS expected")
    report = O.version_chain(base, same, "id")
    assert report.where("status = 'applied'").collect()[0]["seq"] == 0 and report.where("status = 'conflict'").count() == 4999
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "min(seq" in plan[plan.index("MapInArrow") :]
