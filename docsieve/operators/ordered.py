"""Updates whose outcome depends on their order: version chains and requests served one by one.

What can be decided without the order is decided by aggregates first: stale requests, all but the first of
those that expect the stored version, requests that exceed the stock. The rest goes by in order, key by key,
as narrow rows of a sorted partition, and is folded with the state of one key in memory. The fold is
sequential by definition, so a key's remaining requests are read by one task, but never held there.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.operators.updates import OPERATIONS, SEQ, VERSION

# One row of a key at a time; returns rows to emit, is called with None after the key's last row.
Fold = Callable[[tuple | None], list[tuple]]


def folded(df: DataFrame, key: str, order: Sequence[str], fold: Callable[[], Fold], schema: T.StructType) -> DataFrame:
    """Rows of each key in order through a fresh ``fold()``. ``key`` comes first in ``df``; null keys are one key."""
    names = [f.name for f in schema.fields]
    # An empty frame of the wanted schema gives its Arrow types.
    kinds = df.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, step, out = object(), None, []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds.types)], names)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if step is None or row[0] != at:
                    if step:
                        out.extend(step(None))
                    at, step = row[0], fold()
                out.extend(step(row))
                if len(out) >= 10_000:
                    yield flushed()
                    out.clear()
        if step:
            out.extend(step(None))
        yield flushed()

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def version_chain(base: DataFrame, requests: DataFrame, key: str, version: str = VERSION) -> DataFrame:
    """(key, seq, expected, stored, status) for each of ``requests(key, seq, expected)``.

    Requests are served by ``seq``. One applies when it expects the version that the requests before it have
    left, and raises it by one; the others are a ``conflict``, or ``unknown`` where the base has no such key.
    A null expected version is a conflict. Rows of equal key and seq are one request.
    """
    once = requests.groupBy(key, SEQ).agg(F.max("expected").cast("long").alias("expected"))
    stored = base.select(F.col(key).alias("_k"), F.col(version).cast("long").alias("stored"))
    known = once.join(stored, F.col(key) == F.col("_k"), "left")
    # Of those that expect the stored version only the first can apply: combined before the shuffle.
    own = F.when(F.col("expected") > F.col("stored"), F.col(SEQ)).alias("_own")
    waiting = known.where("expected >= stored").groupBy(key, own).agg(
        F.min(SEQ).alias(SEQ), F.min("expected").alias("expected"), F.min("stored").alias("stored")
    )

    def fold() -> Fold:
        state: dict = {}

        def step(row: tuple | None) -> list[tuple]:
            if row is None:
                return []
            k, seq, expected, stored = row
            if expected != state.setdefault("now", stored):
                return []
            state["now"] += 1
            return [(k, seq)]

        return step

    schema = T.StructType([requests.schema[key], requests.schema[SEQ]])
    taken = folded(waiting.select(key, SEQ, "expected", "stored"), key, [SEQ], fold, schema)
    taken = taken.select(F.col(key).alias("_tk"), F.col(SEQ).alias("_ts"))
    done = known.join(taken, (F.col(key) == F.col("_tk")) & (F.col(SEQ) == F.col("_ts")), "left")
    status = F.when(F.col("_ts").isNotNull(), "applied").when(F.col("_k").isNull(), "unknown").otherwise("conflict")
    return done.select(key, SEQ, "expected", "stored", status.alias("status"))


def _changed(op: str, value, change: str | None, cast: Callable):
    """One operation on one value."""
    if op == "set":
        return cast(change)
    if op == "set-if-null":
        return cast(change) if value is None else value
    if op == "inc":
        return value if change is None else (value or 0) + cast(change)
    if change is None:
        return value
    if op == "add":
        return [*(value or []), change]
    if value is None:
        return None
    return [v for v in value if (v != change if op == "remove" else not (v is not None and re.search(change, v)))]


def _caster(kind: T.DataType) -> Callable:
    if isinstance(kind, T.ArrayType):
        import json

        return lambda v: None if v is None else [None if x is None else str(x) for x in json.loads(v)]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return lambda v: None if v is None else float(v)
    if isinstance(kind, T.IntegralType):
        return lambda v: None if v is None else int(float(v))
    return lambda v: v


def chained_update(
    base: DataFrame, changes: DataFrame, key: str, fields: Sequence[str], version: str = VERSION
) -> DataFrame:
    """``base`` after all requests that :func:`version_chain` applies, each a set of operations under one version.

    ``changes(key, seq, expected, field, op, value)`` has a row per operation; those of one key and ``seq``
    are one request and apply together or not at all, in the order ``set``, ``set-if-null``, ``inc``, ``add``,
    ``remove``, ``removeregex``. Later requests see what earlier ones left. Each request raises the version
    by one. A missing number counts as 0, patterns match anywhere in a value. Fields outside ``fields`` and
    unknown operations are an error.
    """
    ranks = {op: i for i, op in enumerate(["set", "set-if-null", "inc", "add", "remove", "removeregex"])}
    assert set(ranks) == set(OPERATIONS)
    known = F.col("op").isin(list(OPERATIONS)) & F.col("field").isin(list(fields))
    checked = changes.withColumn(
        "op", F.when(known, F.col("op")).otherwise(F.raise_error(F.lit("unknown field or operation")).cast("string"))
    )
    taken = version_chain(base, checked, key, version).where("status = 'applied'").select(key, SEQ)
    operations = checked.join(taken, [key, SEQ], "left_semi")
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair]), F.col("op"))
    values = [F.col(f) for f in fields]
    none = [F.lit(None).cast(base.schema[f].dataType).alias(f"_v_{i}") for i, f in enumerate(fields)]
    touched = base.join(taken.select(key).distinct(), key, "left_semi")
    rows = touched.select(
        key, F.lit(None).cast(changes.schema[SEQ].dataType).alias(SEQ), F.lit(None).cast("int").alias("_rank"),
        F.lit(None).cast("string").alias("_field"), F.lit(None).cast("string").alias("_op"), F.lit(None).cast("string").alias("_value"),
        *[v.alias(f"_v_{i}") for i, v in enumerate(values)],
    ).unionByName(operations.select(
        key, SEQ, rank.alias("_rank"), F.col("field").alias("_field"), F.col("op").alias("_op"), F.col("value").cast("string").alias("_value"), *none
    ))
    casts = {f: _caster(base.schema[f].dataType) for f in fields}
    names = list(fields)

    def fold() -> Fold:
        state: dict = {"seqs": 0, "last": None}

        def step(row: tuple | None) -> list[tuple]:
            if row is None:
                return [(state["key"], state["seqs"], *[state[f] for f in names])]
            if row[1] is None:
                state["key"] = row[0]
                state.update(zip(names, row[6:]))
                return []
            if row[1] != state["last"]:
                state["seqs"] += 1
                state["last"] = row[1]
            field = row[3]
            state[field] = _changed(row[4], state[field], row[5], casts[field])
            return []

        return step

    new = T.StructType([
        base.schema[key], T.StructField("_steps", T.LongType()),
        *[T.StructField(f"_n_{i}", base.schema[f].dataType) for i, f in enumerate(fields)],
    ])
    # The stored row comes first, since its seq is null; operations follow in their order.
    after = folded(rows, key, [SEQ, "_rank", "_field", "_value"], fold, new).withColumnRenamed(key, "_k")
    joined = base.join(after, F.col(key) == F.col("_k"), "left")
    hit = F.col("_k").isNotNull()
    out = []
    for c in base.columns:
        if c in names:
            out.append(F.when(hit, F.col(f"_n_{names.index(c)}")).otherwise(F.col(c)).alias(c))
        elif c == version:
            out.append((F.col(c) + F.coalesce("_steps", F.lit(0))).cast(base.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def served_one_by_one(
    base: DataFrame, requests: DataFrame, key: str, field: str, amount: str = "quantity"
) -> DataFrame:
    """(key, seq, amount, old, new, status) for each of ``requests(key, seq, amount)``, served by ``seq``.

    A request takes its amount when that much is left, else it is ``rejected`` and the next one is tried.
    Amounts that are null or below zero are ``invalid``, unknown keys ``unknown``; ``old`` and ``new`` are the
    stock around the request, for those two and for amounts above the whole stock null. A missing stock is 0.
    Requests of equal ``seq`` go by amount, the smaller first; repeated rows are requests of their own.
    """
    stock = base.select(F.col(key).alias("_k"), F.coalesce(F.col(field), F.lit(0)).cast("double").alias("_stock"))
    asked = requests.select(key, SEQ, F.col(amount).cast("double").alias(amount))
    known = asked.join(stock, F.col(key) == F.col("_k"), "left")
    invalid = F.col(amount).isNull() | (F.col(amount) < 0)
    fixed = F.when(F.col("_k").isNull(), "unknown").when(invalid, "invalid").when(F.col(amount) > F.col("_stock"), "rejected")
    known = known.withColumn("_fixed", fixed)
    never = known.where("_fixed IS NOT NULL").select(
        key, SEQ, amount, F.lit(None).cast("double").alias("old"), F.lit(None).cast("double").alias("new"), F.col("_fixed").alias("status")
    )

    def fold() -> Fold:
        state: dict = {}

        def step(row: tuple | None) -> list[tuple]:
            if row is None:
                return []
            k, seq, wanted, stock = row
            left = state.setdefault("left", stock)
            if wanted <= left:
                state["left"] = left - wanted
                return [(k, seq, wanted, left, state["left"], "applied")]
            return [(k, seq, wanted, left, left, "rejected")]

        return step

    number = lambda name: T.StructField(name, T.DoubleType())
    schema = T.StructType([requests.schema[key], requests.schema[SEQ], number(amount), number("old"), number("new"), T.StructField("status", T.StringType())])
    open_yet = known.where("_fixed IS NULL").select(key, SEQ, amount, "_stock")
    return folded(open_yet, key, [SEQ, amount], fold, schema).unionByName(never)


def stock_after(base: DataFrame, report: DataFrame, key: str, field: str) -> DataFrame:
    """``base`` with the stock that the applied requests of ``report`` leave."""
    used = report.where("status = 'applied'").groupBy(F.col(key).alias("_k")).agg(F.min("new").alias("_new"))
    joined = base.join(used, F.col(key) == F.col("_k"), "left")
    kind = base.schema[field].dataType
    return joined.select(*[F.coalesce(F.col("_new").cast(kind), F.col(c)).alias(c) if c == field else F.col(c) for c in base.columns])
