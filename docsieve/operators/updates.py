"""Batched table updates: a base table plus a table of changes gives the new table.

Changes are reduced to one row per key by aggregations that combine map-side, so a key that
fills a third of a batch is cut down before it is shuffled. The base table is then met once,
by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQ = "seq"
DELETED = "deleted"
VERSION = "version"


def latest(changes: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """Last row per key. ``seq`` orders the rows of a batch; without one a row has no place and is an error.

    The buffer is a struct, so this sorts on both sides of the exchange; it still combines before it.
    """
    rest = [c for c in changes.columns if c != key]
    placed = F.coalesce(F.col(seq), F.raise_error(F.lit(f"a change has no {seq}")).cast(changes.schema[seq].dataType))
    last = changes.groupBy(key).agg(F.max_by(F.struct(*rest), placed).alias("last"))
    return last.select(key, *[F.col(f"last.{c}").alias(c) for c in rest]).select(*changes.columns)


def _is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def upsert(base: DataFrame, changes: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """Replace or add whole rows by key; the last row of a batch wins."""
    if _is_empty(changes):
        raise ValueError("no documents to add")
    new = latest(changes, key, seq).select(*base.columns)
    return base.join(new, key, "left_anti").unionByName(new)


def insert_new(base: DataFrame, changes: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """Add rows with new keys only; existing rows stay."""
    if _is_empty(changes):
        raise ValueError("no documents to add")
    new = latest(changes, key, seq).select(*base.columns)
    return base.unionByName(new.join(base, key, "left_anti"))


OPERATIONS = ("set", "inc", "add", "remove", "removeregex", "set-if-null")


def atomic_update(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    operations: dict[str, Sequence[str]],
    version: str | None = None,
) -> DataFrame:
    """Apply field operations; other fields and other rows stay unchanged.

    ``changes`` has the columns ``key, seq, field, op, value`` (text). ``operations`` names the
    operations used per field. Within a batch ``set`` takes the last value (null included) and
    ``inc`` adds what follows it; list fields take all additions, then removals of equal
    values, then removals by pattern. A missing number counts as 0. With ``version`` that
    column grows by one on changed rows. Keys that the base does not have are ignored.
    """
    for field, ops in operations.items():
        unknown = set(ops) - set(OPERATIONS)
        if unknown or field not in base.columns:
            raise ValueError(f"unknown field or operation: {field} {sorted(unknown)}")
    both = [f for f, ops in operations.items() if {"set", "inc"} <= set(ops)]
    if both:
        changes = _drop_overwritten(changes, key, both)
    measures: list[Column] = []
    for i, (field, ops) in enumerate(operations.items()):
        kind = base.schema[field].dataType
        for op in ops:
            hit = (F.col("field") == field) & (F.col("op") == op)
            measures.append(_reduced(hit, op, kind).alias(f"{op}_{i}"))
    per_key = changes.groupBy(key).agg(F.count(F.lit(1)).alias("changes"), *measures)
    joined = base.join(per_key, key, "left")
    index = {field: i for i, field in enumerate(operations)}
    out = []
    for column in base.columns:
        value = F.col(column)
        if column in index:
            i = index[column]
            for op in OPERATIONS:
                if op in operations[column]:
                    value = _applied(value, op, F.col(f"{op}_{i}"), base.schema[column].dataType)
        elif column == version:
            value = F.when(F.col("changes").isNotNull(), value + 1).otherwise(value)
        out.append(value.alias(column))
    return joined.select(*out)


def _drop_overwritten(changes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Remove increments that a later ``set`` of the same field overwrites."""
    sets = (
        changes.where(F.col("field").isin(list(fields)) & (F.col("op") == "set"))
        .groupBy(key, "field")
        .agg(F.max(SEQ).alias("set_seq"))
    )
    joined = changes.join(sets, [key, "field"], "left")
    keep = (F.col("op") != "inc") | F.col("set_seq").isNull() | (F.col(SEQ) > F.col("set_seq"))
    return joined.where(keep).drop("set_seq")


def _reduced(hit: Column, op: str, kind: T.DataType) -> Column:
    value = F.col("value")
    if op == "set":
        return F.max_by(F.when(hit, F.struct(value.alias("value"))), F.when(hit, F.col(SEQ)))
    if op == "set-if-null":
        some = hit & value.isNotNull()
        return F.min_by(F.when(some, value), F.when(some, F.col(SEQ)))
    if op == "inc":
        wide = "double" if isinstance(kind, (T.FloatType, T.DoubleType)) else "bigint"
        return F.sum(F.when(hit, value.cast(wide)))
    if op == "add":
        # The result is a list field of one row, so its size is that of the row to be stored.
        listed = F.collect_list(F.when(hit, F.struct(SEQ, value.alias("value"))))
        return F.transform(F.array_sort(listed), lambda s: s["value"])
    return F.array_sort(F.collect_set(F.when(hit, value)))


def _applied(value: Column, op: str, change: Column, kind: T.DataType) -> Column:
    if op == "set":
        target = change["value"]
        if isinstance(kind, T.ArrayType):
            target = F.from_json(target, kind.simpleString())
        return F.when(change.isNotNull(), target.cast(kind)).otherwise(value)
    if op == "set-if-null":
        return F.coalesce(value, change.cast(kind))
    if op == "inc":
        return F.when(
            change.isNotNull(), (F.coalesce(value, F.lit(0).cast(kind)) + change).cast(kind)
        ).otherwise(value)
    empty = F.array().cast("array<string>")
    if op == "add":
        grown = F.concat(F.coalesce(value, empty), change)
        return F.when(F.size(change) > 0, grown).otherwise(value)
    if op == "remove":
        # Not array_except, which would also drop repeats of the values that stay.
        kept = F.filter(value, lambda v: ~F.array_contains(change, v))
        return F.when(F.size(change) > 0, kept).otherwise(value)
    kept = F.filter(value, lambda v: ~F.exists(change, lambda p: F.regexp_like(v, p)))
    return F.when(F.size(change) > 0, kept).otherwise(value)


def delete_ids(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return base.join(ids.select(key), key, "left_anti")


def delete_where(base: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is unknown are kept."""
    return base.where(~F.coalesce(condition, F.lit(False)))


def delete(
    base: DataFrame, key: str, ids: DataFrame | None = None, condition: Column | None = None
) -> DataFrame:
    if (ids is None) == (condition is None):
        raise ValueError("give either ids or a condition")
    return delete_where(base, condition) if ids is None else delete_ids(base, ids, key)


def _versioned_winners(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Per key the first change whose expected version is the stored one.

    Changes are cut down to one per key and expected version before they meet the base.
    """
    rest = [c for c in changes.columns if c not in (key, "expected")]
    first = changes.groupBy(key, "expected").agg(F.min_by(F.struct(*rest), SEQ).alias("first"))
    stored = base.select(key, F.col(VERSION).alias("expected"))
    return first.join(stored, [key, "expected"]).select(
        key, "expected", *[F.col(f"first.{c}").alias(c) for c in rest]
    )


def update_versioned(base: DataFrame, changes: DataFrame, key: str, field: str) -> DataFrame:
    """Set ``field`` to ``value`` where ``expected`` equals the stored version, then bump it.

    ``changes`` has ``key, seq, expected, value``. The first fitting change of a key wins: it
    raises the version, so the others have become stale.
    """
    wins = _versioned_winners(base, changes, key).select(
        key, F.col("value").alias("_value"), F.lit(True).alias("_hit")
    )
    hit = F.coalesce("_hit", F.lit(False))
    return base.join(wins, key, "left").select(
        *[
            F.when(hit, F.col("_value")).otherwise(F.col(c)).alias(c)
            if c == field
            else (F.when(hit, F.col(c) + 1).otherwise(F.col(c)).alias(c) if c == VERSION else F.col(c))
            for c in base.columns
        ]
    )


def version_conflicts(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Changes that were not applied, with the stored version (null for unknown keys)."""
    wins = _versioned_winners(base, changes, key).select(key, SEQ)
    stored = base.select(key, F.col(VERSION).alias("stored"))
    return changes.join(wins, [key, SEQ], "left_anti").join(stored, key, "left")


def guarded_decrement(
    base: DataFrame, requests: DataFrame, key: str, field: str, amount: str = "quantity"
) -> DataFrame:
    """Take amounts from a stock field, or reject. All requests for a key count as one.

    Returns ``key, quantity, old, new, status`` with status ``applied``, ``rejected`` or
    ``unknown``.
    """
    wanted = requests.groupBy(key).agg(F.sum(amount).alias("quantity"))
    stock = F.coalesce(F.col(field), F.lit(0))
    known = base.select(key, stock.alias("old"), F.lit(True).alias("known"))
    enough = F.col("old") >= F.col("quantity")
    return wanted.join(known, key, "left").select(
        key,
        "quantity",
        "old",
        F.when(enough, F.col("old") - F.col("quantity")).otherwise(F.col("old")).alias("new"),
        F.when(F.col("known").isNull(), "unknown").when(enough, "applied").otherwise("rejected")
        .alias("status"),
    )


def apply_decrement(
    base: DataFrame, requests: DataFrame, key: str, field: str, amount: str = "quantity"
) -> DataFrame:
    done = guarded_decrement(base, requests, key, field, amount).where("status = 'applied'")
    new = done.select(key, F.col("new").alias("_new"))
    kind = base.schema[field].dataType
    return base.join(new, key, "left").select(
        *[F.coalesce(F.col("_new").cast(kind), F.col(c)).alias(c) if c == field else F.col(c)
          for c in base.columns]
    )


def audited_set(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    field: str,
    minimum: float = 0.0,
    tolerance: float = 0.01,
    seq: str = SEQ,
) -> DataFrame:
    """Set a number with checks, keeping the previous value.

    Returns the base columns plus ``previous`` and ``status``: ``below minimum``,
    ``unchanged`` (moves by less than ``tolerance``), ``updated`` or ``none``.
    """
    new = latest(changes.select(key, seq, F.col("value").alias("_new")), key, seq)
    joined = base.join(new.select(key, "_new"), key, "left")
    old = F.coalesce(F.col(field), F.lit(0.0))
    status = (
        F.when(F.col("_new").isNull(), "none")
        .when(F.col("_new") < minimum, "below minimum")
        .when(F.abs(old - F.col("_new")) < tolerance, "unchanged")
        .otherwise("updated")
    )
    hit = F.col("status") == "updated"
    return joined.withColumn("status", status).select(
        *[F.when(hit, F.col("_new")).otherwise(F.col(c)).alias(c) if c == field else F.col(c)
          for c in base.columns],
        F.when(hit, F.col(field)).alias("previous"),
        "status",
    )


def merged(base: DataFrame, log: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """Base table with a change log on top: the last logged row per key, tombstones hidden.

    ``log`` has the base columns plus ``seq`` and ``deleted``.
    """
    last = latest(log, key, seq)
    alive = last.where(~F.coalesce(F.col(DELETED), F.lit(False))).select(*base.columns)
    return base.join(last.select(key), key, "left_anti").unionByName(alive)


def realtime_get(
    base: DataFrame,
    pending: DataFrame,
    key: str,
    ids: Sequence | DataFrame,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Newest state of the wanted keys, pending changes included; unknown keys are absent.

    The keys are applied to both inputs before they are merged, and a literal list of keys
    reaches the scans.
    """

    def wanted(df: DataFrame) -> DataFrame:
        if isinstance(ids, DataFrame):
            return df.join(ids.select(key).distinct(), key, "left_semi")
        return df.where(F.col(key).isin(list(ids)))

    names = list(fields) if fields else base.columns
    needed = list(dict.fromkeys([key, *names]))
    logged = pending.select(*needed, SEQ, DELETED)
    return merged(wanted(base.select(*needed)), wanted(logged), key).select(*names)


def commit(
    base: DataFrame, log: DataFrame, key: str, path: str | None = None, seq: str = SEQ
) -> DataFrame:
    """Make pending changes visible: a merge-on-read view, or a new snapshot at ``path``.

    A snapshot leaves tombstones out for good. It goes to a new path, because a table cannot
    be overwritten while it is read.
    """
    view = merged(base, log, key, seq)
    if path is None:
        return view
    view.write.parquet(path)
    return base.sparkSession.read.schema(base.schema).parquet(path)
