"""Projection, ordering and paging."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.functions.predicates import field_list

DEFAULT_ROWS = 10


def project(df: DataFrame, fields: Any) -> DataFrame:
    """Columns named in any accepted field-list form; all columns when none is given."""
    names = field_list(fields)
    return df.select(*names) if names else df


def order_column(field: str, direction: str) -> Column:
    """Missing values come last in both directions."""
    return F.desc_nulls_last(field) if direction == "desc" else F.asc_nulls_last(field)


def sort_columns(df: DataFrame, spec: str | None) -> list[Column]:
    """``"price asc, score desc"`` to sort columns; a bare field takes its default direction."""
    out = []
    for part in (spec or "").split(","):
        words = part.split()
        if not words:
            continue
        field, direction = words[0], words[1].lower() if len(words) > 1 else None
        if len(words) > 2 or direction not in (None, "asc", "desc"):
            raise ValueError(f"bad sort {part.strip()!r}")
        if field not in df.columns or isinstance(
            df.schema[field].dataType, (T.ArrayType, T.MapType, T.StructType)
        ):
            raise ValueError(f"cannot sort by {field!r}")
        out.append(order_column(field, direction or default_direction(field)))
    return out


def default_direction(field: str) -> str:
    """Score sorts best first; every stored field sorts ascending."""
    return "desc" if field == "score" else "asc"


def sort_by(df: DataFrame, spec: str, tie_break: str | None = None) -> DataFrame:
    cols = sort_columns(df, spec)
    if tie_break:
        cols.append(F.asc_nulls_last(tie_break))
    return df.orderBy(*cols)


def page(
    df: DataFrame, sort: str, key: str, start: int = 0, rows: int = DEFAULT_ROWS
) -> DataFrame:
    """Rows ``start`` to ``start + rows`` in a total order, so that pages never overlap."""
    return sort_by(df, sort, key).offset(start).limit(rows)


def page_with_total(
    df: DataFrame, sort: str, key: str, start: int = 0, rows: int = DEFAULT_ROWS
) -> DataFrame:
    """A page whose rows carry the number of all matches.

    The count is a scalar subquery: a window over everything would pull all rows into one
    task.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return page(df, sort, key, start, rows).withColumn("num_found", total).withColumn(
        "start", F.lit(start)
    )


def top_k(df: DataFrame, score: str, key: str, k: int = DEFAULT_ROWS) -> DataFrame:
    return df.orderBy(F.desc(score), F.asc(key)).limit(k)


def numbered(ordered: DataFrame, name: str, path: str) -> DataFrame:
    """A sorted frame with each row's place from 1 on, without bringing the rows to one task.

    The sort leaves ranges in numbered partitions. They are written to ``path`` with their ids, and
    a place is the id within the range plus the rows of the ranges before it, one row per range.
    """
    marked = ordered.withColumn("_id", F.monotonically_increasing_id())
    marked.write.parquet(path)
    rows = ordered.sparkSession.read.schema(marked.schema).parquet(path)
    part, inner = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = rows.withColumn("_part", part).join(starts, "_part")
    return placed.withColumn(name, F.col("_before") + inner + 1).drop("_id", "_part", "_before")
