"""Registry of named queries. A query is a function of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docsieve.functions.text import STOP_WORDS
from docsieve.session import SPREAD_PARTITIONS, scratch_path
from docsieve.sources.tables import scan, spread

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Tables:
    """The tables of one folder as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return scan(self.spark, self.folder, name)

    def wide(self, name: str) -> DataFrame:
        """The table for work that is heavy per row, dealt out where the session says how far."""
        asked = self.spark.conf.get(SPREAD_PARTITIONS, None)
        return spread(getattr(self, name), int(asked) if asked else None)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the SQL text that must give the same rows."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return QUERIES[name](Tables(spark, folder))


# SQL pieces for the checks: the index chain written with rows instead of arrays.
STOPS_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


def stem_sql(w: str) -> str:
    return f"""CASE
      WHEN NOT ends_with({w}, 's') OR length({w}) < 3 OR ends_with({w}, 'us') OR ends_with({w}, 'ss')
        THEN {w}
      WHEN ends_with({w}, 'ies') AND length({w}) > 3 AND NOT ends_with({w}, 'aies')
           AND NOT ends_with({w}, 'eies') THEN substr({w}, 1, length({w}) - 3) || 'y'
      WHEN ends_with({w}, 'ies') OR ends_with({w}, 'aes') OR ends_with({w}, 'ees')
           OR ends_with({w}, 'oes') THEN {w}
      ELSE substr({w}, 1, length({w}) - 1) END"""


def terms_sql(
    source: str = "documents", key: str = "doc_id", text: str = "text", name: str = "term",
    joined: bool = True,
) -> str:
    """CTEs ending in ``name(id, pos, part, term)``: every index term of every text."""
    joined_forms = (
        rf", regexp_extract_all(w, '\p{{L}}+|\p{{N}}+')" if joined else ", CAST([] AS VARCHAR[])"
    )
    return rf"""
    {name}_tok AS (
      SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
      FROM (SELECT {key} AS id, regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+') AS ws FROM {source})),
    {name}_kept AS (
      SELECT id, pos, w, regexp_matches(w, '\p{{Ll}}\p{{Lu}}|\p{{L}}\p{{N}}|\p{{N}}\p{{L}}') AS inner_border
      FROM {name}_tok WHERE lower(w) NOT IN ({STOPS_SQL})),
    {name}_cut AS (
      SELECT id, pos, list_concat(
          regexp_extract_all(regexp_replace(w, '(\p{{Ll}})(\p{{Lu}})', '\1 \2', 'g'), '\p{{L}}+|\p{{N}}+')
          {joined_forms}) AS ps
      FROM {name}_kept WHERE inner_border),
    {name}_part AS (
      SELECT id, pos, 1 AS part, lower(w) AS w FROM {name}_kept WHERE NOT inner_border
      UNION ALL
      SELECT id, pos, generate_subscripts(ps, 1) AS part, lower(unnest(ps)) AS w FROM {name}_cut),
    {name} AS (
      SELECT id, pos, min(part) AS part, term
      FROM (SELECT id, pos, part, {stem_sql("w")} AS term FROM {name}_part) GROUP BY id, pos, term)"""
