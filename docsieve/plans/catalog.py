"""All named queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from docsieve.plans import (  # noqa: F401  (importing a module registers its queries)
    ordered,
    querytexts,
    reports,
    search,
    selects,
    streams,
    tables,
    texts,
    updates,
)
from docsieve.plans.registry import ORACLE, QUERIES, run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(run, name) for name in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
