"""Search clauses as boolean Columns.

One clause is ``field:value``, ``field:[low TO high]``, ``field:(one two)``, ``*:term`` or
``*:*``. Clauses are combined with ``&`` and ``|`` on the Columns, or as a filter list that
must hold as a whole. Anything richer is written as a normal Spark expression.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.functions.text import _col, copy_to_text, index_terms, may_hold_term, query_side_terms, query_terms

MATCH_ALL = "*:*"
_RANGE = re.compile(r"^\[\s*(\S+)\s+TO\s+(\S+)\s*\]$")
# Quoted text, quoted names and comments stay as they are.
_QUOTED_OR_PAIR = re.compile(
    r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/|\b([A-Za-z_]\w*):(?!:)([\w*./+:-]*[\w*./+-])""", re.S
)
_VALUE_FORM = re.compile(r"""\b([A-Za-z_]\w*)\s*=\s*'(\[\s*\S+\s+TO\s+\S+\s*\]|\([^()']+\))'""")


def has_any_term(text: Column | str, terms: Sequence[str]) -> Column:
    """True when the analysed text holds at least one of the (analysed) terms."""
    if not terms:
        return F.lit(False)
    wanted = F.array(*[F.lit(t) for t in terms])
    return may_hold_term(text, terms) & F.arrays_overlap(index_terms(text), wanted)


def has_phrase(spark: SparkSession, text: Column | str, phrase: str) -> Column:
    """True when the analysed words of the phrase follow each other in the text; none match nothing."""
    row = spark.range(0, 1, 1, 1).select(query_side_terms(F.lit(phrase)).alias("t")).first()
    if not row["t"]:
        return F.lit(False)
    line = F.concat(F.lit(" "), F.array_join(query_side_terms(text), " "), F.lit(" "))
    return line.contains(f" {' '.join(row['t'])} ")


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """Filter by a test that is expensive per row.

    The test sits in a generator of at most one row, so it is evaluated once, where it is
    written. As a plain filter it would be moved down to the scan, before the rows of a small
    table are spread over the cores.
    """
    once = F.filter(F.array(F.lit(True)), lambda _: condition)
    return df.select("*", F.explode(once).alias("_kept")).drop("_kept")


def where_any_term(df: DataFrame, text: Column | str, terms: Sequence[str]) -> DataFrame:
    """Rows whose analysed text holds one of the terms; a cheap test runs first, at the scan."""
    return keep(df.where(may_hold_term(text, terms)), has_any_term(text, terms))


def in_range(field: Column | str, low: Any, high: Any) -> Column:
    """Inclusive range; ``*`` or ``None`` leaves that end open."""
    c = _col(field)
    tests = [c >= F.lit(low)] if low not in (None, "*") else []
    tests += [c <= F.lit(high)] if high not in (None, "*") else []
    return reduce(lambda a, b: a & b, tests) if tests else c.isNotNull()


def clause(df: DataFrame, spec: str, text_fields: Iterable[str] = ()) -> Column:
    """Translate one clause. ``text_fields`` are matched by analysed term, others by value."""
    spec = spec.strip()
    if spec == MATCH_ALL:
        return F.lit(True)
    field, sep, value = spec.partition(":")
    value = value.strip()
    quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "'\""
    value = value.strip("'\"")
    if not sep or not value:
        raise ValueError(f"not a field:value clause: {spec!r}")
    if field != "*" and field not in df.columns:
        raise ValueError(f"unknown field {field!r}")
    span = _RANGE.match(value)
    if span:
        return in_range(field, *span.groups())
    words = value[1:-1] if value.startswith("(") and value.endswith(")") else value
    if field == "*":
        strings = [f.name for f in df.schema.fields if _is_text(f.dataType)]
        return has_any_term(copy_to_text(*strings), query_terms(df.sparkSession, words))
    if field in set(text_fields) and quoted:
        return has_phrase(df.sparkSession, field, value)
    if field in set(text_fields):
        return has_any_term(field, query_terms(df.sparkSession, words))
    if words is not value:
        return F.col(field).isin(words.split())
    if isinstance(df.schema[field].dataType, T.ArrayType):
        return F.array_contains(field, value)
    return F.col(field) == F.lit(value)


def _is_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return isinstance(kind, T.StringType)


def parsed(value: Any) -> Any:
    """JSON text to its value, everything else unchanged."""
    try:
        return json.loads(value) if isinstance(value, str) else value
    except ValueError:
        return value


def filter_list(filters: Any) -> list[str]:
    """One form for all filter inputs: none, text, JSON text, list or dict of field: value."""
    value = parsed(filters)
    if isinstance(value, dict):
        value = [f"{field}:{wanted}" for field, wanted in value.items()]
    if not isinstance(value, (list, tuple)):
        value = [value]
    texts = (json.dumps(v) if isinstance(v, (dict, list)) else str(v) for v in value if v)
    return [t.strip().replace(";", "") for t in texts]


def field_list(fields: Any) -> list[str]:
    """One form for all field inputs: none, ``a,b`` text, JSON text, list or dict keys."""
    value = parsed(fields)
    if isinstance(value, str):
        value = value.split(",")
    if not isinstance(value, (list, tuple, dict)):
        value = [value]
    plain = (parsed(v) for v in value if v)
    return [str(v).strip().replace(";", "") for v in plain if not isinstance(v, (dict, list))]


def apply_filters(df: DataFrame, filters: Any, text_fields: Iterable[str] = ()) -> DataFrame:
    """Keep rows that satisfy every clause; scores elsewhere are not affected.

    Clauses on values go first, so that they reach the scan and leave fewer texts to analyse.
    """
    analysed = {"*", *text_fields}
    specs = filter_list(filters)
    specs.sort(key=lambda s: s.partition(":")[0] in analysed and s.strip() != MATCH_ALL)
    for spec in specs:
        condition = clause(df, spec, text_fields)
        heavy = spec.partition(":")[0] in analysed and spec.strip() != MATCH_ALL
        df = keep(df, condition) if heavy else df.where(condition)
    return df


def expand_shorthand(sql: str) -> str:
    """Rewrite ``field:value`` in a SQL text to ``field = 'value'``, outside quotes and comments.

    Spark itself would read ``a:b`` as a path into a variant. The value may hold colons itself, as
    a timestamp does.
    """

    def rewrite(m: re.Match) -> str:
        return m.group(0) if m.group(1) is None else f"{m.group(1)} = '{m.group(2)}'"

    return _QUOTED_OR_PAIR.sub(rewrite, sql)


def expand_values(sql: str) -> str:
    """Rewrite ``field = '[low TO high]'`` to a range and ``field = '(a b)'`` to a list of values."""

    def rewrite(m: re.Match) -> str:
        field, value = m.groups()
        if value.startswith("("):
            return f"{field} IN ({', '.join(repr(v) for v in value[1:-1].split())})"
        low, high = _RANGE.match(value).groups()
        ends = [f"{field} {sign} '{end}'" for sign, end in ((">=", low), ("<=", high)) if end != "*"]
        return f"({' AND '.join(ends) or f'{field} IS NOT NULL'})"

    return _VALUE_FORM.sub(rewrite, sql)


def select_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run a SELECT with shorthand over the given DataFrames, named as ``{name}`` in the text."""
    text = expand_values(expand_shorthand(sql)).replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = text.replace(f"{{{{{name}}}}}", f"{{{name}}}")
    return spark.sql(text, **tables)
