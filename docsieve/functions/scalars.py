"""Field clean-up and naming as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.functions.text import _col

# Name suffix -> type, and the fields that a prepared document renames.
SUFFIX_TYPES = {
    "_i": "int",
    "_s": "string",
    "_l": "bigint",
    "_t": "string",
    "_b": "boolean",
    "_f": "float",
    "_d": "double",
    "_dt": "timestamp",
    "_ss": "array<string>",
    "_vector": "array<float>",
}
FIELD_SUFFIXES = {
    "section_number": "_i",
    "dimensions": "_i",
    "author": "_s",
    "vector_model": "_s",
    "date": "_dt",
    "date_indexed": "_dt",
    "category": "_ss",
    "tags": "_ss",
}


def normalize_date(value: Column | str) -> Column:
    """UTC text form: fraction dropped, date-only gets midnight, ``Z`` always at the end."""
    v = _col(value)
    return (
        F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(v, F.lit("T00:00:00Z")))
        .when(v.contains("."), F.concat(F.substring_index(v, ".", 1), F.lit("Z")))
        .when(v.endswith("Z"), v)
        .otherwise(F.concat(v, F.lit("Z")))
    )


def content_fallback(*fields: Column | str) -> Column:
    """First field that has a value, else the empty text."""
    return F.coalesce(*[_col(f) for f in fields], F.lit(""))


def preview(text: Column | str, length: int = 150) -> Column:
    t = _col(text)
    return F.when(F.length(t) > length, F.concat(F.substring(t, 1, length), F.lit("..."))).otherwise(t)


def first_value(values: Column | str) -> Column:
    """First element of a list field, null when it is empty."""
    return F.try_element_at(_col(values), F.lit(1))


def pairs(flat: Column | str) -> Column:
    """``[t1, c1, t2, c2]`` to an array of (term, frequency) structs."""
    flat = _col(flat)
    return F.transform(
        F.filter(flat, lambda _, i: i % 2 == 0),
        lambda term, i: F.struct(
            term.alias("term"), F.get(flat, i * 2 + 1).cast("bigint").alias("frequency")
        ),
    )


def lenient_json(text: Column | str, path: str) -> Column:
    """Value at ``path`` when the text is JSON, the text itself otherwise."""
    t = _col(text)
    is_json = F.try_parse_json(t).isNotNull()
    return F.when(is_json, F.get_json_object(t, path)).otherwise(t)


def suffix_of(name: str) -> str | None:
    """Longest known type suffix of a field name."""
    fits = [s for s in SUFFIX_TYPES if name.endswith(s) and len(name) > len(s)]
    return max(fits, key=len) if fits else None


def add_suffixes(df: DataFrame, suffixes: dict[str, str] = FIELD_SUFFIXES) -> DataFrame:
    """Rename fields by their type suffix and cast them; other fields stay unchanged."""
    out = []
    for field in df.schema.fields:
        suffix = suffixes.get(field.name)
        value = F.col(field.name)
        if suffix == "_dt" and isinstance(field.dataType, T.StringType):
            value = F.to_timestamp(normalize_date(value))
        elif suffix == "_ss" and not isinstance(field.dataType, T.ArrayType):
            value = F.when(value.isNotNull(), F.array(value.cast("string")))
        elif suffix:
            value = value.cast(SUFFIX_TYPES[suffix])
        out.append(value.alias(field.name + (suffix or "")))
    return df.select(*out)


def cast_by_suffix(df: DataFrame) -> DataFrame:
    """Type every column by its name suffix; values that do not fit become null."""
    out = []
    for field in df.schema.fields:
        target = SUFFIX_TYPES.get(suffix_of(field.name) or "")
        value = F.col(field.name)
        if target and target.startswith("array") and isinstance(field.dataType, T.StringType):
            value = F.split(F.regexp_replace(value, r"^\[|\]$", ""), r"\s*,\s*").try_cast(target)
        elif target == "timestamp" and isinstance(field.dataType, T.StringType):
            value = F.try_to_timestamp(normalize_date(value))
        elif target:
            value = value.try_cast(target)
        out.append(value.alias(field.name))
    return df.select(*out)


def metadata_map(df: DataFrame, reserved: list[str]) -> Column:
    """Map of every column outside ``reserved`` to its text form; nulls are left out."""
    rest = [c for c in df.columns if c not in reserved]
    entries = F.array(
        *[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in rest]
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
