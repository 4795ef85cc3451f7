"""Schema changes and checks that run on the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.operators.aggregate import distinct_values
from docsieve.operators.select import default_direction

# Field type name -> Spark type. Both spellings of the point types are accepted.
FIELD_TYPES = {
    "string": "string",
    "text_general": "string",
    "text_en": "string",
    "boolean": "boolean",
    "int": "int",
    "pint": "int",
    "long": "bigint",
    "plong": "bigint",
    "float": "float",
    "pfloat": "float",
    "double": "double",
    "pdouble": "double",
    "date": "timestamp",
    "pdate": "timestamp",
    "location": "struct<lat:double,lon:double>",
    "knn_vector": "array<float>",
    "dense_vector": "array<float>",
}


def add_field(
    df: DataFrame,
    name: str,
    field_type: str,
    stored: bool = True,
    indexed: bool = True,
    required: bool = False,
    multi_valued: bool = False,
    doc_values: bool | None = None,
) -> DataFrame:
    """Add an empty column; the flags are kept as column metadata."""
    if name in df.columns:
        raise ValueError(f"field {name!r} exists")
    if field_type not in FIELD_TYPES:
        raise ValueError(f"unknown field type {field_type!r}")
    spark_type = FIELD_TYPES[field_type]
    if multi_valued:
        spark_type = f"array<{spark_type}>"
    flags = {
        "field_type": field_type,
        "stored": stored,
        "indexed": indexed,
        "required": required,
        "multiValued": multi_valued,
    }
    if doc_values is not None:
        flags["docValues"] = doc_values
    return df.select("*", F.lit(None).cast(spark_type).alias(name, metadata=flags))


def drop_field(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise ValueError(f"no field {name!r}")
    return df.drop(name)


def kind_of(field: T.StructField) -> str:
    kind = field.dataType
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
            return "vector"
        kind = kind.elementType
    if isinstance(kind, T.StringType):
        text = str(field.metadata.get("field_type", "")).startswith("text")
        return "text" if text else "string"
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "date"
    return "boolean" if isinstance(kind, T.BooleanType) else "other"


def describe_field(field: T.StructField) -> dict:
    """Kind, flags and default sort direction of one column, from its type and metadata."""
    kind = kind_of(field)
    many = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    return {
        "field": field.name,
        "kind": kind,
        "searchable": kind in ("text", "string") and field.metadata.get("indexed", True),
        "sortable": not many,
        "default_direction": None if many else default_direction(field.name),
    }


def field_profile(df: DataFrame) -> DataFrame:
    """One row per field: what it is, how many rows have it and how many values it takes."""
    spark = df.sparkSession
    known = spark.createDataFrame(
        [tuple(describe_field(f).values()) for f in df.schema.fields],
        "field string, kind string, searchable boolean, sortable boolean, default_direction string",
    )
    # JSON keeps lists whole; a facet over a list would count its elements.
    as_text = df.select(
        *[
            (F.to_json(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name))
            .cast("string")
            .alias(f.name)
            for f in df.schema.fields
        ]
    )
    found = distinct_values(as_text, df.columns)
    return known.join(found, "field", "left").fillna(0, ["non_null", "distinct_values"])


def find_vector_field(df: DataFrame) -> str:
    for field in df.schema.fields:
        if kind_of(field) == "vector":
            return field.name
    raise ValueError("no vector field")


def vector_dimensions(df: DataFrame, expected: int, field: str | None = None) -> DataFrame:
    """Row count per vector length, with a flag for lengths other than the declared one."""
    name = field or find_vector_field(df)
    return (
        df.groupBy(F.size(name).alias("dimension"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("matches", F.col("dimension") == expected)
    )


def require_dimension(df: DataFrame, expected: int, field: str | None = None) -> DataFrame:
    bad = vector_dimensions(df, expected, field).where(~F.col("matches")).limit(1).collect()
    if bad:
        raise ValueError(f"vectors of {bad[0]['dimension']} values, {expected} expected")
    return df


def required_check(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per required field: is the column there, and how many rows lack a value."""
    rows = F.count(F.lit(1))
    lines = []
    for i, name in enumerate(required):
        present = name in df.columns
        empty = F.count_if(F.col(name).isNull()) if present else rows
        lines.append((name, present, empty.alias(f"n_{i}")))
    report = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                F.lit(present).alias("present"),
                F.col(f"n_{i}").alias("rows_without"),
            )
            for i, (name, present, _) in enumerate(lines)
        ]
    )
    return df.agg(*[c for _, _, c in lines]).select(F.inline(report))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Fields of two tables side by side, with filled-row counts and a verdict per field."""

    def side(df: DataFrame, label: str) -> DataFrame:
        types = df.sparkSession.createDataFrame(
            [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
            f"field string, {label}_type string",
        )
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        return types.join(counts.unpivot([], df.columns, "field", f"{label}_rows"), "field")

    both = side(left, "left").join(side(right, "right"), "field", "full_outer")
    verdict = (
        F.when(F.col("right_type").isNull(), "only left")
        .when(F.col("left_type").isNull(), "only right")
        .when(F.col("left_type") != F.col("right_type"), "type differs")
        .otherwise("common")
    )
    return both.withColumn("verdict", verdict)


def schema_sync(source: DataFrame, target: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Add the source's missing columns (all, or those named) to the target, empty."""
    wanted = [
        f
        for f in source.schema.fields
        if f.name not in target.columns and (fields is None or f.name in fields)
    ]
    return target.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in wanted]
    )


def copy_sources(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Field list with, per copy target, its sorted sources and the rows that feed it."""
    spark = df.sparkSession
    pairs = spark.createDataFrame(list(rules), "source string, target string")
    sources = pairs.groupBy("target").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    fields = spark.createDataFrame(
        [(n,) for n in dict.fromkeys([*df.columns, *[t for _, t in rules]])], "field string"
    )
    targets = dict.fromkeys(t for _, t in rules)
    counts = df.agg(
        *[
            F.count(F.coalesce(*[F.col(s).cast("string") for s, t in rules if t == target]))
            .alias(target)
            for target in targets
        ]
    ).unpivot([], list(targets), "field", "rows_fed")
    return (
        fields.join(sources.withColumnRenamed("target", "field"), "field", "left")
        .join(counts, "field", "left")
        .select("field", F.array_join("sources", ",").alias("sources"), "rows_fed")
    )
