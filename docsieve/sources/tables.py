"""Collections as Parquet tables, JSON documents in and out, inventory and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.operators.schema import FIELD_TYPES


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One collection by name, ignoring case."""
    return spark.read.parquet(f"{folder}/{name.lower()}.parquet")


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """The rows dealt out to ``partitions`` tasks, where the caller asks for it.

    A file with one row group is read by one task, however many cores wait. Only the caller knows
    whether heavy work per row is worth moving the table; without a number it stays where it is.
    """
    return df.repartition(partitions) if partitions else df


def collection_schema(fields: Sequence[dict]) -> T.StructType:
    """Declared fields ``{name, type, required, multiValued, ...}`` as a Spark schema.

    Flags that Spark has no place for stay in the column metadata.
    """
    out = []
    for f in fields:
        sql = FIELD_TYPES[f["type"]]
        if f.get("multiValued"):
            sql = f"array<{sql}>"
        flags = {k: v for k, v in f.items() if k not in ("name", "type")}
        kind = T.StructType.fromDDL(f"c {sql}")["c"].dataType
        required = f.get("required", False)
        out.append(T.StructField(f["name"], kind, not required, {"field_type": f["type"], **flags}))
    return T.StructType(out)


def create_collection(
    spark: SparkSession, path: str, schema: T.StructType, rows: DataFrame | None = None
) -> DataFrame:
    """Create a collection at ``path``, replacing what was there, and return it.

    ``rows`` are matched to the schema by name; columns they lack are empty. Columns that the
    schema does not have and nulls in required fields are errors; the latter are found while the
    rows are written.
    """
    if rows is None:
        rows = spark.createDataFrame([], schema)
    else:
        missing = [f.name for f in schema.fields if not f.nullable and f.name not in rows.columns]
        if missing:
            raise ValueError(f"required fields missing: {missing}")
        unknown = [c for c in rows.columns if c not in schema.names]
        if unknown:
            raise ValueError(f"fields that the schema does not have: {unknown}")

        def value(f: T.StructField) -> Column:
            given = (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType)
            absent = F.raise_error(F.lit(f"required field {f.name} is null")).cast(f.dataType)
            return (given if f.nullable else F.coalesce(given, absent)).alias(f.name)

        rows = rows.select(*[value(f) for f in schema.fields])
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_json_documents(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Documents from files that hold a JSON array, or (``multi_line=False``) one per line.

    The schema is given, never inferred, so the files are read once. Line form is the one
    that Spark can split within a file.
    """
    return spark.read.schema(schema).json(path, multiLine=multi_line, mode="FAILFAST")


def write_json_documents(df: DataFrame, path: str) -> None:
    """One JSON document per line, one file per task. Null fields are written too."""
    df.write.option("ignoreNullFields", "false").json(path)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """(collection, row_count, field_count). Row counts come from the file footers."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("collection"), "row_count", F.lit(len(df.columns)).alias("field_count")
        )
        out = row if out is None else out.unionByName(row)
    return out


def count_documents(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_found"))


def sample_documents(df: DataFrame, key: str, rows: int = 3) -> DataFrame:
    """The first ``rows`` documents by key."""
    return df.orderBy(key).limit(rows)
