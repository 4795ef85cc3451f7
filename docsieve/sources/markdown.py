"""Markdown and long texts to sections, documents and chunks.

A text is taken apart inside its row, with regular expressions and array functions, so
nothing is shuffled however long the texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.functions.text import _col, let

# Heading form, title of the text before the first heading, chunk sizes.
HEADING = r"#{1,6}[^\S\n]+[^\n]"
HEADING_TITLE = r"^#{1,6}[^\S\n]+([^\n]+)"
FIRST_TITLE = "Introduction"
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200

_FRONT_MATTER = r"(?s)^---[ \t]*\n(.*?)\n---[ \t]*(?:\n|$)"


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(source, text), one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("source"), F.col("value").alias("text")
    )


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def sections(text: Column | str) -> Column:
    """Array of (title, body), one per heading that has at least one line below it."""
    # Splitting at the line break before a heading leaves pieces that start with it.
    pieces = F.split(_col(text), rf"\n(?={HEADING})", -1)

    def has_heading(piece: Column) -> Column:
        return piece.rlike(f"^{HEADING}")

    kept = F.filter(pieces, lambda p: ~has_heading(p) | p.contains("\n"))
    return F.transform(
        kept,
        lambda p: F.when(
            has_heading(p),
            F.struct(
                strip(F.regexp_extract(p, HEADING_TITLE, 1)).alias("title"),
                strip(F.substring(p, F.locate("\n", p) + 1, F.length(p))).alias("body"),
            ),
        ).otherwise(F.struct(F.lit(FIRST_TITLE).alias("title"), strip(p).alias("body"))),
    )


def explode_sections(df: DataFrame, text: Column | str) -> DataFrame:
    """Every section as a row ``section_number, title, body`` beside the other columns."""
    return df.select(*df.columns, F.posexplode(sections(text)).alias("section_number", "_s")).select(
        *df.columns, "section_number", "_s.title", "_s.body"
    )


def front_matter(text: Column | str) -> Column:
    """Leading ``---`` block of ``key: value`` lines as a map; empty without one.

    A key's following ``- item`` lines become the value ``[item, item]``. Of a repeated key the
    last value stays.
    """
    block = F.regexp_extract(_col(text), _FRONT_MATTER, 1)
    # A list below its key is moved up into the key's line first.
    flat = F.regexp_replace(block, r"\n[ \t]*-[ \t]+", "\u0001")
    lines = F.filter(F.split(flat, "\n"), lambda s: s.rlike(r"^[^\s:#\u0001][^:]*:"))

    def entry(s: Column) -> Column:
        raw = F.regexp_replace(s, "^[^:]*:", "")
        items = F.concat(F.lit("["), F.replace(F.regexp_replace(raw, "^\\s*\u0001", ""), F.lit("\u0001"), F.lit(", ")), F.lit("]"))
        value = F.when(raw.rlike("^\\s*\u0001"), items).otherwise(strip(F.replace(raw, F.lit("\u0001"), F.lit(", "))))
        return F.struct(strip(F.substring_index(s, ":", 1)).alias("key"), value.alias("value"))

    def last_of_key(pairs: Column) -> Column:
        later = lambda x, i: F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["key"] == x["key"])
        return F.map_from_entries(F.filter(pairs, lambda x, i: ~later(x, i)))

    return let(F.transform(lines, entry), last_of_key)


def without_front_matter(text: Column | str) -> Column:
    return strip(F.regexp_replace(_col(text), _FRONT_MATTER, ""))


def list_value(value: Column) -> Column:
    """``[a, b]`` or ``a`` to an array of strings; missing or empty to an empty array."""
    inner = F.regexp_replace(value, r"^\[|\]$", "")
    items = F.filter(F.transform(F.split(inner, ","), strip), lambda s: s != "")
    return F.coalesce(items, F.array().cast("array<string>"))


# Keys that a section document sets itself.
BUILT_KEYS = ["id", "title", "text", "source", "section_number", "date_indexed", "tags", "category"]


def section_documents(df: DataFrame, source: str, text: str, clock: bool = True) -> DataFrame:
    """Documents from the sections of each text, with the front matter of the text.

    Sections with a blank body are dropped but keep their number. Other metadata goes to the
    map ``extra`` and never replaces a key that a document sets itself.
    """
    with_meta = df.select(
        F.col(source).alias("source"),
        front_matter(text).alias("_meta"),
        without_front_matter(text).alias("_text"),
    )
    rows = explode_sections(with_meta, "_text").where(F.col("body") != "")
    reserved = [*BUILT_KEYS, "categories"]
    file_name = F.substring_index("source", "/", -1)
    out = [
        F.concat(file_name, F.lit("_section_"), F.col("section_number")).alias("id"),
        "title",
        F.col("body").alias("text"),
        "source",
        "section_number",
        list_value(F.col("_meta")["tags"]).alias("tags"),
        list_value(F.col("_meta")["categories"]).alias("category"),
        F.map_filter("_meta", lambda k, _: ~k.isin(reserved)).alias("extra"),
    ]
    if clock:
        out.append(F.current_timestamp().alias("date_indexed"))
    return rows.select(*out)


def chunks(
    df: DataFrame, key: str, text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """(key, chunk_number, start, chunk): windows of ``size`` characters that share ``overlap``."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    length = F.length(text)
    starts = F.when(length > 0, F.sequence(F.lit(0), length - 1, F.lit(size - overlap)))
    return df.select(key, text, F.posexplode(starts).alias("chunk_number", "start")).select(
        key, "chunk_number", "start", F.substring(text, F.col("start") + 1, F.lit(size)).alias("chunk")
    )
