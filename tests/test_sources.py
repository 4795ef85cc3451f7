import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.operators import updates as U
from docsieve.sources import markdown as M
from docsieve.sources import prepare, tables
from docsieve.streaming import changes as Z


def sections_of(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return [(r["title"], r["body"]) for r in M.explode_sections(df, "text").orderBy("section_number").collect()]


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("before\n# One\nbody\n", [("Introduction", "before"), ("One", "body")]),
        ("# One\n## Two\n\n### Three", [("Two", "")]),
        ("# One\n", [("One", "")]),
        ("# One", []),
        ("", [("Introduction", "")]),
        ("#include <x>\n####### seven\n#  \nx", [("Introduction", "#include <x>\n####### seven"), ("", "x")]),
        ("```\n# in code\n```", [("Introduction", "```"), ("in code", "```")]),
        ("#\n# A  \n x \n", [("Introduction", "#"), ("A", "x")]),
    ],
)
def test_sections(spark, text, wanted):
    assert sections_of(spark, text) == wanted


def test_section_documents_keep_their_number(spark):
    file = "---\ntags: [a, b]\nauthor: me\nid: no\n---\nintro\n# Blank\n\n# Last\nbody"
    df = spark.createDataFrame([("dir/f.md", file)], "source string, text string")
    docs = [r.asDict() for r in M.section_documents(df, "source", "text").orderBy("section_number").collect()]
    assert [(d["id"], d["title"], d["text"]) for d in docs] == [
        ("f.md_section_0", "Introduction", "intro"), ("f.md_section_2", "Last", "body")
    ]
    assert docs[0]["tags"] == ["a", "b"] and docs[0]["category"] == [] and docs[0]["extra"] == {"author": "me"}
    assert docs[0]["date_indexed"] is not None


def test_markdown_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("# T\nx\ny")
    got = M.explode_sections(M.read_markdown(spark, str(tmp_path)), "text").first()
    assert (got["title"], got["body"], got["source"].endswith("a.md")) == ("T", "x\ny", True)


def test_chunks(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, ""), (3, None)], "id int, t string")
    got = [(r["start"], r["chunk"]) for r in M.chunks(df, "id", "t", 4, 1).orderBy("start").collect()]
    assert got == [(0, "abcd"), (3, "defg"), (6, "ghij"), (9, "j")]
    with pytest.raises(ValueError):
        M.chunks(df, "id", "t", 4, 4)


def test_json_array_file(spark, tmp_path):
    docs = [{"id": "1", "title": "a\nb"}, {"id": "2", "tags": ["x"]}]
    (tmp_path / "d.json").write_text(json.dumps(docs, indent=2))
    schema = T.StructType.fromDDL("id string, title string, tags array<string>")
    got = tables.read_json_documents(spark, str(tmp_path / "d.json"), schema)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a\nb", None), ("2", None, ["x"])]


def test_required_fields(spark, tmp_path):
    schema = tables.collection_schema([{"name": "id", "type": "string", "required": True}, {"name": "n", "type": "pint"}])
    with pytest.raises(ValueError):
        tables.create_collection(spark, str(tmp_path / "c"), schema, spark.createDataFrame([(1,)], "n int"))
    made = tables.create_collection(spark, str(tmp_path / "c"), schema, spark.createDataFrame([("a", "3")], "id string, n string"))
    assert [tuple(r) for r in made.collect()] == [("a", 3)]


def test_tables_are_moved_only_when_asked(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert tables.spread(df, None) is df
    assert tables.spread(df, 3).rdd.getNumPartitions() == 3


def test_prepare_fallbacks(spark):
    df = spark.createDataFrame(
        [("1", None, "from content", "t"), ("2", "from text", None, "t"), ("3", None, None, "title")],
        "id string, text string, content string, title string",
    )
    got = {r["id"]: r for r in prepare.prepare_documents(df).collect()}
    assert got["2"]["content"] == "from text" and got["3"]["content"] is None
    assert all(r["dimensions_i"] == 64 and r["date_indexed_dt"] is not None for r in got.values())
    assert sum(x > 0 for x in got["3"]["embedding"]) == 1


CHANGES = "id int, v string, seq bigint"


def test_stream_of_several_files_and_a_restart(spark, tmp_path):
    """Later batches win, and a stream that starts again goes on where it was."""
    inbox, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    base = spark.createDataFrame([(1, "old"), (9, "stays")], "id int, v string")
    schema = T.StructType.fromDDL(CHANGES)

    def arrive(*rows):
        spark.createDataFrame(list(rows), CHANGES).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        stream = Z.read_changes(spark, inbox, schema, files_per_batch=1)
        Z.log_changes(stream, "id", log, state).awaitTermination()
        view = U.commit(base, Z.log_table(spark, log, schema), "id")
        return sorted(tuple(r) for r in view.collect())

    arrive((1, "a", 5), (1, "b", 6), (2, "c", 7))
    assert run() == [(1, "b"), (2, "c"), (9, "stays")]
    arrive((1, "late batch", 1))
    arrive((3, "d", 1))
    assert run() == [(1, "late batch"), (2, "c"), (3, "d"), (9, "stays")]
    assert run() == [(1, "late batch"), (2, "c"), (3, "d"), (9, "stays")]


def test_counters_over_several_batches(spark, tmp_path):
    inbox, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    ddl = "page string, at timestamp, who string"
    rows = [("p", "2024-01-01 00:00:01", "u"), ("p", "2024-01-01 00:00:03", "v"), ("q", "2024-01-01 00:00:02", "u")]
    for row in rows:
        one = spark.createDataFrame([row], "page string, at string, who string")
        one.select("page", F.to_timestamp("at").alias("at"), "who").coalesce(1).write.mode("append").parquet(inbox)
    stream = Z.read_changes(spark, inbox, T.StructType.fromDDL(ddl), files_per_batch=1)
    counts = Z.counters(stream, "page", "at", "who")
    Z.log_counters(counts, log, state).awaitTermination()
    got = {r["page"]: r for r in Z.counter_table(spark, log, "page", counts.schema).collect()}
    assert (got["p"]["view_count"], got["p"]["recent_viewers"], got["q"]["view_count"]) == (2, ["u", "v"], 1)
    assert got["p"]["last_viewed"].second == 3
