"""Cases beside the registered examples: bad vectors, quoted values, repeated keys, missing places."""

import pytest
from pyspark.sql import functions as F

from docsieve.functions import predicates as P
from docsieve.functions import vectors as E
from docsieve.operators import select as Q
from docsieve.operators import updates as U
from docsieve.operators import vector as V
from docsieve.operators.schema import require_dimension
from docsieve.sources import markdown, postings, tables


def vectors(spark, *rows):
    return spark.createDataFrame(rows, "id long, embedding array<float>")


def test_a_vector_of_another_length_is_an_error(spark):
    mixed = vectors(spark, (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0, 0.0]))
    with pytest.raises(Exception, match="values where the query has 4"):
        V.knn(mixed, [1.0, 0, 0, 0], "id").collect()
    two = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "query_id long, query_vector array<double>")
    with pytest.raises(ValueError, match="query vectors"):
        V.knn_batch(mixed, two, "id").collect()


def test_null_queries_and_rows_have_no_neighbours(spark):
    base = vectors(spark, (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]))
    asked = spark.createDataFrame([(7, [1.0, 0.0]), (8, None)], "query_id long, query_vector array<double>")
    got = V.knn_batch(base, asked, "id", 5).collect()
    assert [(r["query_id"], r["id"], r["rank"]) for r in got] == [(7, 1, 1), (7, 3, 2)]
    assert V.knn_batch(base, asked.where("query_vector IS NULL"), "id").count() == 0


def test_quoted_value_is_a_phrase(spark):
    docs = spark.createDataFrame([(1, "machine tools and learning"), (2, "on machine learning")], "id long, text string")
    assert [r["id"] for r in P.apply_filters(docs, ['text:"machine learning"'], ["text"]).collect()] == [2]
    assert P.apply_filters(docs, ["text:machine"], ["text"]).count() == 2


def test_sql_text(spark):
    assert P.expand_shorthand("ts:2024-01-01T00:00:00Z") == "ts = '2024-01-01T00:00:00Z'"
    assert P.expand_shorthand("\"a:b\" `c:d` -- e:f") == "\"a:b\" `c:d` -- e:f"
    docs = spark.createDataFrame([(1, "x{y"), (5, "b"), (9, "c")], "n long, s string")
    ids = lambda sql: [r["n"] for r in P.select_sql(spark, sql, docs=docs).collect()]
    assert ids("SELECT n FROM {docs} WHERE n = '[1 TO 5]' ORDER BY n") == [1, 5]
    assert ids("SELECT n FROM {docs} WHERE n = '[5 TO *]' ORDER BY n") == [5, 9]
    assert ids("SELECT n FROM {docs} WHERE s = '(b c)' ORDER BY n") == [5, 9]
    assert ids("SELECT n FROM {docs} WHERE s = 'x{y'") == [1]


def test_front_matter_repeats_and_lists(spark):
    text = "---\ntitle: a\ntags:\n  - x\n  - y z\ntitle: b\n---\nbody"
    row = spark.createDataFrame([(text,)], "t string").select(markdown.front_matter("t").alias("m")).first()
    assert row["m"] == {"tags": "[x, y z]", "title": "b"}


def test_postings_search_without_terms(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two")], "id long, text string")
    postings.build(docs, "id", "text", str(tmp_path / "p"), buckets=2)
    assert postings.search(spark, str(tmp_path / "p"), "the and", "id").count() == 0


def test_a_change_needs_a_place(spark):
    base = spark.createDataFrame([(1, "a")], "id long, v string")
    changes = spark.createDataFrame([(1, "b", None)], "id long, v string, seq long")
    with pytest.raises(Exception, match="has no seq"):
        U.latest(changes, "id").collect()
    assert base.count() == 1


def test_required_and_unknown_fields(spark, tmp_path):
    schema = tables.collection_schema([{"name": "id", "type": "string", "required": True}])
    with pytest.raises(Exception, match="required field id is null"):
        tables.create_collection(spark, str(tmp_path / "a"), schema, spark.createDataFrame([(None,)], "id string"))
    with pytest.raises(ValueError, match="does not have"):
        tables.create_collection(spark, str(tmp_path / "b"), schema, spark.createDataFrame([("1", 2)], "id string, x int"))


def test_bucket_counts(spark):
    got = spark.range(1).select(
        E.bucket_counts(F.array(*[F.lit(i) for i in (3, 0, 3, 5)]), 7).alias("v"),
        E.bucket_counts(F.array().cast("array<bigint>"), 3).alias("none"),
    ).first()
    assert got["v"] == [1, 0, 0, 2, 0, 1, 0] and got["none"] == [0, 0, 0]


def test_places_of_a_sorted_frame(spark, tmp_path):
    rows = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("h"), "id")
    placed = Q.numbered(rows.orderBy("h", "id"), "place", str(tmp_path / "s")).collect()
    assert [r["place"] for r in sorted(placed, key=lambda r: (r["h"], r["id"]))] == list(range(1, 1001))


def test_dimension_report(spark):
    require_dimension(vectors(spark, (1, [1.0, 2.0])), 2)
