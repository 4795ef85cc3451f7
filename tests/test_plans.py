"""Plans: no all-pairs joins anywhere, filters and columns reach the scan."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docsieve.operators import vector as V
from docsieve.plans.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    "name", ["keyword_search", "hybrid_search", "spellcheck", "knn_batch", "search_with_highlights",
             "update_multi", "page_with_total", "tag_cloud", "schema_diff", "field_profile"]
)
def test_no_all_pairs_joins(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["keyword_search"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text
    assert "ReadSchema: struct<text:string>" in text
    assert "n_chars" not in text and "TakeOrderedAndProject" in text


def test_text_is_analysed_once_per_scan(spark):
    text = plan(entry.queries()["keyword_search"](spark, FOLDER))
    filters = [line for line in text.splitlines() if line.startswith("Condition")]
    assert filters and not any("regexp_extract_all" in line for line in filters)


def test_prefilter_is_below_the_scores(spark):
    t = Tables(spark, FOLDER)
    text = plan(V.knn(t.embeddings, [1.0] * 64, "vec_id", where=F.col("label") == 3))
    assert "EqualTo(label,3)" in text and "MapInArrow" in text
