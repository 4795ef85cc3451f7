import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsieve.operators import aggregate as A
from docsieve.operators import hybrid as B
from docsieve.operators import keyword as K
from docsieve.operators import select as Q
from docsieve.operators import spelling as L
from docsieve.operators import vector as V


def hits(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, score double")


def test_blend(spark):
    keyword, near = hits(spark, (1, 4.0), (2, 2.0)), hits(spark, (2, 0.5), (3, 0.25))
    got = {r["id"]: tuple(r)[1:] for r in B.blend(keyword, near, "id").collect()}
    assert got == {1: (1.0, 0.0, 0.5), 2: (0.5, 1.0, 0.75), 3: (0.0, 0.5, 0.25)}


def test_blend_edges(spark):
    zero, near, none = hits(spark, (1, 0.0)), hits(spark, (2, 0.5)), hits(spark).limit(0)
    got = {r["id"]: r["hybrid_score"] for r in B.blend(zero, near, "id").collect()}
    assert got == {1: 0.0, 2: 0.5}
    assert [r["id"] for r in B.blend(none, near, "id").collect()] == [2]
    assert B.blend(none, none, "id").count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(size=5)], i % 3) for i in range(300)]
    data += [(i, [1.0, 0.0, 0.0, 0.0, 0.0], 0) for i in range(300, 420)] + [(420, None, 0), (421, [0.0] * 5, 1)]
    df = spark.createDataFrame(data, "id bigint, embedding array<float>, label int").repartition(5)
    return df, {i: np.array(v) for i, v, _ in data if v is not None}


def expected(known, query, k):
    def cosine(v):
        size = np.linalg.norm(v) * np.linalg.norm(query)
        return float(v @ query / size) if size else 0.0

    return sorted(((-round(cosine(v), 9), i) for i, v in known.items()))[:k]


def test_knn_with_many_ties(vectors):
    df, known = vectors
    query = [1.0, 0, 0, 0, 0]
    got = [r["id"] for r in V.knn(df, query, "id", 30).collect()]
    assert got == list(range(300, 330))
    query = [0.3, -1.0, 0.2, 0.5, 0.9]
    got = [r["id"] for r in V.knn(df, query, "id", 25).collect()]
    assert got == [i for _, i in expected(known, np.array(query), 25)]


def test_pre_and_post_filter_differ(vectors):
    df, _ = vectors
    query = [1.0, 0, 0, 0, 0]
    assert V.knn(df, query, "id", 10, where=F.col("label") == 2).count() == 10
    top = V.knn(df, query, "id", 10)
    assert V.post_filter(df, top, "id", F.col("label") == 2, 10).count() == 0


def test_batch_paths_agree(spark, vectors):
    df, known = vectors
    rng = np.random.default_rng(2)
    asked = [(q, [float(x) for x in rng.normal(size=5)]) for q in range(40)]
    queries = spark.createDataFrame(asked, "query_id bigint, query_vector array<double>")
    sent = V.knn_batch(df, queries, "id", 7)
    blocks = V.knn_batch(df, queries, "id", 7, chunk_rows=3)
    small = V.knn_batch(df, queries, "id", 7, chunk_rows=11, block_rows=13)
    a = sorted((r["query_id"], r["rank"], r["id"]) for r in sent.collect())
    b = sorted((r["query_id"], r["rank"], r["id"]) for r in blocks.collect())
    assert a == b == sorted((r["query_id"], r["rank"], r["id"]) for r in small.collect())
    # The plan is as large for a hundred times the queries.
    many = queries.crossJoin(spark.range(100)).selectExpr("query_id * 100 + id AS query_id", "query_vector")
    size = lambda q: len(V.knn_batch(df, q, "id", 7)._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(many) <= size(queries) + 5
    for q, v in asked:
        assert [i for qq, _, i in a if qq == q] == [i for _, i in expected(known, np.array(v), 7)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_corrections_by_brute_force(spark):
    rng = random.Random(5)
    vocabulary = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))): rng.randint(1, 9) for _ in range(250)}
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(2, 9))) for _ in range(60)})
    got = L.corrections(
        spark.createDataFrame([(w,) for w in words], "word string"),
        spark.createDataFrame(list(vocabulary.items()), "term string, frequency bigint"),
        F.lit(500),
    )
    wanted = set()
    for w in words:
        if len(w) < 3 or vocabulary.get(w, 0) > 5:
            continue
        near = [
            (edit_distance(w, t), -n, t) for t, n in vocabulary.items()
            if t != w and t[0] == w[0] and edit_distance(w, t) <= 2
            and 1 - edit_distance(w, t) / max(len(w), len(t)) >= 0.5
        ]
        wanted |= {(w, i + 1, t) for i, (_, _, t) in enumerate(sorted(near)[:5])}
    assert {(r["word"], r["rank"], r["suggestion"]) for r in got.collect()} == wanted


def test_highlight_fixture(spark):
    df = spark.createDataFrame(
        [(1, "Machine Learning Fundamentals", "Introduction to machine learning algorithms"), (2, "Other", None)],
        "id int, title string, content string",
    )
    got = {(r["id"], r["field"]): r["snippet"] for r in K.highlight(df, "id", ["title", "content"], "machines").collect()}
    assert got == {
        (1, "title"): "<em>Machine</em> Learning Fundamentals",
        (1, "content"): "Introduction to <em>machine</em> learning algorithms",
    }
    long = spark.createDataFrame([(1, "x " * 60 + "cat cats " + "y " * 200 + "cat")], "id int, t string")
    found = K.highlight(long, "id", ["t"], "cat", snippets=1).collect()
    assert len(found) == 1 and "<em>cat</em> <em>cats</em>" in found[0]["snippet"]
    with pytest.raises(ValueError):
        K.highlight(df, "id", ["title"], "x", method="other")


def test_search_without_terms_or_matches(spark):
    df = spark.createDataFrame([(1, "some text")], "id int, text string")
    assert K.search(df, "text", "the of", "id").count() == 0
    assert K.search(df, "text", "absent", "id").count() == 0


def test_filters_do_not_change_scores(spark):
    df = spark.createDataFrame([(i, "cat " * (i % 4) + "dog", i % 2) for i in range(40)], "id int, text string, g int")
    free = {r["id"]: r["score"] for r in K.score(df, "text", "cat").collect()}
    kept = {r["id"]: r["score"] for r in K.score(df, "text", "cat", F.col("g") == 1).collect()}
    assert kept and all(free[i] == s for i, s in kept.items())


def test_pages_are_disjoint_and_sorted(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3) for i in range(50)], "id int, v int")
    pages = [[tuple(r) for r in Q.page(df, "v desc", "id", s, 20).collect()] for s in (0, 20, 40)]
    flat = [r for p in pages for r in p]
    assert len(flat) == len(set(flat)) == 50
    assert [v for _, v in flat] == [2] * 13 + [1] * 14 + [0] * 13 + [None] * 10
    for bad in ("nope asc", "v up", "v asc x"):
        with pytest.raises(ValueError):
            Q.sort_columns(df, bad)


def test_terms_invariants(spark):
    df = spark.createDataFrame([(i, ["hot", f"t{i % 7}"]) for i in range(70)], "id int, tags array<string>")
    assert [tuple(r) for r in A.terms(df, "tags", limit=1).collect()] == [("hot", 70)]
    assert {r["term"] for r in A.terms(df, "tags", prefix="t").collect()} == {f"t{i}" for i in range(7)}
    assert A.terms(df, "tags", regex="t").count() == 0
    assert A.terms(df, "tags", min_count=5, max_count=4).count() == 0
    flat = A.tag_cloud(A.terms(df, "tags", prefix="t"))
    assert {r["size"] for r in flat.collect()} == {1}


def test_stats_row(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    assert tuple(A.field_stats(df, ["v"]).first()) == ("v", 1.0, 3.0, 2, 1, 4.0, 2.0, pytest.approx(2**0.5))
