"""Projection, predicates, ordering, paging and plain aggregation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.functions import predicates as P
from docsieve.functions.scalars import metadata_map
from docsieve.operators import select as Q
from docsieve.operators import vector as V
from docsieve.plans.registry import Tables, query, terms_sql


@query("project_fields", "SELECT doc_id, lang FROM documents")
def project_fields(t: Tables) -> DataFrame:
    return Q.project(t.documents, "doc_id,lang")


@query("project_alias", "SELECT doc_id AS id, source AS origin FROM documents")
def project_alias(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("origin"))


@query("select_star", "SELECT * FROM part ORDER BY p_partkey LIMIT 20")
def select_star(t: Tables) -> DataFrame:
    return t.part.orderBy("p_partkey").limit(20)


@query(
    "metadata_map",
    """
    SELECT p_partkey, unnest(['p_brand', 'p_name', 'p_size', 'p_type']) AS key,
      unnest([p_brand, p_name, CAST(p_size AS VARCHAR), p_type]) AS value FROM part
    """,
)
def residual_metadata(t: Tables) -> DataFrame:
    meta = metadata_map(t.part, ["p_partkey", "p_retailprice"])
    return t.part.select("p_partkey", F.explode(meta))


@query("filter_eq", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query(
    "filter_cmp",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice >= 200000 AND o_totalprice < 400000 AND o_custkey > 100
      AND o_orderkey <= 14000 AND o_orderstatus <> 'P'
    """,
)
def filter_cmp(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    rule = (price >= 200000) & (price < 400000) & (F.col("o_custkey") > 100)
    rule = rule & (F.col("o_orderkey") <= 14000) & (F.col("o_orderstatus") != "P")
    return t.orders.where(rule).select("o_orderkey", "o_totalprice")


@query(
    "filter_in",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_in(t: Tables) -> DataFrame:
    rule = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return t.orders.where(rule).select("o_orderkey", "o_orderpriority")


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%l _i%'")
def filter_like(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_name").like("s%l _i%")).select("p_partkey", "p_name")


@query("filter_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query(
    "filter_null",
    """
    SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'unlabelled' ELSE 'labelled' END AS state
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
)
def filter_null(t: Tables) -> DataFrame:
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    without = both.where(F.col("quality").isNull()).select("doc_id", F.lit("unlabelled").alias("state"))
    having = both.where(F.col("quality").isNotNull()).select("doc_id", F.lit("labelled").alias("state"))
    return without.unionByName(having)


@query(
    "filter_bool",
    """
    SELECT doc_id, lang, source FROM documents
    WHERE (lang = 'en' AND (source = 'src1' OR n_chars > 5000)) OR (lang = 'de' AND NOT source = 'src2')
    """,
)
def filter_bool(t: Tables) -> DataFrame:
    lang, source = F.col("lang"), F.col("source")
    english = (lang == "en") & ((source == "src1") | (F.col("n_chars") > 5000))
    rule = english | ((lang == "de") & ~(source == "src2"))
    return t.documents.where(rule).select("doc_id", "lang", "source")


@query(
    "filter_shorthand",
    """
    SELECT doc_id, lang, source FROM documents
    WHERE lang = 'en' AND source = 'src3' OR text = 'a:b'
    """,
)
def filter_shorthand(t: Tables) -> DataFrame:
    sql = "SELECT doc_id, lang, source FROM {documents} WHERE lang:en AND source:src3 OR text = 'a:b'"
    return P.select_sql(t.spark, sql, documents=t.documents)


@query(
    "filter_range",
    """
    SELECT p_partkey, p_retailprice, p_size FROM part
    WHERE p_retailprice BETWEEN 950 AND 1200 AND p_size >= 25
    """,
)
def filter_range(t: Tables) -> DataFrame:
    rows = P.apply_filters(t.part, ["p_retailprice:[950 TO 1200]", "p_size:[25 TO *]"])
    return rows.select("p_partkey", "p_retailprice", "p_size")


@query(
    "filter_any_term",
    f"WITH {terms_sql()} SELECT DISTINCT id AS doc_id FROM term WHERE term IN ('licensed', 'edatat', 'theea')",
)
def filter_any_term(t: Tables) -> DataFrame:
    return P.apply_filters(t.wide("documents"), "text:(Licensed edatat theea)", ["text"]).select("doc_id")


@query("filter_list", "SELECT doc_id, n_chars FROM documents WHERE lang = 'fr' AND n_chars <= 3000")
def filter_list(t: Tables) -> DataFrame:
    return P.apply_filters(t.documents, ["lang:fr", "n_chars:[* TO 3000]"]).select("doc_id", "n_chars")


@query("filter_from_dict", "SELECT doc_id, lang, source FROM documents WHERE lang = 'es' AND source = 'src5'")
def filter_from_dict(t: Tables) -> DataFrame:
    rows = P.apply_filters(t.documents, '{"lang": "es;", "source": "src5"}')
    return rows.select("doc_id", "lang", "source")


@query("project_forms", "SELECT doc_id, lang, source, n_chars FROM documents")
def project_forms(t: Tables) -> DataFrame:
    """The same four fields, named as text, list, dict and JSON."""
    docs = Q.project(t.documents, ["doc_id", "lang", "source", "n_chars", "", None])
    docs = Q.project(docs, {"doc_id": 1, "lang": 1, "source": 1, "n_chars": 1})
    docs = Q.project(docs, '["doc_id", "lang", "source", "n_chars"]')
    return Q.project(docs, "doc_id, lang, source; ,n_chars")


@query(
    "filter_term",
    f"WITH {terms_sql()} SELECT DISTINCT id AS doc_id FROM term WHERE term = 'licensed'",
)
def filter_term(t: Tables) -> DataFrame:
    return P.apply_filters(t.wide("documents"), "text:licensed", ["text"]).select("doc_id")


@query(
    "filter_any_field",
    f"""
    WITH {terms_sql("(SELECT doc_id, concat_ws(' ', text, lang, source) AS text FROM documents)")}
    SELECT DISTINCT id AS doc_id FROM term WHERE term = 'de'
    """,
)
def filter_any_field(t: Tables) -> DataFrame:
    return P.apply_filters(t.wide("documents"), "*:de").select("doc_id")


@query("filter_false", "SELECT doc_id, lang FROM documents WHERE 1 = 0")
def filter_false(t: Tables) -> DataFrame:
    """No neighbour passes the filter, so nothing may come back."""
    probe = V.stored_vector(t.embeddings, "vec_id", 0)
    hits = V.knn(t.embeddings, probe, "vec_id", 10, where=F.col("label") < 0)
    docs = t.documents.select(F.col("doc_id").alias("vec_id"), "lang")
    kept = V.keep_neighbours(docs, hits, "vec_id", 10)
    return kept.select(F.col("vec_id").alias("doc_id"), "lang")


@query(
    "order_by",
    "SELECT p_partkey, p_brand, p_retailprice FROM part ORDER BY p_brand DESC, p_retailprice, p_partkey LIMIT 50",
)
def order_by(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_brand", "p_retailprice")
    return rows.orderBy(F.desc("p_brand"), F.asc("p_retailprice"), "p_partkey").limit(50)


@query(
    "sort_spec",
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 40
    """,
)
def sort_spec(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return Q.sort_by(rows, "o_orderpriority asc, o_totalprice desc", "o_orderkey").limit(40)


@query(
    "sort_default_dir",
    """
    SELECT doc_id, round(n_chars / 1000.0, 6) AS score FROM documents
    ORDER BY n_chars DESC, doc_id LIMIT 25
    """,
)
def sort_default_dir(t: Tables) -> DataFrame:
    """``score`` sorts best first and ``doc_id`` ascending when no direction is given."""
    scored = t.documents.select("doc_id", F.round(F.col("n_chars") / 1000.0, 6).alias("score"))
    return Q.sort_by(scored, "score, doc_id").limit(25)


@query(
    "sort_missing_last",
    """
    WITH x AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
    a AS (SELECT 'asc' AS direction, row_number() OVER (ORDER BY quality ASC NULLS LAST, doc_id) AS place,
            doc_id, quality FROM x),
    b AS (SELECT 'desc' AS direction, row_number() OVER (ORDER BY quality DESC NULLS LAST, doc_id) AS place,
            doc_id, quality FROM x)
    SELECT direction, place, doc_id, coalesce(quality, -1) AS quality
    FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
    """,
)
def sort_missing_last(t: Tables) -> DataFrame:
    both = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")

    def first(direction: str) -> DataFrame:
        rows = Q.numbered(Q.sort_by(both, f"quality {direction}", "doc_id"), "place", t.scratch("sorted"))
        return rows.select(
            F.lit(direction).alias("direction"), "place", "doc_id",
            F.coalesce("quality", F.lit(-1)).alias("quality"),
        )

    return first("asc").unionByName(first("desc"))


@query("limit_rows", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 10")
def limit_rows(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type").orderBy("event_id").limit(Q.DEFAULT_ROWS)


@query(
    "offset_fetch",
    """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey
    OFFSET 20 ROWS FETCH NEXT 15 ROWS ONLY
    """,
)
def offset_fetch(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(20).limit(15)


@query(
    "page",
    """
    SELECT 1 AS page, * FROM (SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 10)
    UNION ALL
    SELECT 2, * FROM (SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 10 OFFSET 10)
    """,
)
def page(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "value")
    pages = [Q.page(rows, "value desc", "event_id", start) for start in (0, 10)]
    return pages[0].select(F.lit(1).alias("page"), "*").unionByName(
        pages[1].select(F.lit(2).alias("page"), "*")
    )


@query(
    "page_with_total",
    """
    SELECT doc_id, n_chars, (SELECT count(*) FROM documents WHERE lang = 'en') AS num_found, 30 AS start
    FROM documents WHERE lang = 'en' ORDER BY n_chars, doc_id LIMIT 10 OFFSET 30
    """,
)
def page_with_total(t: Tables) -> DataFrame:
    matches = P.apply_filters(t.documents, "lang:en").select("doc_id", "n_chars")
    return Q.page_with_total(matches, "n_chars", "doc_id", start=30)


@query("agg_count", "SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R'")
def agg_count(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").agg(F.count("*").alias("n"))


@query(
    "agg_count_distinct",
    "SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events",
)
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.events.agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types")
    )


@query(
    "agg_basic",
    """
    SELECT min(l_quantity) AS min_qty, max(l_quantity) AS max_qty,
      round(sum(l_extendedprice), 2) AS sum_price, round(avg(l_discount), 6) AS avg_discount
    FROM lineitem
    """,
)
def agg_basic(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"),
    )


@query(
    "group_by",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
      round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_tax), 6) AS avg_tax
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def group_by(t: Tables) -> DataFrame:
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum(revenue), 2).alias("revenue"), F.round(F.avg("l_tax"), 6).alias("avg_tax"),
    )

