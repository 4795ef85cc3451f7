"""Statistics, facets, terms and schema reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.functions import predicates as P
from docsieve.functions.text import index_terms
from docsieve.operators import aggregate as A
from docsieve.operators import schema as H
from docsieve.plans.registry import Tables, query, terms_sql


def with_gaps(t: Tables) -> DataFrame:
    """Events whose value is missing for errors, and whose JSON number is a column."""
    number = F.get_json_object("props", "$.k").cast("double")
    return t.events.select(
        "event_id", "event_type", "user_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"), number.alias("k"),
    )


GAPS_SQL = """
  g AS (SELECT event_id, event_type, user_id, CASE WHEN event_type <> 'error' THEN value END AS value,
          CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"""


def stats_sql(field: str, source: str) -> str:
    return f"""SELECT '{field}' AS field, min({field})::DOUBLE AS min, max({field})::DOUBLE AS max,
      count({field}) AS count, count(*) - count({field}) AS missing, round(sum({field})::DOUBLE, 4) AS sum,
      round(avg({field}), 6) AS mean, round(stddev_samp({field}), 6) AS stddev FROM {source}"""


def rounded(stats: DataFrame) -> DataFrame:
    return stats.select(
        "field", "min", "max", "count", "missing", F.round("sum", 4).alias("sum"),
        F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
    )


@query("stats_field", stats_sql("value", "(SELECT * FROM events WHERE event_type = 'click')"))
def stats_field(t: Tables) -> DataFrame:
    return rounded(A.field_stats(P.apply_filters(t.events, "event_type:click"), ["value"]))


@query(
    "stats_fields",
    f"WITH {GAPS_SQL} " + " UNION ALL ".join(stats_sql(f, "g") for f in ("value", "k", "user_id")),
)
def stats_fields(t: Tables) -> DataFrame:
    return rounded(A.field_stats(with_gaps(t), ["value", "k", "user_id"]))


@query(
    "stats_missing",
    f"""
    WITH {GAPS_SQL}
    SELECT 'value' AS field, count(value) AS count, count(*) - count(value) AS missing FROM g
    """,
)
def stats_missing(t: Tables) -> DataFrame:
    return A.fields_with_missing(with_gaps(t), ["value", "k", "user_id"])


@query(
    "facet_fields",
    """
    SELECT 'lang' AS field, lang AS value, count(*) AS count FROM documents GROUP BY lang
    UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
    UNION ALL SELECT 'tags', tag, count(*) FROM (
      SELECT unnest([lang || source, lang]) AS tag FROM documents) GROUP BY tag
    """,
)
def facet_fields(t: Tables) -> DataFrame:
    """Two plain fields and a list field."""
    tagged = t.documents.select("lang", "source", F.array(F.concat("lang", "source"), "lang").alias("tags"))
    return A.facets(tagged, ["lang", "source", "tags"])


@query(
    "search_stats",
    f"""
    WITH {terms_sql()},
    m AS (SELECT * FROM documents WHERE lang = 'en' AND doc_id IN (
            SELECT id FROM term WHERE term IN ('licensed', 'eron'))),
    v AS (SELECT 'n_chars' AS field, n_chars::DOUBLE AS v FROM m
          UNION ALL SELECT 'odd', CASE WHEN doc_id % 2 = 1 THEN doc_id END FROM m),
    s AS (SELECT field, unnest([
            {{'name': 'min', 'amount': min(v)}}, {{'name': 'max', 'amount': max(v)}}, {{'name': 'count', 'amount': count(v)::DOUBLE}},
            {{'name': 'missing', 'amount': (count(*) - count(v))::DOUBLE}}, {{'name': 'sum', 'amount': sum(v)}},
            {{'name': 'mean', 'amount': avg(v)}}, {{'name': 'stddev', 'amount': stddev_samp(v)}}]) AS x FROM v GROUP BY field)
    SELECT 'stats' AS part, field, x.name AS name, round(x.amount, 6) AS amount FROM s
    UNION ALL SELECT 'facet', 'source', source, count(*) FROM m GROUP BY source
    UNION ALL SELECT 'facet', 'tags', t, count(*) FROM (SELECT unnest([lang, source]) AS t FROM m) GROUP BY t
    """,
)
def search_stats(t: Tables) -> DataFrame:
    """Statistics of two fields and facets of a plain and a list field over one match set."""
    matches = P.apply_filters(t.wide("documents"), ["lang:en", "text:(licensed eron)"], ["text"])
    tagged = matches.withColumn("tags", F.array("lang", "source")).withColumn("odd", F.expr("CASE WHEN doc_id % 2 = 1 THEN doc_id END"))
    return A.stats_and_facets(tagged, ["n_chars", "odd"], ["source", "tags"])


DOC_TERMS = f"{terms_sql()}, tf AS (SELECT term, count(DISTINCT id) AS frequency FROM term GROUP BY term)"
TOP = "ORDER BY frequency DESC, term LIMIT"


@query("terms_top", f"WITH {DOC_TERMS} SELECT term, frequency FROM tf {TOP} 10")
def terms_top(t: Tables) -> DataFrame:
    return A.terms(t.wide("documents"), index_terms("text"))


@query("terms_prefix", f"WITH {DOC_TERMS} SELECT term, frequency FROM tf WHERE starts_with(term, 'lic') {TOP} 10")
def terms_prefix(t: Tables) -> DataFrame:
    return A.terms(t.wide("documents"), index_terms("text"), prefix="lic")


@query(
    "terms_regex",
    f"WITH {DOC_TERMS} SELECT term, frequency FROM tf WHERE regexp_full_match(term, '[a-e]+t(ion|ing)?') {TOP} 25",
)
def terms_regex(t: Tables) -> DataFrame:
    return A.terms(t.wide("documents"), index_terms("text"), regex="[a-e]+t(ion|ing)?", limit=25)


@query(
    "terms_counts",
    f"WITH {DOC_TERMS} SELECT term, frequency FROM tf WHERE frequency BETWEEN 20 AND 40 {TOP} 50",
)
def terms_counts(t: Tables) -> DataFrame:
    return A.terms(t.wide("documents"), index_terms("text"), limit=50, min_count=20, max_count=40)


@query(
    "autocomplete",
    f"WITH {DOC_TERMS} SELECT term, frequency FROM tf WHERE starts_with(term, 'eda') AND frequency >= 2 {TOP} 10",
)
def autocomplete(t: Tables) -> DataFrame:
    return A.autocomplete(t.wide("documents"), index_terms("text"), "EDA")


@query(
    "tag_cloud",
    f"""
    WITH {DOC_TERMS}, top AS (SELECT term, frequency FROM tf WHERE frequency >= 10 {TOP} 100)
    SELECT term, frequency,
      CAST(1 + floor(4 * (frequency - min(frequency) OVER ()) / (max(frequency) OVER () - min(frequency) OVER ()))
        AS INTEGER) AS size FROM top
    """,
)
def tag_cloud(t: Tables) -> DataFrame:
    return A.tag_cloud(A.terms(t.wide("documents"), index_terms("text"), limit=100, min_count=10))


@query(
    "vocab_stats",
    f"""
    WITH {DOC_TERMS}
    SELECT count(*) AS total_terms, min(frequency) AS min_frequency, max(frequency) AS max_frequency,
      round(avg(frequency), 6) AS mean_frequency FROM tf
    """,
)
def vocab_stats(t: Tables) -> DataFrame:
    stats = A.vocabulary_stats(A.term_counts(t.wide("documents"), index_terms("text")))
    return stats.withColumn("mean_frequency", F.round("mean_frequency", 6))


@query(
    "unexpected_values",
    """
    SELECT o_orderpriority AS value, count(*) AS frequency FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY ALL
    """,
)
def unexpected_values(t: Tables) -> DataFrame:
    return A.unexpected_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query(
    "expand_query",
    f"""
    WITH {DOC_TERMS}, e AS (SELECT term FROM tf WHERE starts_with(term, 'edat') {TOP} 20)
    SELECT DISTINCT id AS doc_id FROM term WHERE term IN (SELECT term FROM e)
    """,
)
def expand_query(t: Tables) -> DataFrame:
    words = A.expanded_terms(t.wide("documents"), index_terms("text"), "edat")
    return P.where_any_term(t.wide("documents"), "text", words).select("doc_id")


@query(
    "copy_sources",
    """
    SELECT column_name AS field, '' AS sources, -1 AS rows_fed FROM (DESCRIBE part)
    UNION ALL SELECT 'full_text', 'p_brand,p_name,p_type', count(*) FROM part
    UNION ALL SELECT 'facets', 'p_brand', count(p_brand) FROM part
    """,
)
def copy_sources(t: Tables) -> DataFrame:
    rules = [("p_name", "full_text"), ("p_type", "full_text"), ("p_brand", "full_text"), ("p_brand", "facets")]
    return H.copy_sources(t.part, rules).fillna({"sources": "", "rows_fed": -1})


@query(
    "add_field",
    "SELECT p_partkey, p_name, 'double' AS type, true AS empty FROM part",
)
def add_field(t: Tables) -> DataFrame:
    grown = H.add_field(t.part, "rating", "pdouble", required=False, doc_values=True)
    kind = grown.schema["rating"].dataType.simpleString()
    return grown.select(
        "p_partkey", "p_name", F.lit(kind).alias("type"), F.col("rating").isNull().alias("empty")
    )


@query("drop_field", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def drop_field(t: Tables) -> DataFrame:
    return H.drop_field(t.part, "p_type")


@query(
    "field_profile",
    """
    SELECT 'doc_id' AS field, 'numeric' AS kind, false AS searchable, true AS sortable, 'asc' AS default_direction,
      count(doc_id) AS non_null, count(DISTINCT doc_id) AS distinct_values FROM documents
    UNION ALL SELECT 'text', 'string', true, true, 'asc', count(text), count(DISTINCT text) FROM documents
    UNION ALL SELECT 'lang', 'string', true, true, 'asc', count(lang), count(DISTINCT lang) FROM documents
    UNION ALL SELECT 'source', 'string', true, true, 'asc', count(source), count(DISTINCT source) FROM documents
    UNION ALL SELECT 'n_chars', 'numeric', false, true, 'asc', count(n_chars), count(DISTINCT n_chars) FROM documents
    """,
)
def field_profile(t: Tables) -> DataFrame:
    return H.field_profile(t.documents)


@query(
    "vector_dim_check",
    """
    SELECT CAST(len(embedding) AS INTEGER) AS dimension, count(*) AS rows, len(embedding) = 64 AS matches
    FROM embeddings GROUP BY ALL
    """,
)
def vector_dim_check(t: Tables) -> DataFrame:
    return H.vector_dimensions(t.embeddings, 64)


@query(
    "required_check",
    """
    WITH x AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'doc_id' AS field, true AS present, count(*) - count(doc_id) AS rows_without FROM x
    UNION ALL SELECT 'quality', true, count(*) - count(quality) FROM x
    UNION ALL SELECT 'title', false, count(*) FROM x
    """,
)
def required_check(t: Tables) -> DataFrame:
    both = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return H.required_check(both, ["doc_id", "quality", "title"])


@query(
    "schema_diff",
    """
    SELECT 'doc_id' AS field, 'bigint' AS left_type, (SELECT count(doc_id) FROM documents) AS left_rows,
      'bigint' AS right_type, (SELECT count(doc_id) FROM labels) AS right_rows, 'common' AS verdict
    UNION ALL SELECT 'text', 'string', count(text), '', -1, 'only left' FROM documents
    UNION ALL SELECT 'lang', 'string', count(lang), '', -1, 'only left' FROM documents
    UNION ALL SELECT 'source', 'string', count(source), '', -1, 'only left' FROM documents
    UNION ALL SELECT 'n_chars', 'bigint', count(n_chars), 'int', (SELECT count(quality) FROM labels), 'type differs'
      FROM documents
    UNION ALL SELECT 'toxic', '', -1, 'int', count(toxic), 'only right' FROM labels
    """,
)
def schema_diff(t: Tables) -> DataFrame:
    renamed = t.labels.withColumnRenamed("quality", "n_chars")
    diff = H.schema_diff(t.documents, renamed)
    return diff.fillna({"left_type": "", "right_type": "", "left_rows": -1, "right_rows": -1})


@query(
    "schema_sync",
    """
    SELECT doc_id, quality, toxic, true AS new_are_empty, 'doc_id,quality,toxic,text,lang,source,n_chars' AS fields
    FROM labels
    """,
)
def schema_sync(t: Tables) -> DataFrame:
    synced = H.schema_sync(t.documents, t.labels)
    empty = F.coalesce("text", "lang", "source", F.col("n_chars").cast("string")).isNull()
    return synced.select(
        "doc_id", "quality", "toxic", empty.alias("new_are_empty"),
        F.lit(",".join(synced.columns)).alias("fields"),
    )

