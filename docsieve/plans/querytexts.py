"""Search by query text: boolean clauses, synonyms, several fields scored together."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.operators import keyword as K
from docsieve.operators import querysearch as Q
from docsieve.plans.registry import Tables, query, terms_sql
from docsieve.plans.search import bm25_sql, highlight_sql, rounded

# Words of the test texts stand in for a domain's own synonyms.
SYNONYMS = [["from th", "edatat"], ["licensed", "nation"], ["ring", "round band"], ["gizmo", "brass bolt"]]

PLACES = f"""{terms_sql(joined=False, name="t2")},
    place AS (SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY pos, part) AS p FROM t2)"""


def phrase_sql(*terms: str) -> str:
    """(id, tf) of terms that follow each other."""
    joins = " ".join(f"JOIN place p{i} ON p{i}.id = p0.id AND p{i}.p = p0.p + {i} AND p{i}.term = '{t}'" for i, t in enumerate(terms) if i)
    return f"SELECT p0.id, count(*) AS tf FROM place p0 {joins} WHERE p0.term = '{terms[0]}' GROUP BY p0.id"


def ranked_sql(concepts: dict[str, list[str]]) -> str:
    """CTEs ending in ``bm(id, score)``: concept -> queries of (id, tf), whose counts are added."""
    rows = " UNION ALL ".join(f"SELECT '{name}' AS c, id, tf FROM ({sql})" for name, many in concepts.items() for sql in many)
    return f"""
    {terms_sql()}, {PLACES},
    dl AS (SELECT id, count(*) AS dl FROM term GROUP BY id),
    corpus AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(dl) FROM dl)::DOUBLE / (SELECT count(*) FROM documents) AS avgdl),
    tf AS (SELECT c, id, sum(tf)::BIGINT AS tf FROM ({rows}) GROUP BY ALL),
    df AS (SELECT c, count(*) AS df FROM tf GROUP BY c),
    bm AS (SELECT id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))) AS score
           FROM tf JOIN df USING (c) JOIN dl USING (id), corpus GROUP BY id)"""


def term_sql(*terms: str) -> str:
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"SELECT id, count(*) AS tf FROM term WHERE term IN ({listed}) GROUP BY id"


BOOLEAN = '("er th" AND NOT lang:de) OR (nation AND licens* AND n_chars:[100 TO 9000]) edatat -source:(src3 src5)'


@query(
    "search_boolean",
    f"""
    WITH {ranked_sql({"er th": [phrase_sql("er", "th")], "nation": [term_sql("nation")], "edatat": [term_sql("edatat")]})},
    hit AS (
      SELECT doc_id FROM documents d WHERE source NOT IN ('src3', 'src5') AND (
        (doc_id IN ({phrase_sql("er", "th").replace(", count(*) AS tf", "")}) AND lang <> 'de')
        OR (doc_id IN (SELECT id FROM term WHERE term = 'nation') AND doc_id IN (SELECT id FROM term WHERE starts_with(term, 'licens'))
            AND n_chars BETWEEN 100 AND 9000)
        OR doc_id IN (SELECT id FROM term WHERE term = 'edatat')))
    SELECT doc_id, lang, source, round(coalesce(score, 0), 6) AS score FROM hit JOIN documents USING (doc_id) LEFT JOIN bm ON id = doc_id
    ORDER BY coalesce(bm.score, 0) DESC, doc_id LIMIT 50
    """,
)
def search_boolean(t: Tables) -> DataFrame:
    """A phrase, a pattern, a range, values of other fields, AND, OR, NOT and groups in one text."""
    hits = Q.search(t.wide("documents"), BOOLEAN, ["text"], "doc_id", rows=50)
    return rounded(hits.select("doc_id", "lang", "source", "score"), "score")


@query(
    "search_boolean_all",
    f"""
    WITH {terms_sql()}
    SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM term WHERE term IN ('nation', 'from'))
      AND NOT (n_chars > 500 AND n_chars <= 2000) AND doc_id IN (
        SELECT id FROM term WHERE regexp_matches(term, '^l.c.*$') OR levenshtein(term, 'wherer') <= 1)
    """,
)
def search_boolean_all(t: Tables) -> DataFrame:
    """Every match of a text with exclusions, a pattern inside a word and a word with one edit."""
    docs = t.wide("documents")
    asked = Q.prepared(docs, "(l?c* wherer~1) -(nation OR from) -n_chars:{500 TO 2000]", ["text"])
    return Q.matching(docs, asked).select("doc_id")


@query(
    "search_synonyms",
    f"""
    WITH {ranked_sql({"a": [phrase_sql("from", "th"), term_sql("edatat")], "b": [term_sql("licensed", "nation")]})}
    SELECT id AS doc_id, round(score, 6) AS score FROM bm ORDER BY bm.score DESC, id LIMIT 40
    """,
)
def search_synonyms(t: Tables) -> DataFrame:
    """"edatat" also finds "from th", and the other way round; what stands for one word counts as one term."""
    hits = Q.search(t.wide("documents"), "edatat nation", ["text"], "doc_id", rows=40, synonyms=SYNONYMS)
    return rounded(hits.select("doc_id", "score"), "score")


@query(
    "search_synonyms_phrase_side",
    f"""
    WITH {ranked_sql({"a": [phrase_sql("from", "th"), term_sql("edatat")], "c": [term_sql("er")]})}
    SELECT id AS doc_id, round(score, 6) AS score FROM bm
    """,
)
def search_synonyms_phrase_side(t: Tables) -> DataFrame:
    """The two words of a synonym, asked for side by side, stand for its one word; all matches."""
    docs = t.wide("documents")
    asked = Q.prepared(docs, "From TH er", ["text"], synonyms=SYNONYMS)
    return rounded(Q.scored(docs, asked).select("doc_id", "score"), "score")


@query(
    "search_synonyms_highlights",
    f"""
    WITH {bm25_sql(["gizmo"], "part", "p_partkey", "p_name")},
    hit AS (SELECT p_partkey FROM part WHERE p_partkey IN (SELECT id FROM bm) OR contains(p_name, 'brass bolt')),
    hl AS ({highlight_sql("p_name", "part", "p_partkey", "gizmos|gizmo|brass|bolts|bolt")})
    SELECT p_partkey, snippet FROM hit JOIN hl USING (p_partkey)
    """,
)
def search_synonyms_highlights(t: Tables) -> DataFrame:
    """The words of the synonyms are marked as well."""
    asked = Q.prepared(t.part, "gizmo", ["p_name"], synonyms=SYNONYMS)
    marked = K.with_highlights(Q.matching(t.part, asked), ["p_name"], Q.highlight_text(asked))
    return marked.select("p_partkey", "snippet")


ROLLUP = 'small "red widget" standard'
ROLLUP_FIELDS = {"p_name": 2.0, "p_type": 1.0}


@query(
    "keyword_rollup",
    f"""
    WITH {terms_sql("part", "p_partkey", "p_name", "a")}, {terms_sql("part", "p_partkey", "p_type", "b")},
    f AS (SELECT 'p_name' AS f, id, term, pos FROM a UNION ALL SELECT 'p_type', id, term, pos FROM b),
    dl AS (SELECT f, id, count(*) AS dl FROM f GROUP BY ALL),
    av AS (SELECT f, sum(dl)::DOUBLE / (SELECT count(*) FROM part) AS avgdl FROM dl GROUP BY f),
    tf AS (
      SELECT term AS c, f, id, count(*) AS tf FROM f WHERE term IN ('small', 'standard') GROUP BY ALL
      UNION ALL SELECT 'red widget', x.f, x.id, count(*) FROM f x JOIN f y ON x.f = y.f AND x.id = y.id AND y.pos = x.pos + 1
      WHERE x.term = 'red' AND y.term = 'widget' GROUP BY ALL),
    t AS (
      SELECT c, id, sum(CASE f WHEN 'p_name' THEN 2.0 ELSE 1.0 END * tf / (1 - 0.75 + 0.75 * dl / avgdl)) AS t
      FROM tf JOIN dl USING (f, id) JOIN av USING (f) GROUP BY ALL),
    df AS (SELECT c, count(*) AS df FROM t GROUP BY c)
    SELECT id AS p_partkey, round(sum(ln(1 + ((SELECT count(*) FROM part) - df + 0.5) / (df + 0.5)) * t / (t + 1.2)), 6) AS score
    FROM t JOIN df USING (c) GROUP BY id
    """,
)
def keyword_rollup(t: Tables) -> DataFrame:
    """Name and type searched as one text that knows its fields: own lengths, own boosts, no phrase across."""
    asked = Q.prepared(t.part, ROLLUP, ROLLUP_FIELDS)
    return rounded(Q.scored(t.part, asked).select("p_partkey", "score"), "score")
