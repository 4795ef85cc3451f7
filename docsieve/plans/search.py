"""Keyword, vector, semantic and blended search."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.functions.text import tokenize
from docsieve.functions.vectors import embed_text
from docsieve.operators import aggregate as A
from docsieve.operators import hybrid as B
from docsieve.operators import keyword as K
from docsieve.operators import spelling as L
from docsieve.operators import vector as V
from docsieve.plans.registry import Tables, query, terms_sql
from docsieve.plans.texts import EMBED_SQL
from docsieve.sources import positions as P
from docsieve.sources import postings as I
from docsieve.sources import suggestions as S


def bm25_sql(terms: list[str], source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs ending in ``bm(id, score)`` for the given terms."""
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"""
    {terms_sql(source, key, text)},
    dl AS (SELECT id, count(*) AS dl FROM term GROUP BY id),
    c AS (SELECT (SELECT count(*) FROM {source}) AS n,
                 (SELECT sum(dl) FROM dl)::DOUBLE / (SELECT count(*) FROM {source}) AS avgdl),
    tf AS (SELECT id, term, count(*) AS tf FROM term WHERE term IN ({listed}) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    bm AS (SELECT id, sum(ln(1 + (n - df + 0.5) / (df + 0.5))
                    * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))) AS score
           FROM tf JOIN df USING (term) JOIN dl USING (id), c GROUP BY id)"""


WORDS = "Licensed nations from the edatat"
WORD_TERMS = ["licensed", "nation", "from", "edatat"]
BM25 = bm25_sql(WORD_TERMS)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "keyword_search",
    f"""
    WITH {BM25}
    SELECT doc_id, lang, source, round(score, 6) AS score FROM bm JOIN documents ON id = doc_id
    WHERE lang = 'en' ORDER BY bm.score DESC, doc_id LIMIT 10
    """,
)
def keyword_search(t: Tables) -> DataFrame:
    hits = K.search(t.wide("documents"), "text", WORDS, "doc_id", where=F.col("lang") == "en")
    return rounded(hits.select("doc_id", "lang", "source", "score"), "score")


@query(
    "keyword_scores",
    f"WITH {BM25} SELECT id AS doc_id, round(score, 6) AS score FROM bm",
)
def keyword_scores(t: Tables) -> DataFrame:
    """Every match with its score, not only the best."""
    return rounded(K.score(t.wide("documents"), "text", WORDS).select("doc_id", "score"), "score")


@query(
    "keyword_search_postings",
    f"WITH {BM25} SELECT id AS doc_id, round(score, 6) AS score FROM bm ORDER BY bm.score DESC, id LIMIT 10",
)
def keyword_search_postings(t: Tables) -> DataFrame:
    """The same ranking from a postings table that is built first."""
    path = t.scratch("postings")
    I.build(t.wide("documents"), "doc_id", "text", path, buckets=16)
    return rounded(I.search(t.spark, path, WORDS, "doc_id"), "score")


@query(
    "keyword_field",
    f"""
    WITH {bm25_sql(["gear", "rod", "plate"], "part", "p_partkey", "p_name")}
    SELECT p_partkey, p_name, round(score, 6) AS score FROM bm JOIN part ON id = p_partkey
    ORDER BY bm.score DESC, p_partkey LIMIT 20
    """,
)
def keyword_field(t: Tables) -> DataFrame:
    """Any of several terms in one named field."""
    hits = K.search(t.part, "p_name", ["gear", "rod", "plate"], "p_partkey", rows=20)
    return rounded(hits.select("p_partkey", "p_name", "score"), "score")


# Whole-text queries for the phrase checks: places of the query-side terms.
PLACES = f"""{terms_sql(joined=False)},
    place AS (SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY pos, part) AS p FROM term)"""


@query(
    "phrase",
    f"""
    WITH {PLACES}
    SELECT DISTINCT a.id AS doc_id FROM place a JOIN place b ON a.id = b.id AND b.p = a.p + 1
    WHERE a.term = 'from' AND b.term = 'th'
    """,
)
def phrase(t: Tables) -> DataFrame:
    return K.phrase(t.wide("documents"), "text", "From th").select("doc_id")


@query(
    "phrase_slop",
    f"""
    WITH {PLACES}
    SELECT DISTINCT a.id AS doc_id FROM place a
    JOIN place b ON a.id = b.id JOIN place c ON a.id = c.id
    WHERE a.term = 'er' AND b.term = 'th' AND c.term = 'st'
      AND greatest(a.p, b.p - 1, c.p - 2) - least(a.p, b.p - 1, c.p - 2) <= 20
    """,
)
def phrase_slop(t: Tables) -> DataFrame:
    return K.near(t.wide("documents"), "text", "er th st", 20).select("doc_id")


@query(
    "phrase_postings",
    f"""
    WITH {PLACES}
    SELECT DISTINCT a.id AS doc_id FROM place a JOIN place b ON a.id = b.id AND b.p = a.p + 1
    WHERE a.term = 'from' AND b.term = 'th'
    """,
)
def phrase_postings(t: Tables) -> DataFrame:
    """The same phrase from a table of positions that is built first."""
    path = t.scratch("positions")
    P.build(t.wide("documents"), "doc_id", "text", path, buckets=16)
    return P.phrase(t.spark, path, "From th", "doc_id")


@query(
    "phrase_slop_postings",
    f"""
    WITH {PLACES}
    SELECT DISTINCT a.id AS doc_id FROM place a
    JOIN place b ON a.id = b.id JOIN place c ON a.id = c.id
    WHERE a.term = 'er' AND b.term = 'th' AND c.term = 'st'
      AND greatest(a.p, b.p - 1, c.p - 2) - least(a.p, b.p - 1, c.p - 2) <= 20
    """,
)
def phrase_slop_postings(t: Tables) -> DataFrame:
    path = t.scratch("positions")
    P.build(t.wide("documents"), "doc_id", "text", path, buckets=16)
    return P.phrase(t.spark, path, "er th st", "doc_id", slop=20)


def highlight_sql(field: str, source: str, key: str, words: str) -> str:
    """Fragments with words fenced by control characters, so that no look-around is needed."""
    return rf"""
      SELECT {key}, '{field}' AS field, CAST(rank AS INTEGER) AS rank,
        translate(regexp_replace(fenced, chr(1) || '({words})' || chr(2), '<em>\1</em>', 'gi'),
                  chr(1) || chr(2), '') AS snippet
      FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY hits DESC, pos) AS rank FROM (
        SELECT *, len(regexp_extract_all(fenced, '(?i)' || chr(1) || '({words})' || chr(2))) AS hits FROM (
          SELECT {key}, pos, regexp_replace(piece, '([\p{{L}}\p{{N}}]+)', chr(1) || '\1' || chr(2), 'g') AS fenced
          FROM (SELECT {key}, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos
                FROM (SELECT {key}, regexp_extract_all({field}, '(?s).{{1,100}}\S*\s*') AS ps FROM {source}))))
        WHERE hits > 0) WHERE rank <= 3"""


@query("highlight", highlight_sql("text", "documents", "doc_id", "licensed|licenseds|from|froms"))
def highlight(t: Tables) -> DataFrame:
    return K.highlight(t.wide("documents"), "doc_id", ["text"], "licensed from")


@query(
    "highlight_fields",
    highlight_sql("p_name", "part", "p_partkey", "ring|rings|promo|promos")
    + " UNION ALL "
    + highlight_sql("p_type", "part", "p_partkey", "ring|rings|promo|promos"),
)
def highlight_fields(t: Tables) -> DataFrame:
    return K.highlight(t.part, "p_partkey", ["p_name", "p_type"], "Ring promo")


@query(
    "search_with_highlights",
    f"""
    WITH {BM25},
    hits AS (SELECT id AS doc_id, score FROM bm ORDER BY score DESC, id LIMIT 10),
    hl AS ({highlight_sql("text", "documents", "doc_id", "licensed|licenseds|nation|nations|from|froms|edatat|edatats")})
    SELECT doc_id, round(score, 6) AS score, coalesce(rank, 0) AS rank, coalesce(snippet, '') AS snippet
    FROM hits LEFT JOIN hl USING (doc_id)
    """,
)
def search_with_highlights(t: Tables) -> DataFrame:
    """Fragments are only cut for the hits."""
    hits = K.search(t.wide("documents"), "text", WORDS, "doc_id").select("doc_id", "text", "score")
    marked = K.with_highlights(hits, ["text"], WORDS).select("doc_id", "score", "rank", "snippet")
    return rounded(marked.fillna({"rank": 0, "snippet": ""}), "score")


# levenshtein counts bytes there; one ASCII capital per accented letter makes it count letters.
@query(
    "spellcheck",
    rf"""
    WITH d AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS w FROM documents),
    v AS (SELECT lower(w) AS term, count(DISTINCT doc_id) AS frequency FROM d GROUP BY ALL),
    q AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+'))) AS word FROM benchmark),
    k AS (SELECT word FROM q WHERE length(word) >= 3 AND word NOT IN (
            SELECT term FROM v WHERE frequency > 0.01 * (SELECT count(*) FROM documents))),
    p AS (SELECT word, term, frequency, levenshtein(translate(word, 'ßäçèéêíñóöü', 'ABCDEFGHIJK'), translate(term, 'ßäçèéêíñóöü', 'ABCDEFGHIJK')) AS distance
          FROM k JOIN v
            ON substr(word, 1, 1) = substr(term, 1, 1) AND abs(length(word) - length(term)) <= 2
          WHERE word <> term),
    r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, frequency DESC, term) AS rank FROM p
          WHERE distance <= 2 AND 1 - distance / greatest(length(word), length(term)) >= 0.5)
    SELECT word, CAST(rank AS INTEGER) AS rank, term AS suggestion, CAST(distance AS INTEGER) AS distance, frequency
    FROM r WHERE rank <= 5
    """,
)
def spellcheck(t: Tables) -> DataFrame:
    """All words of the benchmark texts against the words of all documents."""
    words = F.transform(tokenize("text"), F.lower)
    asked = t.benchmark.select(F.explode(words).alias("word")).distinct()
    vocabulary = A.term_counts(t.wide("documents"), words)
    total = t.documents.agg(F.count("*")).scalar()
    return L.corrections(asked, vocabulary, total)


@query(
    "suggest",
    """
    SELECT p_name AS suggestion, max(p_retailprice) AS weight FROM part
    WHERE starts_with(p_name, 'wi') OR contains(p_name, ' wi') GROUP BY p_name
    ORDER BY weight DESC, suggestion LIMIT 10
    """,
)
def suggest(t: Tables) -> DataFrame:
    return L.suggest(t.part, "p_name", "Wi", "p_retailprice")


@query(
    "suggest_stored",
    """
    WITH e AS (SELECT p_name AS suggestion, max(p_retailprice) AS weight FROM part GROUP BY p_name),
    w AS (SELECT DISTINCT suggestion, weight, substr(unnest(regexp_extract_all(lower(suggestion), '[a-z0-9]+')), 1, 3) AS prefix FROM e),
    r AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY weight DESC, suggestion) AS rank FROM w WHERE length(prefix) = 3)
    SELECT prefix, CAST(rank AS INTEGER) AS rank, suggestion, weight FROM r WHERE rank <= 10
    """,
)
def suggest_stored(t: Tables) -> DataFrame:
    """What the stored table answers for every beginning of three letters."""
    path = t.scratch("suggestions")
    S.build(t.part, "p_name", "p_retailprice", path, buckets=8)
    stored = t.spark.read.parquet(f"{path}/prefixes")
    return stored.where(F.length("prefix") == 3).select("prefix", "rank", "suggestion", "weight")


def knn_sql(where: str = "true", probe: int = 0) -> str:
    """CTEs ending in ``near(vec_id, label, score)``, unordered."""
    return f"""
    probe AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = {probe}),
    near AS (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], q) AS score
             FROM embeddings, probe WHERE {where})"""


NEAREST = "ORDER BY score DESC, vec_id LIMIT"


def probe(t: Tables) -> list[float]:
    return V.stored_vector(t.embeddings, "vec_id", 0)


@query(
    "knn",
    f"""
    WITH {knn_sql()}, hit AS (SELECT * FROM near {NEAREST} 10)
    SELECT vec_id, round(score, 6) AS score, round(1 - score, 6) AS distance FROM hit
    """,
)
def knn(t: Tables) -> DataFrame:
    return rounded(V.knn(t.embeddings, probe(t), "vec_id"), "score", "distance")


@query(
    "knn_prefilter",
    f"""
    WITH {knn_sql("label = 3")}, hit AS (SELECT * FROM near {NEAREST} 10)
    SELECT vec_id, round(score, 6) AS score FROM hit
    """,
)
def knn_prefilter(t: Tables) -> DataFrame:
    hits = V.knn(t.embeddings, probe(t), "vec_id", where=F.col("label") == 3)
    return rounded(hits.select("vec_id", "score"), "score")


@query(
    "knn_postfilter",
    f"""
    WITH {knn_sql()}, hit AS (SELECT * FROM near {NEAREST} 50)
    SELECT vec_id, label, round(score, 6) AS score FROM hit WHERE label = 3
    """,
)
def knn_postfilter(t: Tables) -> DataFrame:
    hits = V.knn(t.embeddings, probe(t), "vec_id", 50)
    kept = V.post_filter(t.embeddings, hits, "vec_id", F.col("label") == 3, 50)
    return rounded(kept.select("vec_id", "label", "score"), "score")


@query(
    "knn_semi_join",
    f"""
    WITH {knn_sql()}, hit AS (SELECT * FROM near {NEAREST} 100)
    SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT vec_id FROM hit) AND lang = 'en'
    """,
)
def knn_semi_join(t: Tables) -> DataFrame:
    hits = V.knn(t.embeddings, probe(t), "vec_id", 100)
    docs = t.documents.where("lang = 'en'").select(F.col("doc_id").alias("vec_id"), "lang", "source")
    kept = V.keep_neighbours(docs, hits, "vec_id", 100)
    return kept.withColumnRenamed("vec_id", "doc_id")


@query(
    "vector_select",
    f"""
    WITH {knn_sql("label <> 1")}
    SELECT vec_id, label, round(score, 6) AS score, round(1 - score, 6) AS distance
    FROM near {NEAREST} 10 OFFSET 5
    """,
)
def vector_select(t: Tables) -> DataFrame:
    rows = V.vector_select(
        t.embeddings, probe(t), "vec_id", ["vec_id", "label"], F.col("label") != 1, limit=10, offset=5
    )
    return rounded(rows, "score", "distance")


@query(
    "knn_threshold",
    f"""
    WITH {knn_sql()}
    SELECT vec_id, round(score, 6) AS score, round(1 - score, 6) AS distance FROM near WHERE score >= 0.7
    """,
)
def knn_threshold(t: Tables) -> DataFrame:
    return rounded(V.within(t.embeddings, probe(t), "vec_id"), "score", "distance")


BATCH_SQL = f"""
    {EMBED_SQL.replace("term", "qterm").replace("bucket", "qbucket").replace("documents", "benchmark")
     .replace("doc_id", "item_id").replace("vec AS", "qvec AS")},
    e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS y, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
    size AS (SELECT vec_id, sqrt(sum(y * y)) AS size FROM e GROUP BY vec_id),
    dots AS (SELECT id, vec_id, sum(x * y) AS dot FROM qvec JOIN e USING (dim) GROUP BY ALL),
    ranked AS (SELECT id AS query_id, vec_id, dot / size AS score,
                 row_number() OVER (PARTITION BY id ORDER BY dot / size DESC, vec_id) AS rank
               FROM dots JOIN size USING (vec_id))
    SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ranked WHERE rank <= 10"""


@query("knn_batch", f"WITH {BATCH_SQL}")
def knn_batch(t: Tables) -> DataFrame:
    """Every benchmark text as a query vector against all stored vectors."""
    queries = t.benchmark.select(
        F.col("item_id").alias("query_id"), embed_text("text").alias("query_vector")
    )
    return rounded(V.knn_batch(t.embeddings, queries, "vec_id"), "score")


@query("knn_batch_blocks", f"WITH {BATCH_SQL}")
def knn_batch_blocks(t: Tables) -> DataFrame:
    """The same with the queries in several chunks."""
    queries = t.benchmark.select(
        F.col("item_id").alias("query_id"), embed_text("text").alias("query_vector")
    )
    return rounded(V.knn_batch(t.embeddings, queries, "vec_id", chunk_rows=16), "score")


@query(
    "knn_hits",
    f"""
    WITH {knn_sql()}, hit AS (SELECT * FROM near {NEAREST} 15)
    SELECT CAST(vec_id AS VARCHAR) AS id, round(score, 6) AS score, round(1 - score, 6) AS distance,
      'label=' || label AS metadata, count(*) OVER () AS num_found, 15 AS k FROM hit
    """,
)
def knn_hits(t: Tables) -> DataFrame:
    hits = V.knn(t.embeddings, probe(t), "vec_id", 15)
    frame = V.hit_frame(t.embeddings, hits, "vec_id", ["embedding"], 15)
    entries = F.transform(F.map_entries("metadata"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rounded(frame.withColumn("metadata", F.array_join(entries, ",")), "score", "distance")


ASK = "licensed nations from edatat"
SEMANTIC_SQL = f"""
    {EMBED_SQL},
    q AS (SELECT unnest(['licensed', 'nation', 'from', 'edatat']) AS w),
    qb AS (SELECT ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS dim, count(*) AS n FROM q GROUP BY ALL),
    qv AS (SELECT dim, n / sqrt(sum(n * n) OVER ()) AS y FROM qb),
    sem AS (SELECT doc_id, lang, source, coalesce(score, 0.0) AS score FROM documents LEFT JOIN (
              SELECT id, sum(x * y) AS score FROM vec JOIN qv USING (dim) GROUP BY id) ON id = doc_id)"""


@query(
    "semantic_select",
    f"""
    WITH {SEMANTIC_SQL}
    SELECT doc_id, lang, source, round(score, 6) AS score, round(1 - score, 6) AS distance
    FROM sem WHERE lang = 'en' ORDER BY sem.score DESC, doc_id LIMIT 10
    """,
)
def semantic_select(t: Tables) -> DataFrame:
    docs = t.wide("documents").withColumn("embedding", embed_text("text"))
    rows = B.semantic_select(docs, ASK, "doc_id", ["lang", "source"], where=F.col("lang") == "en")
    return rounded(rows, "score", "distance")


HYBRID_SQL = f"""
    {BM25}, {knn_sql()},
    kw AS (SELECT id, score / max(score) OVER () AS s FROM (SELECT * FROM bm ORDER BY score DESC, id LIMIT 10)),
    ve AS (SELECT vec_id AS id, CASE WHEN max(score) OVER () > 0 THEN score / max(score) OVER () ELSE 0 END AS s
           FROM (SELECT * FROM near {NEAREST} 10)),
    hy AS (SELECT coalesce(kw.id, ve.id) AS doc_id, coalesce(kw.s, 0) AS k, coalesce(ve.s, 0) AS v,
             coalesce(kw.s, 0) * (1 - 0.4) + coalesce(ve.s, 0) * 0.4 AS h
           FROM kw FULL JOIN ve ON kw.id = ve.id)"""


def sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    keyword = K.search(t.wide("documents"), "text", WORDS, "doc_id").select("doc_id", "score")
    vectors = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    near = V.knn(vectors, V.stored_vector(vectors, "doc_id", 0), "doc_id").select("doc_id", "score")
    return keyword, near


@query(
    "hybrid_search",
    f"""
    WITH {HYBRID_SQL}
    SELECT doc_id, round(k, 6) AS keyword_score, round(v, 6) AS vector_score, round(h, 6) AS hybrid_score
    FROM hy ORDER BY h DESC, doc_id LIMIT 10
    """,
)
def hybrid_search(t: Tables) -> DataFrame:
    keyword, near = sides(t)
    blended = B.blend(keyword, near, "doc_id", k=10, blend_factor=0.4)
    return rounded(blended, "keyword_score", "vector_score", "hybrid_score")


@query(
    "hybrid_text",
    f"""
    WITH b AS (WITH {BM25} SELECT id, score FROM bm JOIN documents ON id = doc_id WHERE lang = 'en' ORDER BY bm.score DESC, id LIMIT 10),
    v AS (WITH {SEMANTIC_SQL} SELECT doc_id AS id, score FROM sem WHERE lang = 'en' ORDER BY sem.score DESC, doc_id LIMIT 10),
    kw AS (SELECT id, score / max(score) OVER () AS s FROM b),
    ve AS (SELECT id, CASE WHEN max(score) OVER () > 0 THEN score / max(score) OVER () ELSE 0 END AS s FROM v),
    hy AS (SELECT coalesce(kw.id, ve.id) AS id, coalesce(kw.s, 0) AS k, coalesce(ve.s, 0) AS v FROM kw FULL JOIN ve ON kw.id = ve.id)
    SELECT doc_id, lang, source, round(k, 6) AS keyword_score, round(v, 6) AS vector_score,
      round(k * (1 - 0.4) + v * 0.4, 6) AS hybrid_score
    FROM hy JOIN documents ON id = doc_id ORDER BY k * (1 - 0.4) + v * 0.4 DESC, doc_id LIMIT 10
    """,
)
def hybrid_text(t: Tables) -> DataFrame:
    """One text for both sides, the same filter on both, fields on the hits."""
    docs = t.wide("documents").withColumn("embedding", embed_text("text"))
    hits = B.search(docs, ASK, "doc_id", ["lang", "source"], F.col("lang") == "en", k=10, blend_factor=0.4)
    return rounded(hits, "keyword_score", "vector_score", "hybrid_score")


@query(
    "hybrid_one_side",
    f"""
    WITH {HYBRID_SQL}
    SELECT id AS doc_id, 0.0::DOUBLE AS keyword_score, round(s, 6) AS vector_score, round(s * 0.4, 6) AS hybrid_score
    FROM ve ORDER BY s DESC, id LIMIT 10
    """,
)
def hybrid_one_side(t: Tables) -> DataFrame:
    """No keyword hit at all: the vector side alone, in the blended form."""
    near = sides(t)[1]
    nothing = K.search(t.wide("documents"), "text", ["nosuchterm"], "doc_id").select("doc_id", "score")
    blended = B.blend(nothing, near, "doc_id", k=10, blend_factor=0.4)
    return rounded(blended, "keyword_score", "vector_score", "hybrid_score")


@query(
    "compare_methods",
    f"""
    WITH {HYBRID_SQL},
    l AS (SELECT 'keyword' AS method, id AS doc_id, score FROM bm ORDER BY score DESC, id LIMIT 10),
    m AS (SELECT 'vector' AS method, vec_id AS doc_id, score FROM near {NEAREST} 10),
    n AS (SELECT 'hybrid' AS method, doc_id, h AS score FROM hy ORDER BY h DESC, doc_id LIMIT 10)
    SELECT method, doc_id, round(score, 6) AS score,
      CAST(row_number() OVER (PARTITION BY method ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM (SELECT * FROM l UNION ALL SELECT * FROM m UNION ALL SELECT * FROM n)
    """,
)
def compare_methods(t: Tables) -> DataFrame:
    keyword, near = sides(t)
    both = B.blend(keyword, near, "doc_id", k=10, blend_factor=0.4)
    hybrid = both.select("doc_id", F.col("hybrid_score").alias("score"))
    lists = B.compare({"keyword": keyword, "vector": near, "hybrid": hybrid}, "doc_id")
    return rounded(lists, "score")


@query(
    "diagnose_term",
    rf"""
    WITH {terms_sql("pages", "page_id", "html", "h")}, {terms_sql("pages", "page_id", "url", "u")}
    SELECT 'html' AS field, count(DISTINCT id) AS matches FROM h WHERE term = 'example'
    UNION ALL SELECT 'url', count(DISTINCT id) FROM u WHERE term = 'example'
    """,
)
def diagnose_term(t: Tables) -> DataFrame:
    return K.diagnose(t.wide("pages"), ["html", "url"], "examples")

