"""Text analysis and scalar clean-up over whole texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.functions import provider as M
from docsieve.functions import scalars as C
from docsieve.functions import text as X
from docsieve.functions import vectors as E
from docsieve.plans.registry import STOPS_SQL, Tables, query, stem_sql, terms_sql

WORDS_SQL = r"""
  ws AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM documents),
  w AS (SELECT doc_id, unnest(ws) AS token, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos FROM ws)"""


def positions(df: DataFrame, key: str, tokens, name: str = "token") -> DataFrame:
    return df.select(key, F.posexplode(tokens).alias("pos", name))


@query("tokenize", f"WITH {WORDS_SQL} SELECT doc_id, pos, token FROM w")
def tokenize(t: Tables) -> DataFrame:
    return positions(t.wide("documents"), "doc_id", X.tokenize("text"))


@query(
    "stop_filter",
    f"""
    WITH {WORDS_SQL}
    SELECT doc_id, count(*) AS kept, string_agg(token, ' ' ORDER BY pos) AS words
    FROM w WHERE lower(token) NOT IN ({STOPS_SQL}) GROUP BY doc_id
    """,
)
def stop_filter(t: Tables) -> DataFrame:
    kept = X.drop_stop_words(X.tokenize("text"))
    rows = t.wide("documents").select("doc_id", kept.alias("k")).where(F.size("k") > 0)
    return rows.select(
        "doc_id", F.size("k").cast("bigint").alias("kept"), F.array_join("k", " ").alias("words")
    )


@query(
    "word_delimiter",
    r"""
    WITH ws AS (SELECT page_id, regexp_extract_all(html, '[\p{L}\p{N}]+') AS ws FROM pages),
    w AS (SELECT page_id, unnest(ws) AS token FROM ws),
    d AS (SELECT token, count(*) AS seen FROM w
          WHERE regexp_matches(token, '\p{Ll}\p{Lu}|\p{L}\p{N}|\p{N}\p{L}') GROUP BY token),
    p AS (SELECT token, seen,
            regexp_extract_all(regexp_replace(token, '(\p{Ll})(\p{Lu})', '\1 \2', 'g'), '\p{L}+|\p{N}+') AS ps,
            regexp_extract_all(token, '\p{L}+|\p{N}+') AS runs FROM d)
    SELECT token, seen,
      (SELECT string_agg(x, ' ' ORDER BY i) FROM (
         SELECT x, min(i) AS i FROM (
           SELECT unnest(list_concat(ps, runs)) AS x,
                  generate_subscripts(list_concat(ps, runs), 1) AS i) GROUP BY x)) AS parts
    FROM p
    """,
)
def word_delimiter(t: Tables) -> DataFrame:
    """Index-side parts of every word of the pages that has an inner border."""
    words = t.wide("pages").select(F.explode(X.tokenize("html")).alias("token"))
    seen = words.where(F.col("token").rlike(X.INNER_BOUNDARY)).groupBy("token").agg(
        F.count("*").alias("seen")
    )
    return seen.withColumn("parts", F.array_join(X.word_parts("token"), " "))


@query("analyze", f"WITH {terms_sql()} SELECT id AS doc_id, term, count(*) AS tf FROM term GROUP BY id, term")
def analyze(t: Tables) -> DataFrame:
    terms = t.wide("documents").select("doc_id", F.explode(X.index_terms("text")).alias("term"))
    return terms.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


@query(
    "stem_plural",
    f"""
    WITH {WORDS_SQL}, v AS (SELECT DISTINCT lower(token) AS word FROM w)
    SELECT word, {stem_sql("word")} AS stem FROM v
    """,
)
def stem_plural(t: Tables) -> DataFrame:
    words = t.wide("documents").select(F.explode(X.tokenize("text")).alias("token"))
    return words.select(F.lower("token").alias("word")).distinct().withColumn("stem", X.stem("word"))


@query(
    "dedupe_tokens",
    f"""
    WITH {WORDS_SQL}, s AS (SELECT doc_id, pos // 2 AS place, lower(token) AS token FROM w)
    SELECT doc_id, count(*) AS before, count(DISTINCT place || ':' || token) AS after FROM s GROUP BY doc_id
    """,
)
def dedupe_tokens(t: Tables) -> DataFrame:
    """Two neighbouring words share a place here; repeats elsewhere in the text stay."""
    placed = F.transform(
        X.tokenize("text"),
        lambda w, i: F.struct(F.floor(i / 2).alias("place"), F.lower(w).alias("token")),
    )
    # Asked of the text, whose first word answers; a filter on the array would cut every text twice.
    rows = t.wide("documents").where(F.col("text").rlike(X.WORD)).select("doc_id", placed.alias("p"))
    return rows.select(
        "doc_id", F.size("p").cast("bigint").alias("before"),
        F.size(X.dedupe_at_position("p")).cast("bigint").alias("after"),
    )


SYNONYMS = [["red", "crimson"], ["ring", "band", "hoop"], ["HOT", "warm"]]


@query(
    "synonym_expand",
    """
    WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part),
    s(word, synonym) AS (VALUES ('red', 'crimson'), ('ring', 'band'), ('ring', 'hoop'), ('hot', 'warm'))
    SELECT p_partkey, word FROM w
    UNION SELECT p_partkey, synonym FROM w JOIN s USING (word)
    """,
)
def synonym_expand(t: Tables) -> DataFrame:
    names = t.part.select("p_partkey", X.tokenize("p_name").alias("words"))
    expanded = X.with_synonyms("words", SYNONYMS)
    return names.select("p_partkey", F.explode(expanded).alias("word"))


@query(
    "copy_to_text",
    "SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type, 'size', p_brand) AS full_text FROM part",
)
def copy_to_text(t: Tables) -> DataFrame:
    tags = F.array(F.lit("size"), F.col("p_brand"))
    text = X.copy_to_text("p_name", "p_brand", F.lit(None).cast("string"), "p_type", tags)
    return t.part.select("p_partkey", text.alias("full_text"))


@query(
    "analyze_trace",
    rf"""
    WITH {terms_sql("benchmark", "item_id")}
    SELECT id AS item_id, '1_words' AS stage, string_agg(w, ' ' ORDER BY pos) AS value FROM term_tok GROUP BY id
    UNION ALL
    SELECT id, '2_stop_words', string_agg(w, ' ' ORDER BY pos) FROM term_kept GROUP BY id
    UNION ALL
    SELECT id, '3_word_parts', string_agg(w, ' ' ORDER BY pos, part) FROM (
      SELECT id, pos, 1 AS part, w FROM term_kept WHERE NOT inner_border
      UNION ALL SELECT id, pos, generate_subscripts(ps, 1), unnest(ps) FROM term_cut) GROUP BY id
    UNION ALL
    SELECT id, '4_lower_case', string_agg(w, ' ' ORDER BY pos, part) FROM term_part GROUP BY id
    UNION ALL
    SELECT id, '5_stem', string_agg({stem_sql("w")}, ' ' ORDER BY pos, part) FROM term_part GROUP BY id
    UNION ALL
    SELECT id, '6_distinct', string_agg(term, ' ' ORDER BY pos, part) FROM term GROUP BY id
    """,
)
def analyze_trace(t: Tables) -> DataFrame:
    stages = X.analysis_stages("text")
    rows = t.benchmark.select("item_id", *[c.alias(n) for n, c in stages.items()])
    return rows.unpivot("item_id", list(stages), "stage", "value")


@query(
    "normalize_dates",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, epoch(o_orderdate)::BIGINT AS seconds
    FROM orders
    """,
)
def normalize_dates(t: Tables) -> DataFrame:
    """Four written forms of a date become one."""
    d = F.col("o_orderdate")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(F.col("o_custkey") % 2 == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
    )
    iso = t.orders.select("o_orderkey", C.normalize_date(raw).alias("iso"))
    return iso.withColumn("seconds", F.unix_seconds(F.to_timestamp("iso")))


def raw_documents(t: Tables) -> DataFrame:
    """Documents with the field names that preparation renames."""
    return t.wide("documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), "text",
        F.col("n_chars").alias("section_number"), F.col("lang").alias("author"),
        F.lit("2024-01-02T03:04:05.123456").alias("date"),
        F.array("lang", "source").alias("tags"), F.col("lang").alias("category"),
    )


@query(
    "suffix_fields",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, source AS title, text, CAST(n_chars AS INTEGER) AS section_number_i,
      lang AS author_s, '2024-01-02 03:04:05' AS date_dt, lang || ',' || source AS tags_ss,
      lang AS category_ss FROM documents
    """,
)
def suffix_fields(t: Tables) -> DataFrame:
    named = C.add_suffixes(raw_documents(t))
    return named.select(
        "id", "title", "text", "section_number_i", "author_s",
        F.date_format("date_dt", "yyyy-MM-dd HH:mm:ss").alias("date_dt"),
        F.array_join("tags_ss", ",").alias("tags_ss"),
        F.array_join("category_ss", ",").alias("category_ss"),
    )


@query(
    "dynamic_cast",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, coalesce(TRY_CAST(p_size AS INTEGER), -1) AS size_i,
      p_partkey AS key_l, p_retailprice AS price_d, p_size > 25 AS big_b,
      -1.0::DOUBLE AS bad_d, p_brand || '|' || p_type AS tags_ss FROM part
    """,
)
def dynamic_cast(t: Tables) -> DataFrame:
    """Everything arrives as text; ``bad_d`` holds text that is no number."""
    raw = t.part.select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_size").cast("string").alias("size_i"),
        F.col("p_partkey").cast("string").alias("key_l"),
        F.col("p_retailprice").cast("string").alias("price_d"),
        (F.col("p_size") > 25).cast("string").alias("big_b"), F.col("p_name").alias("bad_d"),
        F.concat(F.lit("["), "p_brand", F.lit(", "), "p_type", F.lit("]")).alias("tags_ss"),
    )
    typed = C.cast_by_suffix(raw)
    return typed.fillna({"size_i": -1, "bad_d": -1.0}).withColumn(
        "tags_ss", F.array_join("tags_ss", "|")
    )


@query(
    "content_fallback",
    """
    SELECT doc_id, CASE WHEN lang = 'en' THEN text WHEN lang = 'fr' THEN source WHEN lang = 'de' THEN lang
      ELSE '' END AS content FROM documents
    """,
)
def content_fallback(t: Tables) -> DataFrame:
    lang = F.col("lang")
    fields = [F.when(lang == "en", F.col("text")), F.when(lang == "fr", F.col("source")),
              F.when(lang == "de", lang)]
    return t.documents.select("doc_id", C.content_fallback(*fields).alias("content"))


@query(
    "preview",
    """
    SELECT doc_id, CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END AS preview
    FROM documents
    """,
)
def preview(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", C.preview("text").alias("preview"))


@query(
    "first_value_of",
    r"SELECT page_id, coalesce(regexp_extract_all(html, '<p>([^<]*)</p>', 1)[1], 'none') AS first FROM pages",
)
def first_value_of(t: Tables) -> DataFrame:
    values = F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), F.lit(1))
    return t.pages.select("page_id", F.coalesce(C.first_value(values), F.lit("none")).alias("first"))


@query(
    "pairs_to_rows",
    """
    SELECT p_partkey, unnest([p_name, p_brand]) AS term, unnest([CAST(p_size AS BIGINT), p_partkey]) AS frequency
    FROM part
    """,
)
def pairs_to_rows(t: Tables) -> DataFrame:
    flat = F.array("p_name", F.col("p_size").cast("string"), "p_brand", F.col("p_partkey").cast("string"))
    return t.part.select("p_partkey", F.inline(C.pairs(flat)))


@query(
    "json_extract",
    """
    WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN event_type ELSE props END AS raw FROM events)
    SELECT event_id, CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.k') ELSE raw END AS k FROM e
    """,
)
def json_extract(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("props"))
    return t.events.select("event_id", C.lenient_json(raw, "$.k").alias("k"))


@query(
    "vector_text",
    """
    SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dimension,
      round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total FROM embeddings
    """,
)
def vector_text(t: Tables) -> DataFrame:
    """Vector to text and back."""
    text = t.embeddings.select("vec_id", E.vector_to_text("embedding").alias("v"))
    back = text.select("vec_id", E.text_to_vector("v").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return back.select("vec_id", F.size("v").alias("dimension"), F.round(total, 6).alias("total"))


@query(
    "l2_normalize",
    """
    WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim
               FROM embeddings)
    SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS x
    FROM v
    """,
)
def l2_normalize(t: Tables) -> DataFrame:
    unit = t.embeddings.select("vec_id", F.posexplode(E.l2_normalize("embedding")).alias("dim", "x"))
    return unit.withColumn("x", F.round("x", 6))


EMBED_SQL = f"""
  {terms_sql()},
  bucket AS (SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS dim, count(*) AS n
             FROM term GROUP BY ALL),
  vec AS (SELECT id, dim, n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS x FROM bucket)"""


@query(
    "embed_text",
    f"WITH {EMBED_SQL} SELECT id AS doc_id, CAST(dim AS INTEGER) AS dim, round(x, 6) AS x FROM vec",
)
def embed_text(t: Tables) -> DataFrame:
    dims = t.wide("documents").select("doc_id", F.posexplode(E.embed_text("text")).alias("dim", "x"))
    return dims.where(F.col("x") > 0).withColumn("x", F.round("x", 6))


@query(
    "embed_udf",
    """
    SELECT doc_id, CAST(dim AS INTEGER) AS dim, CAST(n AS DOUBLE) AS n FROM (
      SELECT doc_id, unnest([0, 1, 2]) AS dim,
        unnest([length(text), length(text) - length(replace(text, ' ', '')),
                length(text) - length(replace(text, 'e', ''))]) AS n FROM documents)
    """,
)
def embed_udf(t: Tables) -> DataFrame:
    """A model in the UDF slot: three letter counts per text, in Arrow batches."""

    def letters(texts: list[str]) -> list[list[float]]:
        return [[float(len(s)), float(s.count(" ")), float(s.count("e"))] for s in texts]

    embed = E.embedding_udf(letters)
    dims = t.wide("documents").select("doc_id", F.posexplode(embed("text")).alias("dim", "n"))
    return dims.withColumn("n", F.col("n").cast("double"))


def hashed_words():
    """A model with a state of its own: buckets of words it has met, made anew in every task and when there are many."""
    import hashlib

    seen: dict[str, int] = {}

    def bucket(word: str) -> int:
        if word not in seen:
            if len(seen) >= 100_000:
                seen.clear()
            seen[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 64
        return seen[word]

    def vectors(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * 64
            for word in text.split():
                v[bucket(word)] += 1.0
            size = sum(x * x for x in v) ** 0.5
            out.append([x / size for x in v] if size else v)
        return out

    return vectors


@query(
    "embed_provider",
    f"""
    WITH {EMBED_SQL}
    SELECT id AS doc_id, 'hashed-words' AS vector_model, 64 AS dimensions, CAST(dim AS INTEGER) AS dim, round(CAST(CAST(x AS FLOAT) AS DOUBLE), 5) AS x FROM vec
    """,
)
def embed_provider(t: Tables) -> DataFrame:
    """A provider with a name and a dimension gives what the built-in hashing gives."""
    provider = M.Provider("hashed-words", 64, hashed_words)
    terms = t.wide("documents").select("doc_id", F.array_join(X.index_terms("text"), " ").alias("terms"))
    vectors = M.with_vectors(terms, "terms", provider)
    dims = vectors.select("doc_id", "vector_model", "dimensions", F.posexplode("embedding").alias("dim", "x"))
    return dims.where("x > 0").withColumn("x", F.round(F.col("x").cast("double"), 5))


@query("mock_vectors", "SELECT doc_id, 64 AS dimension, 1.0::DOUBLE AS length FROM documents")
def mock_vectors(t: Tables) -> DataFrame:
    vectors = t.wide("documents").select("doc_id", E.mock_vector("doc_id").alias("v"))
    return vectors.select(
        "doc_id", F.size("v").alias("dimension"), F.round(E.norm("v"), 9).alias("length")
    )
