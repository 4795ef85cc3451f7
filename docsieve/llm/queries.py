"""The numbered queries over the test tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.llm import (
    collocations, fingerprints, htmltext, licenses, linededup, mixing, nearjoin, packing, prefixtrie, quality, repeats, urls, warc,
)
from docsieve.llm.common import held, n_words, whole, written

Query = Callable[[SparkSession, str], DataFrame]
W_SQL = r"'[^\x20\x09-\x0D]+'"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", n_words(whole(F.col("text"))).alias("size"))
    drawn = mixing.copies(written(docs, "sizes"), key="doc_id", source="source", size="size")
    return drawn.select(
        "doc_id", "size",
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("size")).alias("taken"),
    )


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce('a' || source, 'b') AS s,
    len(regexp_extract_all(coalesce(text, ''), {W_SQL}))::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3) AS block
  FROM documents),
per AS (SELECT s, sum(size)::BIGINT AS source_size FROM d GROUP BY s),
w AS (
  SELECT s, source_size, source_size * 3.0::DOUBLE AS cap,
    ([1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE])[((row_number() OVER (ORDER BY s) - 1) % 3 + 1)::INT] AS w
  FROM per),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT s, source_size, least(cap, max(level) OVER () * w) AS target,
    (('0x' || substr(md5('mix' || s), 1, 4))::INT + 0.5::DOUBLE) / 65536 AS o
  FROM l),
r AS (
  SELECT d.*, t.source_size, t.target, t.o, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.s ORDER BY size, block, doc_id) AS rank
  FROM d JOIN t USING (s))
SELECT doc_id, size, source_size, target,
  ((floor(rate * rank + o) - floor(rate * (rank - 1) + o)) * size)::BIGINT AS taken FROM r"""


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = htmltext.main_text(_table(spark, folder, "pages"), "url", "html", ["page_id", "url"])
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    cut = repeats.without_repeats(docs, "doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return cut.select(
        "doc_id", F.octet_length(whole(F.col("text"))).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, doc_id, unnest(range(0, len(h) // 2 - 49)) AS i, h FROM d),
s AS (SELECT rid, doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS x FROM w),
f AS (SELECT x, min(doc_id) AS least FROM s GROUP BY x),
c AS (SELECT rid, i FROM s JOIN f USING (x) WHERE least < doc_id),
g AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 50 THEN 0 ELSE 1 END AS head FROM c),
n AS (SELECT rid, i, sum(head) OVER (PARTITION BY rid ORDER BY i) AS run FROM g),
r AS (SELECT rid, run, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY rid, run),
k AS (
  SELECT rid, run, b, a, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY run), 0) AS since FROM r),
j AS (
  SELECT d.rid, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY run) AS head, max(b) AS last,
    sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans
  FROM k JOIN d USING (rid) GROUP BY d.rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN j USING (rid)"""


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "lang", "text")
    measured = written(quality.features(docs, "text").drop("text"), "features")
    verdicts = quality.judged(measured, _table(spark, folder, "labels"), "doc_id", "lang", F.col("quality") == 1)
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _op4_sql() -> str:
    score = {rule: sql.replace(" / ", "::DOUBLE / ") for rule, (sql, _) in quality.RULES.items()}
    safe = lambda rule: f"coalesce(CASE WHEN isfinite({score[rule]}) THEN {score[rule]} END, 0)"
    tried = [(rule, c) for rule, (_, grid) in quality.RULES.items() for c in grid]
    counts = ", ".join(f"{{'rule': '{r}', 'cut': {c}::DOUBLE, 'k': count(*) FILTER ({safe(r)} > {c})}}" for r, c in tried)
    over = " OR ".join(
        f"{safe(r)} > coalesce((SELECT min(cut) FROM best b WHERE b.s = f.s AND b.rule = '{r}'), 'infinity'::DOUBLE)"
        for r in quality.RULES
    )
    p = f"({quality.MAX_LOSS}::DOUBLE / {len(quality.RULES)})"
    return rf"""
WITH t AS (SELECT doc_id, coalesce('a' || lang, 'b') AS s, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, {W_SQL}) AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {W_SQL})) AS ls FROM t),
tri AS (
  SELECT *, list_transform(range(1, greatest(len(ws) - 2, 0) + 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS g FROM w),
rep AS (
  SELECT *, (SELECT list(x) FROM (SELECT unnest(g) AS x GROUP BY x HAVING count(*) > 1)) AS dup FROM tri),
cov AS (
  SELECT doc_id, s, text, ws, ls,
    list_distinct(flatten(list_transform(
      list_filter(range(1, len(g) + 1), lambda i: list_contains(dup, g[i])), lambda i: [i, i + 1, i + 2]))) AS covered
  FROM rep),
f AS (
  SELECT doc_id, s, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
    (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(len(covered), 0)::BIGINT AS n_repeat_words FROM cov),
fb AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
good AS (
  SELECT * FROM fb WHERE NOT base_failed AND doc_id IN
    (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1)),
st AS (SELECT s, count(*) AS n, [{counts}] AS tried FROM good GROUP BY s),
terms AS (
  SELECT s, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))
    OVER (PARTITION BY s ORDER BY i) AS cdf
  FROM (SELECT s, n::DOUBLE AS n, unnest(range(0, floor(n * {p})::BIGINT + 1)) AS i FROM st)),
most AS (
  SELECT s, coalesce(max(i) FILTER (cdf <= {quality.ERROR}::DOUBLE / ((SELECT count(*) FROM st) * {len(tried)})), -1) AS most
  FROM terms GROUP BY s),
best AS (
  SELECT s, x.rule AS rule, min(x.cut) AS cut FROM (SELECT s, unnest(tried) AS x FROM st) JOIN most USING (s)
  WHERE x.k <= most GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({over}) AS kept FROM fb f"""


# host, path, verdict
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The list is made of the pages' own links: addresses seen with a campaign parameter."""
    pages = _table(spark, folder, "pages")
    listed = pages.where(F.col("url").rlike("[?&]utm_source=")).select(urls.canonical(F.col("url")).alias("key"))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    verdicts = urls.judged(pages, "url", rules, listed).withColumnRenamed("url", "_url")
    joined = pages.join(verdicts, pages["url"].eqNullSafe(verdicts["_url"]))
    return joined.select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS q
  FROM pages),
c AS (
  SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS key FROM p),
r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT page_id, url, host, path, key, (
    SELECT max({'n': len(h || p), 'rule': h || p, 'v': v}) FROM r
    WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, p)) AS best FROM c)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.v, CASE WHEN key IN (SELECT key FROM c WHERE regexp_matches(url, '[?&]utm_source=')) THEN 'block' ELSE 'allow' END) AS verdict
FROM m"""


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(_table(spark, folder, "documents"), "doc_id", "text")
    return found.withColumnRenamed("key", "doc_id")


def _op6_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ", ".join(
        f"({i}, {quoted(r.label)}, {r.tier}, [{', '.join(map(quoted, licenses.gates(r)))}], {quoted(licenses.regex(r.pattern))})"
        for i, r in enumerate(licenses.RULES)
    )
    low = "coalesce(text, '')"
    for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        low = f"replace({low}, '{a}', '{a.lower()}')"
    base = len(licenses.BASE)
    return rf"""
WITH rules(rule, label, tier, gates, rx) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({low}, '{licenses.LICENSE_WORD}') AS ws FROM documents),
m AS (
  SELECT rid, doc_id, len(ws)::BIGINT AS n_words,
    array_to_string(list_transform(range(1, len(ws) + 1), lambda i: ' ' || (i - 1) || ':' || ws[i] || ' '), '') AS t FROM d),
x AS (
  SELECT rid, rule, label, tier, unnest(regexp_extract_all(t, rx)) AS hit
  FROM m, rules WHERE len(list_filter(gates, lambda g: contains(t, g))) > 0),
f AS (
  SELECT rid, rule, label, tier, ltrim(split_part(hit, ':', 1))::BIGINT AS a,
    ltrim(split_part(hit, ':', 1))::BIGINT + len(hit) - len(replace(hit, ':', '')) AS b FROM x),
k AS (
  SELECT * FROM f WHERE NOT EXISTS (
    SELECT 1 FROM f g WHERE g.rid = f.rid AND g.tier >= f.tier AND g.a <= f.a AND g.b >= f.b
      AND (g.a, -g.b, -g.tier, g.rule) < (f.a, -f.b, -f.tier, f.rule))),
b AS (
  SELECT rid, count(*) AS n_base, min(a) AS first_word, max(a) AS last_word, list(DISTINCT label) AS own
  FROM f WHERE rule < {base} GROUP BY rid),
s AS (SELECT rid, list(DISTINCT label) AS labels, max(tier) AS tier FROM k GROUP BY rid)
SELECT doc_id, n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(labels, [])))), ','), '') AS labels,
  coalesce(CASE tier WHEN 3 THEN 1.0 WHEN 2 THEN 0.8 WHEN 1 THEN 0.5 END, 0)::DOUBLE AS score
FROM m LEFT JOIN b USING (rid) LEFT JOIN s USING (rid)"""


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    groups = nearjoin.near_groups(_table(spark, folder, "documents"), "doc_id", "text", k=3, percent=90)
    return groups.withColumnRenamed("key", "doc_id").drop("text_hash")


OP7_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {W_SQL}) AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
    ELSE list_transform(range(1, greatest(len(ws) - 3, 0) + 2), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.n * 100 >= 90 * b.n AND b.n * 100 >= 90 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
c AS (SELECT doc_id, doc_id AS r FROM s UNION SELECT c.doc_id, p.b FROM c JOIN p ON p.a = c.r)
SELECT doc_id, len(g)::BIGINT AS n_shingles, (SELECT min(r) FROM c WHERE c.doc_id = s.doc_id) AS component_id FROM s"""


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.tiktoken")
    packed = packing.pack(_table(spark, folder, "documents"), "doc_id", "text", tokenizer)
    return packed.withColumnRenamed("key", "doc_id")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    archives = warc.archive(spark, pages, "page_id", "url", "html")
    found = warc.digests(warc.read(archives, payload=False))
    kind = pages.schema["page_id"].dataType
    return found.select(
        F.col("record").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


OP9_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (('0x' || substr(hex, (i // 8 * 10 + 1)::INT, 10))::BIGINT >> (35 - i % 8 * 5)::INT & 31)::INT + 1, 1)), '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to FROM b"""


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = fingerprints.edited_pairs(_table(spark, folder, "documents"), "doc_id", "text")
    sketched = held(pairs, edited=F.struct(
        fingerprints.sketch(F.col("edited")).alias("sketch"), F.sha2("edited", 256).alias("sha")
    ))
    like, text = fingerprints.resemblance, fingerprints.as_text
    return sketched.select(
        F.col("key").alias("doc_id"), "n_chars", F.col("edited.sha").alias("edited_sha256"),
        text(F.col("own")).alias("fingerprint"), text(F.col("edited.sketch")).alias("edited_fingerprint"),
        like(F.col("own"), F.col("edited.sketch")).alias("near_edited"),
        like(F.col("own"), F.col("next")).alias("near_next"),
    )


def _op10_sql() -> str:
    k, n, digits = fingerprints.K, fingerprints.SHINGLE, fingerprints.DIGITS
    low = lambda c: f"regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {W_SQL})"
    hashes = lambda ws: (
        f"CASE WHEN len({ws}) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len({ws}) - {n}, 0) + 2), "
        f"lambda i: substr(md5(array_to_string({ws}[i:i + {n - 1}], ' ')), 1, {digits}))))[1:{k}] END"
    )
    like = lambda a, b: (
        f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE "
        f"len(list_intersect(list_intersect(list_sort(list_distinct(list_concat({a}, {b})))[1:{k}], {a}), {b}))::DOUBLE"
        f" / least({k}, len(list_distinct(list_concat({a}, {b})))) END::DOUBLE"
    )
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
c AS (
  SELECT *, coalesce(lead(text) OVER o, first(text) OVER (ORDER BY doc_id DESC)) AS next FROM t WINDOW o AS (ORDER BY doc_id DESC)),
e AS (
  SELECT doc_id, text, next, left(text, (len(text) - len(text) // 2)::INT) || left(next, (len(text) // 2)::INT) AS edited FROM c),
w AS (SELECT *, {low("text")} AS a, {low("edited")} AS b, {low("next")} AS c FROM e),
f AS (SELECT doc_id, text, edited, {hashes("a")} AS a, {hashes("b")} AS b, {hashes("c")} AS c FROM w)
SELECT doc_id, len(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  {like("a", "b")} AS near_edited, {like("a", "c")} AS near_next FROM f"""


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"), "text", "lang")


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(len(ws) - k + 1, 0) + 1), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, range(1, 4) t(k)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT c.lang, c.k, c.phrase, c.ws, c.a, c.cut, l.n AS l, r.n AS r,
    (1000000::HUGEINT * c.a * c.a // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.k = c.cut AND l.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - c.cut AND r.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM c, range(1, 3) t(i) WHERE k = 3 GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN inside USING (lang, phrase) WHERE b.k = 3 OR longer IS NULL OR 100 * longer < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, totals.n AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations")
    return prefixtrie.trie(prefixtrie.rebuilt(turns, "conv_id", "turn", "role", "text"))


OP12_SQL = """
WITH table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
t AS (
  SELECT conv_id AS c, turn, strlen(coalesce(text, ''))::BIGINT AS n,
    md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'k': k, 'n': n} ORDER BY turn NULLS FIRST, k) AS xs FROM t GROUP BY c),
h AS (
  SELECT c, xs, xor(list_reduce(list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h FROM o, table_of),
p AS (SELECT h.c, list_concat(coalesce(o.xs, [])[1:h], h.xs[h + 1:]) AS xs FROM h LEFT JOIN o ON o.c = h.c - h.c % 5),
m AS (
  SELECT c, d, len(xs) AS turns, array_to_string(list_transform(xs[1:d], lambda x: x.k), '') AS id,
    CASE WHEN d > 0 THEN xs[d].n ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(0, len(xs) + 1)) AS d FROM p)),
node AS (
  SELECT id, min(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (turns = d), '')) AS ends_sha256 FROM m GROUP BY id),
kids AS (SELECT left(id, len(id) - 32) AS up, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
f AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids ON up = id),
a AS (SELECT left(id, 32 * u) AS top, n_children, (n_convs - 1) * bytes AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS u FROM f)),
s AS (SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM a GROUP BY top)
SELECT f.conv_id, f.depth, par.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM f JOIN s ON top = f.id LEFT JOIN f par ON f.depth > 0 AND par.id = left(f.id, len(f.id) - 32)"""


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    cut = linededup.without_repeated_lines(docs, "doc_id", "text")
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
v AS (SELECT k.rid, k.i, k.line, coalesce(f.first < k.doc_id, false) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, n_dropped, kept_sha256 FROM d JOIN (
  SELECT rid, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
  FROM v GROUP BY rid) USING (rid)"""


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_main_text": op2_main_text,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_url_filter": op5_url_filter,
    "op6_license_scan": op6_license_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_pack": op8_pack,
    "op9_warc": op9_warc,
    "op10_fingerprints": op10_fingerprints,
    "op11_collocations": op11_collocations,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_dedup": op13_line_dedup,
}
SQL: dict[str, str] = {
    "op1_mix_sources": OP1_SQL,
    "op3_suffix_dedup": OP3_SQL,
    "op4_quality_rules": _op4_sql(),
    "op5_url_filter": OP5_SQL,
    "op7_jaccard_join": OP7_SQL,
    "op9_warc": OP9_SQL,
    "op6_license_scan": _op6_sql(),
    "op10_fingerprints": _op10_sql(),
    "op11_collocations": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
