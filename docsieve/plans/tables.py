"""Tables, files, sections and chunks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.plans.registry import TABLE_NAMES, Tables, query
from docsieve.sources import markdown as M
from docsieve.sources import tables as S

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("scan_table", CUSTOMER_SQL)
def scan_table(t: Tables) -> DataFrame:
    return S.scan(t.spark, t.folder, "CUSTOMER")


@query("match_all", "SELECT doc_id, lang, source, n_chars FROM documents")
def match_all(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", "n_chars")


@query("read_json_docs", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_json_docs(t: Tables) -> DataFrame:
    """Document arrays of up to a hundred documents, one array per line."""
    docs, path = t.documents, t.scratch("json-arrays")
    batch = F.floor(F.col("doc_id") / 100)
    arrays = docs.groupBy(batch.alias("batch")).agg(
        F.to_json(F.collect_list(F.struct(*docs.columns))).alias("value")
    )
    arrays.select("value").write.text(path)
    return S.read_json_documents(t.spark, path, docs.schema, multi_line=False)


@query("write_json_docs", "SELECT conv_id, turn, role, text FROM conversations")
def write_json_docs(t: Tables) -> DataFrame:
    path = t.scratch("json-lines")
    S.write_json_documents(t.conversations, path)
    return S.read_json_documents(t.spark, path, t.conversations.schema, multi_line=False)


def markdown(t: Tables) -> DataFrame:
    """One markdown text per turn, with text before the first heading and empty sections."""
    body = F.concat(
        F.lit("\n Turn "), F.col("turn"), F.lit(" \n# Conversation "), F.col("conv_id"),
        F.lit("\n## "), F.col("role"), F.lit("\n"), F.col("text"),
        F.lit("\n### Blank\n  \n#### Notes \n#include <x>\n####### seven\n"), F.col("text"),
        F.lit("\n###### End"),
    )
    head = F.concat(
        F.lit("---\ntitle: Conversation "), F.col("conv_id"),
        F.lit("\ntags: [chat, "), F.col("role"), F.lit("]\ncategories: talk\nid: kept out\nrole: "),
        F.col("role"), F.lit("\n---\n"),
    )
    source = F.concat(
        F.lit("chats/"), F.col("conv_id"), F.lit("/turn"), F.col("turn"), F.lit(".md")
    )
    return t.wide("conversations").select("conv_id", "turn", source.alias("source"), body.alias("md"),
                                  F.concat(head, body).alias("file"))


MARKDOWN_SQL = r"""
  md AS (
    SELECT conv_id, turn, role, 'chats/' || conv_id || '/turn' || turn || '.md' AS source,
      E'\n Turn ' || turn || E' \n# Conversation ' || conv_id || E'\n## ' || role || E'\n' || text
      || E'\n### Blank\n  \n#### Notes \n#include <x>\n####### seven\n' || text || E'\n###### End' AS md
    FROM conversations),
  lines AS (
    SELECT conv_id, turn, role, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
    FROM (SELECT conv_id, turn, role, source, string_split(md, E'\n') AS ls FROM md)),
  flagged AS (SELECT *, regexp_matches(line, '^#{1,6}\s+.') AS heading FROM lines),
  numbered AS (
    SELECT *, sum(CASE WHEN heading THEN 1 ELSE 0 END)
      OVER (PARTITION BY conv_id, turn ORDER BY pos) AS part FROM flagged),
  bodies AS (
    SELECT conv_id, turn, role, source, part,
      coalesce(max(CASE WHEN heading THEN trim(regexp_extract(line, '^#{1,6}\s+(.+)$', 1)) END),
               'Introduction') AS title,
      count(*) FILTER (WHERE NOT heading) AS n_lines,
      regexp_replace(coalesce(string_agg(line, E'\n' ORDER BY pos) FILTER (WHERE NOT heading), ''),
                     '^\s+|\s+$', '', 'g') AS body
    FROM numbered GROUP BY ALL),
  sections AS (
    SELECT conv_id, turn, role, source, title, body,
      CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY part) - 1 AS INTEGER) AS section_number
    FROM bodies WHERE n_lines > 0)"""


@query(
    "md_sections",
    f"WITH {MARKDOWN_SQL} SELECT conv_id, turn, section_number, title, body FROM sections",
)
def md_sections(t: Tables) -> DataFrame:
    texts = markdown(t).select("conv_id", "turn", "md")
    return M.explode_sections(texts, "md").drop("md")


@query(
    "md_frontmatter",
    r"""
    WITH f AS (
      SELECT conv_id, turn, E'---\ntitle: Conversation ' || conv_id || E'\ntags: [chat, ' || role
        || E']\ncategories: talk\nid: kept out\nrole: ' || role || E'\n---\n' || text AS file
      FROM conversations),
    l AS (
      SELECT conv_id, turn,
        unnest(string_split(regexp_extract(file, '(?s)^---\n(.*?)\n---', 1), E'\n')) AS line FROM f)
    SELECT conv_id, turn, split_part(line, ':', 1) AS key, trim(split_part(line, ':', 2)) AS value FROM l
    """,
)
def md_frontmatter(t: Tables) -> DataFrame:
    return markdown(t).select("conv_id", "turn", F.explode(M.front_matter("file")))


@query(
    "sections_to_docs",
    f"""
    WITH {MARKDOWN_SQL}
    SELECT 'turn' || turn || '.md_section_' || section_number AS id, title, body AS text, source,
      section_number, 'chat,' || role AS tags, 'talk' AS category,
      'role=' || role AS extra
    FROM sections WHERE body <> ''
    """,
)
def sections_to_docs(t: Tables) -> DataFrame:
    """Front matter gives tags, category and ``role``; its id and title change nothing."""
    docs = M.section_documents(markdown(t), "source", "file", clock=False)
    extra = F.transform(F.map_entries("extra"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return docs.select(
        "id", "title", "text", "source", "section_number",
        F.array_join("tags", ",").alias("tags"),
        F.array_join("category", ",").alias("category"),
        F.array_join(F.array_sort(extra), ",").alias("extra"),
    )


@query(
    "chunk_text",
    """
    WITH c AS (SELECT doc_id, text, unnest(range(0, length(text), 800)) AS start FROM documents)
    SELECT doc_id, CAST(start // 800 AS INTEGER) AS chunk_number, CAST(start AS INTEGER) AS start,
      substr(text, start + 1, 1000) AS chunk FROM c
    """,
)
def chunk_text(t: Tables) -> DataFrame:
    return M.chunks(t.wide("documents"), "doc_id", "text")


@query(
    "collection_inventory",
    " UNION ALL ".join(
        f"SELECT '{n}' AS collection, count(*) AS row_count, "
        f"CAST((SELECT count(*) FROM (DESCRIBE {n})) AS INTEGER) AS field_count FROM {n}"
        for n in TABLE_NAMES
    ),
)
def collection_inventory(t: Tables) -> DataFrame:
    return S.inventory({n: getattr(t, n) for n in TABLE_NAMES})


PRODUCT_FIELDS = [
    {"name": "id", "type": "string", "required": True},
    {"name": "name", "type": "text_general"},
    {"name": "price", "type": "pdouble"},
    {"name": "stock", "type": "pint"},
    {"name": "tags", "type": "string", "multiValued": True},
    {"name": "status", "type": "string"},
]


@query(
    "create_collection",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_retailprice AS price, p_size AS stock,
      p_brand || ',' || p_type AS tags, '' AS status FROM part
    """,
)
def create_collection(t: Tables) -> DataFrame:
    """Created empty, dropped and created again with rows; ``status`` has no values."""
    path, schema = t.scratch("products"), S.collection_schema(PRODUCT_FIELDS)
    S.create_collection(t.spark, path, schema)
    rows = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"), F.col("p_size").alias("stock"),
        F.array("p_brand", "p_type").alias("tags"),
    )
    made = S.create_collection(t.spark, path, schema, rows)
    return made.withColumn("tags", F.array_join("tags", ",")).fillna({"status": ""})


@query("count_docs", "SELECT count(*) AS num_found FROM documents")
def count_docs(t: Tables) -> DataFrame:
    return S.count_documents(t.documents)


@query(
    "sample_docs",
    "SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 3",
)
def sample_docs(t: Tables) -> DataFrame:
    return S.sample_documents(t.documents, "doc_id")
