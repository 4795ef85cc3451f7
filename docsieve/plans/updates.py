"""Batched updates: customers changed by their orders, parts by their line items."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.operators import updates as U
from docsieve.plans.registry import Tables, query
from docsieve.plans.texts import EMBED_SQL, raw_documents
from docsieve.sources.prepare import prepare_documents

# Unpaid orders belong to customers that the table does not have yet.
NEW_KEY_SQL = "CASE WHEN o_orderstatus = 'P' THEN o_custkey + 10000000 ELSE o_custkey END"


def new_key() -> Column:
    key = F.col("o_custkey")
    return F.when(F.col("o_orderstatus") == "P", key + 10000000).otherwise(key)


def customer_rows(t: Tables) -> DataFrame:
    """Whole customer rows as changes, one per order; the order number is the sequence."""
    return t.orders.select(
        new_key().alias("c_custkey"), F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("c_name"),
        F.lit(0).alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
    )


ROWS_SQL = f"""
  ch AS (SELECT {NEW_KEY_SQL} AS c_custkey, o_orderkey AS seq, 'Order ' || o_orderkey AS c_name,
           0 AS c_nationkey, o_totalprice AS c_acctbal, o_orderpriority AS c_mktsegment, o_orderstatus
         FROM orders),
  last AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)"""
CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query(
    "upsert",
    f"""
    WITH {ROWS_SQL}
    SELECT {CUSTOMER} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
    UNION ALL SELECT {CUSTOMER} FROM last
    """,
)
def upsert(t: Tables) -> DataFrame:
    return U.upsert(t.customer, customer_rows(t), "c_custkey")


@query(
    "insert_new",
    f"""
    WITH {ROWS_SQL}
    SELECT {CUSTOMER} FROM customer
    UNION ALL SELECT {CUSTOMER} FROM last WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
    """,
)
def insert_new(t: Tables) -> DataFrame:
    return U.insert_new(t.customer, customer_rows(t), "c_custkey")


def operations(t: Tables, field: str, op: str, value: Column) -> DataFrame:
    """One operation per order on the customer of the order."""
    return t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"),
        F.lit(field).alias("field"), F.lit(op).alias("op"), value.cast("string").alias("value"),
    )


@query(
    "update_set",
    """
    WITH last AS (SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS v FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    SELECT c_custkey, c_name, coalesce(CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE v END, '(null)') AS c_mktsegment
    FROM customer LEFT JOIN last ON c_custkey = o_custkey
    """,
)
def update_set(t: Tables) -> DataFrame:
    """Unpaid orders set the field to null."""
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    changes = operations(t, "c_mktsegment", "set", value)
    out = U.atomic_update(t.customer, changes, "c_custkey", {"c_mktsegment": ["set"]})
    return out.select("c_custkey", "c_name", F.coalesce("c_mktsegment", F.lit("(null)")).alias("c_mktsegment"))


def gappy_customers(t: Tables) -> DataFrame:
    """Customers without balance (BUILDING) or without segment (MACHINERY)."""
    segment = F.col("c_mktsegment")
    return t.customer.withColumn(
        "c_acctbal", F.when(segment != "BUILDING", F.col("c_acctbal"))
    ).withColumn("c_mktsegment", F.when(segment != "MACHINERY", segment))


GAPPY_SQL = """
  g AS (SELECT c_custkey, c_name, c_nationkey,
          CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal,
          CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment FROM customer)"""


@query(
    "update_inc",
    f"""
    WITH {GAPPY_SQL},
    s AS (SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END) AS d
          FROM orders GROUP BY o_custkey)
    SELECT c_custkey, round(CASE WHEN d IS NULL THEN coalesce(c_acctbal, -1) ELSE coalesce(c_acctbal, 0) + d END, 2)
      AS c_acctbal
    FROM g LEFT JOIN s ON c_custkey = o_custkey
    """,
)
def update_inc(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    changes = operations(
        t, "c_acctbal", "inc", F.when(F.col("o_orderstatus") == "F", -price).otherwise(price)
    )
    out = U.atomic_update(gappy_customers(t), changes, "c_custkey", {"c_acctbal": ["inc"]})
    return out.select("c_custkey", F.round(F.coalesce("c_acctbal", F.lit(-1.0)), 2).alias("c_acctbal"))


def tagged(t: Tables) -> DataFrame:
    """Customers with a list field that holds repeats."""
    tags = F.array(F.lit("1-URGENT"), F.col("c_mktsegment"), F.lit("5-LOW"), F.col("c_mktsegment"))
    return t.customer.select("c_custkey", tags.alias("tags"))


TAGGED_SQL = """
  g AS (SELECT c_custkey, ['1-URGENT', c_mktsegment, '5-LOW', c_mktsegment] AS tags FROM customer)"""


@query(
    "update_add",
    f"""
    WITH {TAGGED_SQL},
    s AS (SELECT o_custkey, list(o_orderpriority ORDER BY o_orderkey) AS a FROM orders GROUP BY o_custkey)
    SELECT c_custkey, array_to_string(CASE WHEN a IS NULL THEN tags ELSE list_concat(tags, a) END, '|') AS tags
    FROM g LEFT JOIN s ON c_custkey = o_custkey
    """,
)
def update_add(t: Tables) -> DataFrame:
    changes = operations(t, "tags", "add", F.col("o_orderpriority"))
    out = U.atomic_update(tagged(t), changes, "c_custkey", {"tags": ["add"]})
    return out.select("c_custkey", F.array_join("tags", "|").alias("tags"))


@query(
    "update_remove",
    f"""
    WITH {TAGGED_SQL}, x AS (SELECT c_custkey, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i FROM g)
    SELECT c_custkey, coalesce(string_agg(tag, '|' ORDER BY i), '') AS tags FROM x
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = tag)
    GROUP BY c_custkey
    """,
)
def update_remove(t: Tables) -> DataFrame:
    changes = operations(t, "tags", "remove", F.col("o_orderpriority"))
    out = U.atomic_update(tagged(t), changes, "c_custkey", {"tags": ["remove"]})
    return out.select("c_custkey", F.array_join("tags", "|").alias("tags"))


@query(
    "update_removeregex",
    f"""
    WITH {TAGGED_SQL}, x AS (SELECT c_custkey, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i FROM g)
    SELECT c_custkey, coalesce(string_agg(tag, '|' ORDER BY i), '') AS tags FROM x
    WHERE NOT EXISTS (SELECT 1 FROM orders
                      WHERE o_custkey = c_custkey AND regexp_matches(tag, '^' || substr(o_orderpriority, 1, 1)))
    GROUP BY c_custkey
    """,
)
def update_removeregex(t: Tables) -> DataFrame:
    pattern = F.concat(F.lit("^"), F.substring("o_orderpriority", 1, 1))
    changes = operations(t, "tags", "removeregex", pattern)
    out = U.atomic_update(tagged(t), changes, "c_custkey", {"tags": ["removeregex"]})
    return out.select("c_custkey", F.array_join("tags", "|").alias("tags"))


@query(
    "update_set_if_null",
    f"""
    WITH {GAPPY_SQL}, s AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS v FROM orders GROUP BY ALL)
    SELECT c_custkey, coalesce(c_mktsegment, v, '(null)') AS c_mktsegment FROM g LEFT JOIN s ON c_custkey = o_custkey
    """,
)
def update_set_if_null(t: Tables) -> DataFrame:
    changes = operations(t, "c_mktsegment", "set-if-null", F.col("o_orderpriority"))
    out = U.atomic_update(gappy_customers(t), changes, "c_custkey", {"c_mktsegment": ["set-if-null"]})
    return out.select("c_custkey", F.coalesce("c_mktsegment", F.lit("(null)")).alias("c_mktsegment"))


@query(
    "update_multi",
    """
    WITH seg AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS v FROM orders
                 WHERE o_orderstatus = 'P' GROUP BY ALL),
    base AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS v, max(o_orderkey) AS seq FROM orders
             WHERE o_orderstatus = 'O' GROUP BY ALL),
    inc AS (SELECT o.o_custkey, sum(o_totalprice) AS d FROM orders o LEFT JOIN base b ON o.o_custkey = b.o_custkey
            WHERE o_orderstatus = 'F' AND (seq IS NULL OR o_orderkey > seq) GROUP BY ALL)
    SELECT c_custkey, c_name, coalesce(seg.v, c_mktsegment) AS c_mktsegment,
      round(coalesce(base.v, c_acctbal) + coalesce(d, 0), 2) AS c_acctbal,
      7 + CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 1 ELSE 0 END AS version
    FROM customer LEFT JOIN seg ON c_custkey = seg.o_custkey LEFT JOIN base ON c_custkey = base.o_custkey
      LEFT JOIN inc ON c_custkey = inc.o_custkey
    """,
)
def update_multi(t: Tables) -> DataFrame:
    """Paid orders set the balance, finished ones add to it, others set the segment."""
    status = F.col("o_orderstatus")
    changes = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"),
        F.when(status == "P", "c_mktsegment").otherwise("c_acctbal").alias("field"),
        F.when(status == "F", "inc").otherwise("set").alias("op"),
        F.when(status == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("value"),
    )
    base = t.customer.withColumn("version", F.lit(7))
    rules = {"c_mktsegment": ["set"], "c_acctbal": ["set", "inc"]}
    out = U.atomic_update(base, changes, "c_custkey", rules, version="version")
    return out.drop("c_nationkey").withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "delete_ids",
    f"""
    SELECT {CUSTOMER} FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
)
def delete_ids(t: Tables) -> DataFrame:
    ids = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return U.delete(t.customer, "c_custkey", ids=ids)


@query(
    "delete_query",
    f"""
    WITH {GAPPY_SQL}
    SELECT c_custkey, coalesce(c_acctbal, -1) AS c_acctbal FROM g WHERE NOT coalesce(c_acctbal > 4000, false)
    """,
)
def delete_query(t: Tables) -> DataFrame:
    """Customers without a balance are not known to match, so they stay."""
    left = U.delete(gappy_customers(t), "c_custkey", condition=F.col("c_acctbal") > 4000)
    return left.select("c_custkey", F.coalesce("c_acctbal", F.lit(-1.0)).alias("c_acctbal"))


def versioned(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = t.customer.select("c_custkey", "c_acctbal", (1 + F.col("c_nationkey") % 3).alias("version"))
    changes = t.orders.select(
        new_key().alias("c_custkey"), F.col("o_orderkey").alias("seq"),
        (1 + F.col("o_orderkey") % 3).cast("int").alias("expected"), F.col("o_totalprice").alias("value"),
    )
    return base, changes


VERSIONED_SQL = f"""
  b AS (SELECT c_custkey, c_acctbal, 1 + c_nationkey % 3 AS version FROM customer),
  ch AS (SELECT {NEW_KEY_SQL} AS c_custkey, o_orderkey AS seq, CAST(1 + o_orderkey % 3 AS INTEGER) AS expected,
           o_totalprice AS value FROM orders),
  win AS (SELECT ch.* FROM ch JOIN b ON ch.c_custkey = b.c_custkey AND expected = version
          QUALIFY row_number() OVER (PARTITION BY ch.c_custkey ORDER BY seq) = 1)"""


@query(
    "update_versioned",
    f"""
    WITH {VERSIONED_SQL}
    SELECT b.c_custkey, coalesce(value, c_acctbal) AS c_acctbal,
      CASE WHEN seq IS NULL THEN version ELSE version + 1 END AS version
    FROM b LEFT JOIN win ON b.c_custkey = win.c_custkey
    """,
)
def update_versioned(t: Tables) -> DataFrame:
    return U.update_versioned(*versioned(t), "c_custkey", "c_acctbal")


@query(
    "update_conflicts",
    f"""
    WITH {VERSIONED_SQL}
    SELECT ch.c_custkey, ch.seq, ch.expected, ch.value, coalesce(version, -1) AS stored
    FROM ch LEFT JOIN b ON ch.c_custkey = b.c_custkey WHERE ch.seq NOT IN (SELECT seq FROM win)
    """,
)
def update_conflicts(t: Tables) -> DataFrame:
    return U.version_conflicts(*versioned(t), "c_custkey").fillna({"stored": -1})


@query(
    "update_guarded",
    """
    WITH r AS (SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_partkey)
    SELECT p_partkey, CAST(CASE WHEN quantity <= p_size * 40 THEN p_size * 40 - quantity ELSE p_size * 40 END AS INTEGER)
      AS stock, CASE WHEN quantity IS NULL THEN 'none' WHEN quantity <= p_size * 40 THEN 'applied' ELSE 'rejected' END
      AS status
    FROM part LEFT JOIN r ON l_partkey = p_partkey
    """,
)
def update_guarded(t: Tables) -> DataFrame:
    """All line items of a part ask for stock together."""
    base = t.part.select("p_partkey", (F.col("p_size") * 40).alias("stock"))
    requests = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").alias("quantity"))
    report = U.guarded_decrement(base, requests, "p_partkey", "stock").select("p_partkey", "status")
    after = U.apply_decrement(base, requests, "p_partkey", "stock")
    return after.join(report, "p_partkey", "left").fillna({"status": "none"})


@query(
    "update_audited",
    """
    WITH ch AS (SELECT l_partkey, max(l_extendedprice / l_quantity) - 2400 AS v FROM lineitem GROUP BY l_partkey),
    x AS (SELECT p_partkey, p_retailprice AS old, CASE WHEN p_size = 7 THEN p_retailprice + 0.005 ELSE v END AS v
          FROM part LEFT JOIN ch ON l_partkey = p_partkey),
    s AS (SELECT *, CASE WHEN v IS NULL THEN 'none' WHEN v < 100 THEN 'below minimum'
                         WHEN abs(old - v) < 0.01 THEN 'unchanged' ELSE 'updated' END AS status FROM x)
    SELECT p_partkey, round(CASE WHEN status = 'updated' THEN v ELSE old END, 4) AS p_retailprice,
      CASE WHEN status = 'updated' THEN old ELSE -1 END AS previous, status FROM s
    """,
)
def update_audited(t: Tables) -> DataFrame:
    """Prices from the line items; parts of size 7 get theirs again, half a cent off."""
    unit = t.lineitem.groupBy("l_partkey").agg(
        (F.max(F.col("l_extendedprice") / F.col("l_quantity")) - 2400).alias("v")
    )
    both = t.part.join(unit, F.col("l_partkey") == F.col("p_partkey"), "left")
    value = F.when(F.col("p_size") == 7, F.col("p_retailprice") + 0.005).otherwise(F.col("v"))
    changes = both.select("p_partkey", F.lit(1).alias("seq"), value.alias("value")).where("value IS NOT NULL")
    out = U.audited_set(
        t.part.select("p_partkey", "p_retailprice"), changes, "p_partkey", "p_retailprice", minimum=100.0
    )
    return out.withColumn("p_retailprice", F.round("p_retailprice", 4)).fillna({"previous": -1.0})


def log_of(t: Tables) -> DataFrame:
    """Customer rows per order; orders of priority 5 delete the customer."""
    rows = customer_rows(t)
    return rows.withColumn("deleted", F.col("c_mktsegment") == "5-LOW")


MERGED_SQL = f"""
  {ROWS_SQL},
  now AS (SELECT {CUSTOMER} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
          UNION ALL SELECT {CUSTOMER} FROM last WHERE c_mktsegment <> '5-LOW')"""


@query(
    "realtime_get",
    f"""
    WITH {MERGED_SQL}
    SELECT c_custkey, c_name, c_acctbal FROM now WHERE c_custkey IN (SELECT o_custkey + 10000000 FROM orders)
      OR c_custkey IN (SELECT s_suppkey FROM supplier)
    """,
)
def realtime_get(t: Tables) -> DataFrame:
    """Keys of suppliers and of customers that are only pending; many are unknown."""
    ids = t.orders.select((F.col("o_custkey") + 10000000).alias("c_custkey")).unionByName(
        t.supplier.select(F.col("s_suppkey").alias("c_custkey"))
    )
    return U.realtime_get(t.customer, log_of(t), "c_custkey", ids, ["c_custkey", "c_name", "c_acctbal"])


@query("commit_soft", f"WITH {MERGED_SQL} SELECT {CUSTOMER} FROM now")
def commit_soft(t: Tables) -> DataFrame:
    return U.commit(t.customer, log_of(t), "c_custkey")


@query("commit_hard", f"WITH {MERGED_SQL} SELECT {CUSTOMER} FROM now")
def commit_hard(t: Tables) -> DataFrame:
    return U.commit(t.customer, log_of(t), "c_custkey", path=t.scratch("snapshot"))


@query(
    "prepare_index",
    f"""
    WITH {EMBED_SQL}
    SELECT CAST(doc_id AS VARCHAR) AS id, source AS title, text AS content, CAST(n_chars AS INTEGER) AS section_number_i,
      lang AS author_s, '2024-01-02 03:04:05' AS date_dt, lang || ',' || source AS tags_ss,
      'hashed-words' AS vector_model_s, 64 AS dimensions_i, vector
    FROM documents JOIN (
      SELECT doc_id AS id, string_agg(CAST(round(coalesce(x, 0) * 10000) AS INTEGER), ',' ORDER BY d) AS vector
      FROM (SELECT doc_id, unnest(range(64)) AS d FROM documents) LEFT JOIN vec ON vec.id = doc_id AND dim = d GROUP BY doc_id
    ) ON id = doc_id
    """,
)
def prepare_index(t: Tables) -> DataFrame:
    ready = prepare_documents(raw_documents(t), clock=False)
    return ready.select(
        "id", "title", "content", "section_number_i", "author_s",
        F.date_format("date_dt", "yyyy-MM-dd HH:mm:ss").alias("date_dt"),
        F.array_join("tags_ss", ",").alias("tags_ss"), "vector_model_s", "dimensions_i",
        F.array_join(F.transform("embedding", lambda x: F.round(x * 10000).cast("int").cast("string")), ",").alias("vector"),
    )
