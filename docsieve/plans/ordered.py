"""Updates whose outcome depends on the order of the requests."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.operators import ordered as O
from docsieve.plans.registry import Tables, query


def chained(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Each order asks to set the segment and to raise the balance of its customer, or of one that is unknown."""
    base = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", (1 + F.col("c_nationkey") % 3).alias("version"))
    head = t.orders.select(
        F.when(F.col("o_orderkey") % 11 == 0, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey")).alias("c_custkey"),
        F.col("o_orderkey").alias("seq"), (1 + F.col("o_orderkey") % 4).alias("expected"),
        F.array(
            F.struct(F.lit("c_mktsegment").alias("field"), F.lit("set").alias("op"), F.col("o_orderpriority").alias("value")),
            F.struct(F.lit("c_acctbal").alias("field"), F.lit("inc").alias("op"), F.col("o_totalprice").cast("string").alias("value")),
        ).alias("ops"),
    )
    return base, head.select("c_custkey", "seq", "expected", F.inline("ops"))


CHAIN_SQL = """
  b AS (SELECT c_custkey, c_mktsegment, c_acctbal, 1 + c_nationkey % 3 AS version FROM customer),
  ch AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS c_custkey, o_orderkey AS seq,
           1 + o_orderkey % 4 AS expected, o_orderpriority, o_totalprice FROM orders),
  chain AS (
    SELECT c_custkey, CAST(version AS BIGINT) AS v, CAST(-1 AS BIGINT) AS s FROM b
    UNION ALL
    SELECT c.c_custkey, c.v + 1, min(ch.seq) FROM chain c JOIN ch ON ch.c_custkey = c.c_custkey AND ch.expected = c.v AND ch.seq > c.s
    GROUP BY c.c_custkey, c.v),
  won AS (SELECT ch.* FROM chain JOIN ch ON ch.c_custkey = chain.c_custkey AND ch.seq = chain.s)"""


@query(
    "update_version_chain",
    f"""
    WITH RECURSIVE {CHAIN_SQL},
    u AS (SELECT c_custkey, count(*) AS n, sum(o_totalprice) AS d, arg_max(o_orderpriority, seq) AS p FROM won GROUP BY c_custkey)
    SELECT c_custkey, coalesce(p, c_mktsegment) AS c_mktsegment, round(c_acctbal + coalesce(d, 0), 2) AS c_acctbal,
      version + coalesce(n, 0)::INTEGER AS version
    FROM b LEFT JOIN u USING (c_custkey)
    """,
)
def update_version_chain(t: Tables) -> DataFrame:
    """Two operations a request under one version; requests of a batch build on each other."""
    base, changes = chained(t)
    out = O.chained_update(base, changes, "c_custkey", ["c_mktsegment", "c_acctbal"])
    return out.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "update_chain_report",
    f"""
    WITH RECURSIVE {CHAIN_SQL}
    SELECT ch.c_custkey, ch.seq, ch.expected, coalesce(version, -1)::BIGINT AS stored,
      CASE WHEN ch.seq IN (SELECT seq FROM won) THEN 'applied' WHEN version IS NULL THEN 'unknown' ELSE 'conflict' END AS status
    FROM ch LEFT JOIN b ON b.c_custkey = ch.c_custkey
    """,
)
def update_chain_report(t: Tables) -> DataFrame:
    base, changes = chained(t)
    return O.version_chain(base, changes, "c_custkey").fillna({"stored": -1})


def stock_requests(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = t.part.select("p_partkey", (F.col("p_size") * 9).alias("stock"))
    requests = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_quantity").alias("quantity"),
    )
    return base, requests


SERVED_SQL = """
  r AS (SELECT l_partkey AS p_partkey, l_orderkey * 10 + l_linenumber AS seq, l_quantity AS quantity, p_size * 9 AS stock,
          row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber, l_quantity) AS i
        FROM lineitem JOIN part ON l_partkey = p_partkey),
  run AS (
    SELECT p_partkey, CAST(0 AS BIGINT) AS i, CAST(stock AS DOUBLE) AS old, CAST(stock AS DOUBLE) AS new, CAST(NULL AS BIGINT) AS seq,
      CAST(NULL AS DOUBLE) AS quantity, '' AS status FROM (SELECT DISTINCT p_partkey, stock FROM r)
    UNION ALL
    SELECT r.p_partkey, r.i, run.new, CASE WHEN r.quantity <= run.new THEN run.new - r.quantity ELSE run.new END, r.seq, r.quantity,
      CASE WHEN r.quantity <= run.new THEN 'applied' ELSE 'rejected' END
    FROM run JOIN r ON r.p_partkey = run.p_partkey AND r.i = run.i + 1)"""


@query(
    "update_guarded_each",
    f"""
    WITH RECURSIVE {SERVED_SQL}
    SELECT run.p_partkey, seq, quantity, status,
      CASE WHEN quantity > p_size * 9 THEN -1 ELSE old END AS old, CASE WHEN quantity > p_size * 9 THEN -1 ELSE new END AS new
    FROM run JOIN part ON part.p_partkey = run.p_partkey WHERE i > 0
    """,
)
def update_guarded_each(t: Tables) -> DataFrame:
    """Every line item asks for stock in turn; one that wants too much does not stop the next."""
    report = O.served_one_by_one(*stock_requests(t), "p_partkey", "stock")
    return report.fillna({"old": -1.0, "new": -1.0})


@query(
    "update_guarded_stock",
    f"""
    WITH RECURSIVE {SERVED_SQL}
    SELECT p_partkey, CAST(coalesce(m, p_size * 9) AS INTEGER) AS stock
    FROM part LEFT JOIN (SELECT p_partkey, min(new) AS m FROM run GROUP BY p_partkey) USING (p_partkey)
    """,
)
def update_guarded_stock(t: Tables) -> DataFrame:
    base, requests = stock_requests(t)
    report = O.served_one_by_one(base, requests, "p_partkey", "stock")
    return O.stock_after(base, report, "p_partkey", "stock")
