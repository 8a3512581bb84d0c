"""A typed, evidence-carrying graph view over the star-schema tables, in DataFrames and in the SQL of the oracle.

nodes (id, node_type, name, xref, taxon), edges (x_id, x_type, y_id, y_type, relation, display_relation, source,
credibility) and evidence (edge_key, relation, x_id, x_type, y_id, y_type, ...). Ids are `type:key`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, sql: str | None = None, view: bool = False):
    """Registers a query and, if SQL can express it, the SQL; with view, the graph view's CTEs are put in front."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = (VIEW_SQL + sql) if view else sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(kind: str, key: str):
    return F.concat(F.lit(f"{kind}:"), F.col(key).cast("string"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    pad = lambda p, k: F.concat(F.lit(p), F.lpad(F.col(k).cast("string"), 7, "0"))
    none = F.lit(None).cast("string")
    parts = [
        t("region").select(_id("region", "r_regionkey").alias("id"), F.lit("region").alias("node_type"), F.col("r_name").alias("name"), none.alias("xref"), none.alias("taxon")),
        t("nation").select(_id("nation", "n_nationkey"), F.lit("nation"), "n_name", pad("UBERON_", "n_nationkey"), none),
        t("customer").select(_id("customer", "c_custkey"), F.lit("customer"), "c_name", pad("HP_", "c_custkey"), F.col("c_mktsegment")),
        t("supplier").select(_id("supplier", "s_suppkey"), F.lit("supplier"), "s_name", pad("MONDO:", "s_suppkey"), none),
        t("part").select(_id("part", "p_partkey"), F.lit("part"), "p_name", pad("EFO_", "p_partkey"), F.col("p_brand")),
        t("orders").select(_id("order", "o_orderkey"), F.lit("order"), "o_orderpriority", none, F.col("o_orderstatus")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


FLAG = "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END"


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)

    def edge(df, xt, xk, yt, yk, relation, source, credibility):
        return df.select(
            _id(xt, xk).alias("x_id"), F.lit(xt).alias("x_type"), _id(yt, yk).alias("y_id"), F.lit(yt).alias("y_type"), F.lit(relation).alias("relation"),
            F.lit(relation.replace("_", " ")).alias("display_relation"), source.alias("source"), credibility.cast("long").alias("credibility"),
        )

    line = t("lineitem")
    best = F.expr(f"max({FLAG})")
    op = line.groupBy("l_orderkey", "l_partkey").agg(F.min("l_linestatus").alias("s"), best.alias("c"))
    sp = line.groupBy("l_suppkey", "l_partkey").agg(F.min("l_returnflag").alias("s"), best.alias("c"))
    return (
        edge(t("nation"), "nation", "n_nationkey", "region", "n_regionkey", "nation_in_region", F.lit("atlas"), F.lit(3))
        .unionAll(edge(t("customer"), "customer", "c_custkey", "nation", "c_nationkey", "customer_in_nation", F.lit("crm"), F.lit(2)))
        .unionAll(edge(t("supplier"), "supplier", "s_suppkey", "nation", "s_nationkey", "supplier_in_nation", F.lit("erp"), F.lit(2)))
        .unionAll(edge(t("orders"), "customer", "o_custkey", "order", "o_orderkey", "customer_places_order", F.col("o_orderstatus"), F.lit(1)))
        .unionAll(edge(op, "order", "l_orderkey", "part", "l_partkey", "order_contains_part", F.col("s"), F.col("c")))
        .unionAll(edge(sp, "supplier", "l_suppkey", "part", "l_partkey", "supplier_supplies_part", F.col("s"), F.col("c")))
    )


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = _id("supplier", "l_suppkey"), _id("part", "l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("|", F.lit("supplier_supplies_part"), x, y).alias("edge_key"), F.lit("supplier_supplies_part").alias("relation"),
        x.alias("x_id"), F.lit("supplier").alias("x_type"), y.alias("y_id"), F.lit("part").alias("y_type"),
        F.when(F.col("l_linestatus") == "O", "association_score").otherwise("correlative").alias("evidence_type"),
        F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("source_dataset"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_record_id"), _id("order", "l_orderkey").alias("paper_id"),
        F.round(1 - F.col("l_discount"), 2).alias("evidence_score"),
        F.expr("CASE l_linenumber % 3 WHEN 0 THEN 'increase' WHEN 1 THEN 'decrease' ELSE '' END").alias("direction"),
        F.col("l_orderkey").alias("l_orderkey"), F.col("l_linenumber").alias("l_linenumber"),
    )


VIEW_SQL = f"""
WITH RECURSIVE nodes(id, node_type, name, xref, taxon) AS (
  SELECT 'region:' || r_regionkey, 'region', r_name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, 'nation', n_name, 'UBERON_' || lpad(CAST(n_nationkey AS VARCHAR), 7, '0'), NULL FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'customer', c_name, 'HP_' || lpad(CAST(c_custkey AS VARCHAR), 7, '0'), c_mktsegment FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier', s_name, 'MONDO:' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0'), NULL FROM supplier
  UNION ALL SELECT 'part:' || p_partkey, 'part', p_name, 'EFO_' || lpad(CAST(p_partkey AS VARCHAR), 7, '0'), p_brand FROM part
  UNION ALL SELECT 'order:' || o_orderkey, 'order', o_orderpriority, NULL, o_orderstatus FROM orders),
edges(x_id, x_type, y_id, y_type, relation, display_relation, source, credibility) AS (
  SELECT 'nation:' || n_nationkey, 'nation', 'region:' || n_regionkey, 'region', 'nation_in_region', 'nation in region', 'atlas', CAST(3 AS BIGINT) FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'customer', 'nation:' || c_nationkey, 'nation', 'customer_in_nation', 'customer in nation', 'crm', 2 FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier', 'nation:' || s_nationkey, 'nation', 'supplier_in_nation', 'supplier in nation', 'erp', 2 FROM supplier
  UNION ALL SELECT 'customer:' || o_custkey, 'customer', 'order:' || o_orderkey, 'order', 'customer_places_order', 'customer places order', o_orderstatus, 1 FROM orders
  UNION ALL SELECT 'order:' || l_orderkey, 'order', 'part:' || l_partkey, 'part', 'order_contains_part', 'order contains part', min(l_linestatus), max({FLAG}) FROM lineitem GROUP BY l_orderkey, l_partkey
  UNION ALL SELECT 'supplier:' || l_suppkey, 'supplier', 'part:' || l_partkey, 'part', 'supplier_supplies_part', 'supplier supplies part', min(l_returnflag), max({FLAG}) FROM lineitem GROUP BY l_suppkey, l_partkey),
evidence AS (
  SELECT 'supplier_supplies_part|supplier:' || l_suppkey || '|part:' || l_partkey AS edge_key, 'supplier_supplies_part' AS relation, 'supplier:' || l_suppkey AS x_id, 'supplier' AS x_type,
    'part:' || l_partkey AS y_id, 'part' AS y_type, CASE WHEN l_linestatus = 'O' THEN 'association_score' ELSE 'correlative' END AS evidence_type, l_returnflag AS source, l_linestatus AS source_dataset,
    l_orderkey || '-' || l_linenumber AS source_record_id, 'order:' || l_orderkey AS paper_id, round(1 - l_discount, 2) AS evidence_score,
    CASE l_linenumber % 3 WHEN 0 THEN 'increase' WHEN 1 THEN 'decrease' ELSE '' END AS direction, l_orderkey, l_linenumber
  FROM lineitem)
"""
