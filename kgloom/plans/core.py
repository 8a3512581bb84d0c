"""Queries: scans, scalar functions, credibility, evidence, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import audit, credibility, evidence as ev
from .view import edges, evidence, nodes, register, table

SP = "supplier_supplies_part"


def supply(s, d):
    return edges(s, d).where(f"relation = '{SP}'")


@register("o01_scan_pruned", "SELECT id, name FROM nodes WHERE node_type = 'part'", view=True)
def o01(s, d):
    return nodes(s, d).where("node_type = 'part'").select("id", "name")


@register("o02_scan_available_columns", "SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS p_absent FROM part")
def o02(s, d):
    from ..sources.readers import select_available

    return select_available(table(s, d, "part"), ["p_partkey", "p_name", "p_absent"])


@register("o04_bounded_scan", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def o04(s, d):
    from ..sources.readers import bounded

    return bounded(table(s, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100, 50)


@register("o05_filtered_shard", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey IN (1, 2, 3) AND l_quantity >= 45")
def o05(s, d):
    return table(s, d, "lineitem").where("l_returnflag = 'R' and l_suppkey in (1, 2, 3) and l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_extendedprice")


WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}


@register("o06_table_inventory", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows, CAST({n} AS INTEGER) AS n_columns FROM {t}" for t, n in WIDTHS.items()))
def o06(s, d):
    from ..sources.readers import inventory

    return inventory({t: table(s, d, t) for t in WIDTHS})


@register("o16_delete_by_source", "SELECT relation, count(*) AS kept FROM edges WHERE source IS DISTINCT FROM 'R' GROUP BY relation", view=True)
def o16(s, d):
    from ..sources.sinks import without_source

    return without_source(edges(s, d), "R").groupBy("relation").agg(F.count(F.lit(1)).alias("kept"))


@register("o20_curie", "SELECT id, regexp_replace(xref, '^(EFO|MONDO|HP|OBA|GO|MP|NCIT|GSSO|DOID|CL|UBERON|Orphanet)_([A-Za-z0-9]+)$', '\\1:\\2') AS curie FROM nodes", view=True)
def o20(s, d):
    return nodes(s, d).select("id", N.curie(F.col("xref")).alias("curie"))


@register("o21_normalise_endpoints", """
SELECT count(*) AS kept, CAST(sum(changed) AS BIGINT) AS changed FROM (SELECT DISTINCT a, xn, CASE WHEN xn <> x THEN 1 ELSE 0 END AS changed FROM
  (SELECT e.y_id AS a, n.xref AS x, CASE WHEN n.node_type IN ('customer', 'part') THEN regexp_replace(n.xref, '^(EFO|HP)_', '\\1:') ELSE n.xref END AS xn FROM edges e JOIN nodes n ON n.id = e.y_id WHERE n.xref IS NOT NULL))""", view=True)
def o21(s, d):
    n = nodes(s, d).where("xref is not null").select(F.col("id").alias("y_id"), "node_type", "xref")
    j = edges(s, d).select("y_id").join(n, "y_id")
    new = F.when(F.col("node_type").isin("customer", "part"), N.curie(F.col("xref"))).otherwise(F.col("xref"))
    j = j.select("y_id", new.alias("x"), F.when(new != F.col("xref"), 1).otherwise(0).alias("changed")).distinct()
    return j.agg(F.count(F.lit(1)).alias("kept"), F.sum("changed").alias("changed"))


@register("o22_namespaces", """
SELECT namespace, count(*) AS n FROM (SELECT CASE WHEN xref IS NULL THEN 'missing' WHEN xref LIKE 'EFO%' THEN 'EFO' WHEN xref LIKE 'MONDO%' THEN 'MONDO' WHEN xref LIKE 'HP%' THEN 'HP' WHEN xref LIKE 'UBERON%' THEN 'UBERON' ELSE 'other' END AS namespace FROM nodes) GROUP BY namespace""", view=True)
def o22(s, d):
    return nodes(s, d).groupBy(N.namespace(F.col("xref")).alias("namespace")).agg(F.count(F.lit(1)).alias("n"))


@register("o23_score_levels", """
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_discount * 10 <= 0.5 THEN 1 WHEN l_discount * 10 <= 0.9 THEN 2 ELSE 3 END AS BIGINT) AS by_score,
  CAST(CASE WHEN l_linenumber >= 4 THEN 3 WHEN l_linenumber >= 3 THEN 2 ELSE 1 END AS BIGINT) AS by_phase,
  CAST(CASE WHEN l_returnflag || l_linestatus = 'AF' THEN 3 ELSE 1 END AS BIGINT) AS by_codes FROM lineitem""")
def o23(s, d):
    codes = F.when(F.concat("l_returnflag", "l_linestatus") == "AF", F.array(F.lit("TAS"), F.lit("IEA"))).otherwise(F.array(F.lit("IEA")))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", N.enhancer_credibility(F.col("l_discount") * 10).alias("by_score"), N.phase_credibility(F.col("l_linenumber")).alias("by_phase"), N.codes_credibility(codes).alias("by_codes"))


@register("o24_subset_predicate", """
SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_returnflag NOT IN ('A', 'N')) = 0 AND count(*) FILTER (l_linestatus = 'O') = 0""")
def o24(s, d):
    g = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags"), F.collect_set("l_linestatus").alias("st"))
    return g.where(N.subset_of(F.col("flags"), ["A", "N"]) & N.subset_of(F.col("st"), ["F", "O"], ["O"])).select("l_orderkey")


@register("o25_negated_dropped", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_quantity > 48) = 0")
def o25(s, d):
    g = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_quantity") > 48).alias("qualifier_not"))).alias("evidence"))
    return g.where(~F.exists("evidence", lambda e: F.coalesce(e["qualifier_not"], F.lit(False)))).select("l_orderkey", F.size("evidence").cast("long").alias("n"))


@register("o26_text_classes", """
SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN lower(text) ~ 'safety|toxicity|adverse|side effect' THEN 'safety' WHEN lower(text) ~ 'business|sponsor|funding|financial|strategic' THEN 'business'
  WHEN lower(text) ~ 'efficacy|futility|lack of effect|ineffective' THEN 'efficacy' WHEN lang = 'en' THEN 'completed' WHEN lang = 'de' THEN 'stopped_unknown' ELSE 'unknown' END AS outcome FROM documents) GROUP BY outcome""".replace("lower(text) ~ '", "regexp_matches(lower(text), '").replace("effect' THEN", "effect') THEN").replace("strategic' THEN", "strategic') THEN").replace("ineffective' THEN", "ineffective') THEN"))
def o26(s, d):
    status = F.when(F.col("lang") == "en", "Completed").when(F.col("lang") == "de", "terminated").otherwise("other")
    return table(s, d, "documents").groupBy(N.trial_outcome(F.col("text"), status).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@register("o27_legacy_mapping", """
SELECT relation, x_id, y_id FROM (SELECT CASE relation WHEN 'customer_in_nation' THEN 'nation_has_customer' ELSE relation END AS relation,
  CASE WHEN relation = 'customer_in_nation' THEN y_id ELSE x_id END AS x_id, CASE WHEN relation = 'customer_in_nation' THEN x_id ELSE y_id END AS y_id FROM edges WHERE relation IN ('customer_in_nation', 'supplier_in_nation'))""", view=True)
def o27(s, d):
    from ..operators.migrate import migrate

    rules = s.createDataFrame([("customer_in_nation", "nation_has_customer", "nation", "customer"), ("supplier_in_nation", "supplier_in_nation", "supplier", "nation")], "old string, relation string, source_type string, target_type string")
    return migrate(edges(s, d), rules)[0].select("relation", "x_id", "y_id")


@register("o28_accept_reject", """
SELECT coalesce(reason, 'accepted') AS reason, reasons, count(*) AS n FROM (SELECT CASE WHEN l_quantity < 5 THEN 'too_few' WHEN l_discount > 0.08 THEN 'discounted' WHEN l_returnflag = 'R' THEN 'returned' END AS reason,
  concat_ws(';', CASE WHEN l_quantity < 5 THEN 'too_few' END, CASE WHEN l_discount > 0.08 THEN 'discounted' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END) AS reasons FROM lineitem) GROUP BY ALL""")
def o28(s, d):
    why = {"too_few": F.col("l_quantity") < 5, "discounted": F.col("l_discount") > 0.08, "returned": F.col("l_returnflag") == "R"}
    return table(s, d, "lineitem").groupBy(F.coalesce(audit.first_reason(**why), F.lit("accepted")).alias("reason"), audit.all_reasons(**why).alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@register("o29_measured", "SELECT count(*) FILTER (v IS NOT NULL) AS measured, count(*) AS n FROM (SELECT CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 0.0 ELSE value END AS v FROM events)")
def o29(s, d):
    v = F.when(F.col("event_id") % 3 == 0, None).when(F.col("event_id") % 3 == 1, 0.0).otherwise(F.col("value"))
    return table(s, d, "events").agg(F.count_if(N.measured(v)).alias("measured"), F.count(F.lit(1)).alias("n"))


FIRST_SEEN = """
SELECT x_id, y_id, relation, list_aggregate(list_transform(list_sort(list(s)), lambda z: z.source), 'string_agg', ',') AS source, max(credibility) AS credibility
FROM (SELECT x_id, y_id, relation, struct_pack(seq := min(seq), source := source) AS s, CAST(max(credibility) AS BIGINT) AS credibility FROM
  (SELECT 'supplier:' || l_suppkey AS x_id, 'part:' || l_partkey AS y_id, 'supplier_supplies_part' AS relation, l_returnflag AS source, l_orderkey * 10 + l_linenumber AS seq,
    CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS credibility FROM lineitem) GROUP BY x_id, y_id, relation, source) GROUP BY x_id, y_id, relation"""


def assertions(s, d):
    """Supply edges, one row per line, in line order."""
    return table(s, d, "lineitem").select(
        F.concat(F.lit("supplier:"), F.col("l_suppkey").cast("string")).alias("x_id"), F.concat(F.lit("part:"), F.col("l_partkey").cast("string")).alias("y_id"), F.lit(SP).alias("relation"),
        F.col("l_returnflag").alias("source"), F.expr("CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END").cast("long").alias("credibility"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


@register("o30_edge_dedup", FIRST_SEEN)
def o30(s, d):
    return credibility.dedup_edges(assertions(s, d))


SCORED = """
SELECT x_id, y_id, relation, CAST(CASE WHEN max(curated) = 1 THEN 3 WHEN count(DISTINCT paper_id) >= 2 THEN 2 WHEN max(CASE WHEN raw_score >= 0.95 AND datatype = 'known_drug' THEN 1 ELSE 0 END) = 1 THEN 2 ELSE 1 END AS BIGINT) AS credibility
FROM (SELECT *, row_number() OVER (PARTITION BY x_id, y_id, paper_id ORDER BY raw_score DESC, seq) AS r FROM (
  SELECT 'supplier:' || l_suppkey AS x_id, 'part:' || l_partkey AS y_id, 'supplier_supplies_part' AS relation, 'order:' || l_orderkey AS paper_id, 1 - l_discount AS raw_score, l_orderkey * 10 + l_linenumber AS seq,
    CASE WHEN l_returnflag = 'A' AND l_quantity > 45 THEN 1 ELSE 0 END AS curated, CASE WHEN l_linestatus = 'O' THEN 'known_drug' ELSE 'literature' END AS datatype FROM lineitem)) WHERE r = 1 GROUP BY x_id, y_id, relation""".replace("0.95", "0.75")


@register("o31_credibility_score", SCORED)
def o31(s, d):
    e = table(s, d, "lineitem").select(
        F.concat(F.lit("supplier:"), F.col("l_suppkey").cast("string")).alias("x_id"), F.concat(F.lit("part:"), F.col("l_partkey").cast("string")).alias("y_id"), F.lit(SP).alias("relation"),
        F.concat(F.lit("order:"), F.col("l_orderkey").cast("string")).alias("paper_id"), (1 - F.col("l_discount")).alias("raw_score"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") > 45), "reactome").otherwise("text").alias("source"), F.when(F.col("l_linestatus") == "O", "known_drug").otherwise("literature").alias("datatype"), F.lit("").alias("author_group_key"),
    )
    return credibility.score_credibility(e)


@register("o32_evidence_summary", """
SELECT x_id, y_id, count(*) AS evidence_count, string_agg(DISTINCT source, '; ' ORDER BY source) AS evidence_sources, max(evidence_score) AS best_score FROM evidence GROUP BY x_id, y_id""", view=True)
def o32(s, d):
    return ev.summary(evidence(s, d))


@register("o33_consensus", """
SELECT x_id, y_id, CASE WHEN count(DISTINCT nullif(direction, '')) = 0 THEN 'unknown' WHEN count(DISTINCT nullif(direction, '')) > 1 THEN 'conflicting' WHEN count(DISTINCT CASE WHEN direction <> '' THEN paper_id END) > 1 THEN 'consensus' ELSE 'single' END AS status,
  '[' || coalesce(string_agg(DISTINCT '"' || nullif(direction, '') || '"', ',' ORDER BY '"' || nullif(direction, '') || '"'), '') || ']' AS values_json, count(DISTINCT CASE WHEN direction <> '' THEN paper_id END) AS n_assertions FROM evidence GROUP BY x_id, y_id""", view=True)
def o33(s, d):
    return ev.consensus(evidence(s, d), ["x_id", "y_id"], "direction", "paper_id")


@register("o34_direction_features", """
SELECT e.x_id, e.y_id, CASE WHEN v.dirs IS NULL OR v.dirs = '' THEN 'unknown' WHEN v.dirs LIKE '%decrease%' AND v.dirs LIKE '%increase%' THEN 'conflicting' ELSE 'known' END AS direction_status, coalesce(v.dirs, '') AS directions, coalesce(v.n, 0) AS evidence_count
FROM edges e LEFT JOIN (SELECT x_id, y_id, coalesce(string_agg(DISTINCT nullif(direction, ''), ',' ORDER BY nullif(direction, '')), '') AS dirs, count(*) AS n FROM evidence GROUP BY x_id, y_id) v ON v.x_id = e.x_id AND v.y_id = e.y_id
WHERE e.relation = 'supplier_supplies_part'""", view=True)
def o34(s, d):
    return ev.direction_features(supply(s, d), evidence(s, d))


@register("o35_assertion_conflicts", """
SELECT conflicting, count(*) AS n FROM (SELECT count(DISTINCT nullif(e.direction, '')) > 1 AS conflicting FROM evidence e GROUP BY x_id, l_orderkey, e.source) GROUP BY conflicting""", view=True)
def o35(s, d):
    e = ev.assertion_conflicts(evidence(s, d), ["x_id", "source"], "direction", "paper_id")
    return e.select("x_id", "source", "paper_id", "conflicting").distinct().groupBy("conflicting").agg(F.count(F.lit(1)).alias("n"))


@register("o36_assertion_ids", "SELECT source_record_id, sha256(concat_ws(chr(9), edge_key, source, source_dataset, paper_id)) AS assertion_id FROM evidence", view=True)
def o36(s, d):
    return evidence(s, d).select("source_record_id", N.row_hash(*(F.col(c) for c in ("edge_key", "source", "source_dataset", "paper_id"))).alias("assertion_id"))


@register("o37_frequency_table", "SELECT relation, x_type, y_type, source, count(*) AS n, count(*) FILTER (credibility >= 2) AS credible FROM edges GROUP BY ALL", view=True)
def o37(s, d):
    return edges(s, d).groupBy("relation", "x_type", "y_type", "source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("credibility") >= 2).alias("credible"))


REGISTRY = [("nation_in_region", "nation", "region"), ("customer_in_nation", "customer", "nation"), ("supplier_in_nation", "supplier", "nation"), ("customer_places_order", "customer", "order"), ("order_contains_part", "order", "product")]


def registry(s):
    return s.createDataFrame(REGISTRY, "relation string, source_type string, target_type string")


@register("o38_contract_report", """
SELECT relation, count(*) AS rows, CAST(0 AS BIGINT) AS null_required, count(*) FILTER (relation = 'supplier_supplies_part') AS unregistered, count(*) FILTER (relation = 'order_contains_part') AS type_mismatch,
  CAST(0 AS BIGINT) AS blank_source, CAST(0 AS BIGINT) AS bad_credibility, CAST(0 AS BIGINT) AS duplicates FROM edges GROUP BY relation""", view=True)
def o38(s, d):
    return audit.contract(edges(s, d), registry(s))


@register("o39_namespace_coverage", """
SELECT namespace, count(*) AS n, count(xref) AS with_xref, array_to_string(list_sort(list(DISTINCT id))[1:3], ',') AS samples FROM (SELECT *, CASE WHEN node_type = 'region' THEN 'region' ELSE node_type END AS namespace FROM nodes) GROUP BY namespace""", view=True)
def o39(s, d):
    g = nodes(s, d).groupBy(N.namespace(F.col("id")).alias("namespace"))
    # Three sample ids are enough: min_by of a bounded list would do at scale; ids are ranked per namespace with a group limit.
    from pyspark.sql import Window as W

    first = nodes(s, d).select(N.namespace(F.col("id")).alias("namespace"), "id").withColumn("r", F.row_number().over(W.partitionBy("namespace").orderBy("id"))).where("r <= 3")
    samples = first.groupBy("namespace").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("samples"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.count("xref").alias("with_xref")).join(samples, "namespace")


@register("o40_degrees", "SELECT id, count(*) AS degree FROM (SELECT x_id AS id FROM edges UNION ALL SELECT y_id FROM edges) GROUP BY id", view=True)
def o40(s, d):
    return audit.degrees(edges(s, d))


@register("o41_feature_coverage", """
SELECT count(*) AS nodes, CAST(sum(k) AS BIGINT) AS feature_rows, count(k) AS covered, round(count(k) / count(*), 6) AS coverage, min(lo) AS shortest, max(hi) AS longest
FROM (SELECT DISTINCT p_partkey FROM part) LEFT JOIN (SELECT l_partkey, count(*) AS k, CAST(min(l_quantity) AS INTEGER) AS lo, CAST(max(l_quantity) AS INTEGER) AS hi FROM lineitem WHERE l_quantity > 40 AND l_partkey % 3 = 0 GROUP BY 1) ON l_partkey = p_partkey""")
def o41(s, d):
    f = table(s, d, "lineitem").where("l_quantity > 40 and l_partkey % 3 = 0").select(F.col("l_partkey").alias("id"), F.col("l_quantity").cast("int").alias("length"))
    return audit.coverage(f, table(s, d, "part").select(F.col("p_partkey").alias("id")), "length")


@register("o42_denominator_reasons", """
SELECT reason, count(*) AS n FROM (SELECT p_partkey, CASE WHEN p_size <= 30 THEN 'done' WHEN p_partkey % 5 = 0 THEN 'no_source' WHEN p_retailprice > 1500 THEN 'too_long' ELSE 'unknown' END AS reason FROM part) GROUP BY reason""")
def o42(s, d):
    p = table(s, d, "part")
    return audit.denominator(p, p.where("p_size <= 30"), "p_partkey", no_source=p.where("p_partkey % 5 = 0"), too_long=p.where("p_retailprice > 1500")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("o43_alias_lists", """
SELECT c_nationkey AS key, array_to_string(list_sort(list_distinct(list_concat(['n' || c_nationkey], list(DISTINCT c_mktsegment)))), '|') AS aliases FROM customer GROUP BY c_nationkey""")
def o43(s, d):
    from ..operators.mapping import alias_lists

    c = table(s, d, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_mktsegment").alias("alias"))
    old = c.select("key").distinct().withColumn("aliases", F.concat(F.lit("n"), F.col("key").cast("string")))
    return alias_lists(old, c, "key", "alias", "aliases")


@register("o44_sequence_checks", """
SELECT CASE WHEN n = 0 THEN 'empty' WHEN bad THEN 'bad_alphabet' WHEN n > 3000 THEN 'too_long' ELSE 'ok' END AS status, count(*) AS n FROM (SELECT length(text) AS n, NOT regexp_matches(text, '^[\\x00-\\x7F]+$') AS bad FROM documents) GROUP BY 1""")
def o44(s, d):
    from ..operators.features import sequence_faults

    return table(s, d, "documents").groupBy(F.coalesce(sequence_faults(F.col("text"), r"^[\x00-\x7F]+$", 3000), F.lit("ok")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("o45_interval_checks", """
SELECT coalesce(fault, 'ok') AS fault, count(*) AS n FROM (SELECT CASE WHEN l_linenumber - 1 < 1 THEN 'start_below_one' WHEN l_quantity - 10 < l_linenumber - 1 THEN 'end_before_start' WHEN l_returnflag = 'N' THEN 'bad_strand' END AS fault FROM lineitem) GROUP BY 1""")
def o45(s, d):
    from ..operators.intervals import interval_faults

    strand = F.when(F.col("l_returnflag") == "N", "x").otherwise("+")
    return table(s, d, "lineitem").groupBy(F.coalesce(interval_faults(F.col("l_linenumber") - 1, F.col("l_quantity") - 10, strand), F.lit("ok")).alias("fault")).agg(F.count(F.lit(1)).alias("n"))


@register("o46_bit_checks", """
SELECT count(*) AS n, count(*) FILTER (len(list_filter(embedding, lambda x: x > 0)) = 0) AS all_zero, CAST(sum(len(list_filter(embedding, lambda x: x > 0))) AS BIGINT) AS on_bits FROM embeddings""")
def o46(s, d):
    from ..operators.features import bit_faults

    bits = F.filter(F.transform("embedding", lambda x, i: F.when(x > 0, i)), lambda b: b.isNotNull())
    e = table(s, d, "embeddings").select(bits.alias("bits")).withColumn("fault", bit_faults(F.col("bits"), 64))
    return e.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("fault") == "all_zero").alias("all_zero"), F.sum(F.size("bits")).alias("on_bits"))


BROKEN = "(SELECT relation, x_type, x_id, y_type, CASE WHEN relation = 'supplier_supplies_part' AND CAST(split_part(y_id, ':', 2) AS BIGINT) % 97 = 0 THEN y_id || '000000000' ELSE y_id END AS y_id FROM edges)"


def broken(s, d):
    """Edges some of whose targets have no node."""
    bad = (F.col("relation") == SP) & (F.split("y_id", ":")[1].cast("long") % 97 == 0)
    return edges(s, d).withColumn("y_id", F.when(bad, F.concat("y_id", F.lit("000000000"))).otherwise(F.col("y_id")))


@register("o49_dangling_edges", f"""
SELECT e.relation, e.x_type, e.y_type, count(*) AS edges, count(*) FILTER (a.id IS NULL) AS missing_x, count(*) FILTER (b.id IS NULL) AS missing_y, count(*) FILTER (a.id IS NULL OR b.id IS NULL) AS dangling
FROM {BROKEN} e LEFT JOIN nodes a ON a.id = e.x_id AND a.node_type = e.x_type LEFT JOIN nodes b ON b.id = e.y_id AND b.node_type = e.y_type GROUP BY ALL""", view=True)
def o49(s, d):
    return audit.dangling(broken(s, d), nodes(s, d))


@register("o50_missing_endpoints", f"SELECT DISTINCT y_type AS node_type, y_id AS id FROM {BROKEN} WHERE y_id NOT IN (SELECT id FROM nodes)", view=True)
def o50(s, d):
    return audit.missing_endpoints(broken(s, d), nodes(s, d))


@register("o51_edge_evidence_parity", """
SELECT relation, count(a) AS edge_keys, count(b) AS evidence_keys, count(*) FILTER (b IS NULL) AS edges_without_evidence, count(*) FILTER (a IS NULL) AS evidence_without_edge FROM
(SELECT coalesce(e.relation, v.relation) AS relation, e.k AS a, v.k AS b FROM (SELECT DISTINCT relation, relation || '|' || x_id || '|' || y_id AS k FROM edges WHERE credibility >= 2) e
  FULL JOIN (SELECT DISTINCT relation, edge_key AS k FROM evidence WHERE source <> 'A') v ON v.k = e.k AND v.relation = e.relation) GROUP BY relation""", view=True)
def o51(s, d):
    return ev.parity(edges(s, d).where("credibility >= 2"), evidence(s, d).where("source <> 'A'"))


@register("o62_evidence_backfill", """
SELECT relation || '|' || x_id || '|' || y_id AS edge_key, CASE WHEN length(source) = 1 THEN 'ledger' ELSE source END AS source, CASE WHEN length(source) = 1 THEN source ELSE '' END AS source_dataset,
  relation || ':' || x_id || ':' || y_id || ':' || credibility || '.0000' AS source_record_id FROM edges""", view=True)
def o62(s, d):
    p = N.source_parts(F.when(F.length("source") == 1, F.concat(F.lit("ledger/"), "source")).otherwise(F.col("source")))
    return edges(s, d).select(ev.edge_key(F.col("relation"), F.col("x_id"), F.col("y_id")).alias("edge_key"), p["source"].alias("source"), p["source_dataset"].alias("source_dataset"), F.concat_ws(":", "relation", "x_id", "y_id", N.score_token(F.col("credibility"))).alias("source_record_id"))


@register("o64_stub_nodes", f"SELECT node_type, count(*) AS n, count(*) FILTER (stub) AS stubs FROM (SELECT node_type, false AS stub FROM nodes UNION ALL SELECT * FROM (SELECT DISTINCT y_type, true, y_id FROM {BROKEN} WHERE y_id NOT IN (SELECT id FROM nodes)) t(node_type, stub, id) SELECT) GROUP BY node_type".replace("UNION ALL SELECT * FROM (SELECT DISTINCT y_type, true, y_id", "UNION ALL SELECT y_type, true FROM (SELECT DISTINCT y_type, y_id").replace(") t(node_type, stub, id) SELECT)", "))"), view=True)
def o64(s, d):
    return audit.stubs(broken(s, d), nodes(s, d)).groupBy("node_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("stub").alias("stubs"))


@register("o67_mirrored_pairs", """
WITH p AS (SELECT DISTINCT 'follows' AS relation, 'user:' || user_id AS x_id, 'user:' || (event_id % 50) AS y_id FROM events)
SELECT a.relation, a.x_id AS a, a.y_id AS b FROM p a JOIN p b ON a.x_id = b.y_id AND a.y_id = b.x_id WHERE a.x_id < a.y_id""")
def o67(s, d):
    e = table(s, d, "events").select(F.lit("follows").alias("relation"), F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("x_id"), F.concat(F.lit("user:"), (F.col("event_id") % 50).cast("string")).alias("y_id"))
    return audit.mirrored(e.distinct())


@register("o68_ranked_keep_one", """
SELECT x_id, y_id, source_record_id, group_size FROM (SELECT *, count(*) OVER (PARTITION BY x_id, y_id) AS group_size, row_number() OVER (PARTITION BY x_id, y_id ORDER BY evidence_score DESC, source DESC, l_orderkey, l_linenumber) AS r FROM evidence) WHERE r = 1""", view=True)
def o68(s, d):
    return audit.keep_ranked(evidence(s, d), ["x_id", "y_id"], [F.desc("evidence_score"), F.desc("source"), F.col("l_orderkey"), F.col("l_linenumber")]).select("x_id", "y_id", "source_record_id", "group_size")


@register("o69_difference", """
SELECT 'edge_only' AS side, count(*) AS n FROM (SELECT x_id, y_id FROM edges WHERE relation = 'supplier_supplies_part' EXCEPT SELECT x_id, y_id FROM evidence WHERE evidence_score >= 0.95)
UNION ALL SELECT 'evidence_only', count(*) FROM (SELECT x_id, y_id FROM evidence WHERE evidence_score >= 0.95 EXCEPT SELECT x_id, y_id FROM edges WHERE relation = 'supplier_supplies_part' AND credibility = 3)""", view=True)
def o69(s, d):
    e, v = supply(s, d), evidence(s, d).where("evidence_score >= 0.95").select("x_id", "y_id")
    a = e.select("x_id", "y_id").subtract(v).agg(F.count(F.lit(1)).alias("n")).select(F.lit("edge_only").alias("side"), "n")
    return a.unionAll(v.subtract(e.where("credibility = 3").select("x_id", "y_id")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("evidence_only"), "n"))


@register("o77_union_aligned", "SELECT k, a, b FROM (SELECT c_custkey AS k, c_name AS a, CAST(NULL AS VARCHAR) AS b FROM customer UNION SELECT s_suppkey, NULL, s_name FROM supplier)")
def o77(s, d):
    a = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("a"))
    return a.unionByName(table(s, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("b")), allowMissingColumns=True).distinct()


@register("o79_clean_values", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN source WHEN doc_id % 4 = 1 THEN lang END AS value FROM documents")
def o79(s, d):
    k = F.col("doc_id") % 4
    a, b = F.when(k == 0, F.concat(F.lit("  "), "source", F.lit(" "))).when(k == 1, F.lit("NaN")).otherwise(F.lit(" ")), F.when(k <= 1, F.col("lang")).otherwise(F.lit("<NA>"))
    return table(s, d, "documents").select("doc_id", N.first_present(a, b).alias("value"))


@register("o80_o84_tokens", """
SELECT p_partkey, 'a' AS source, p_brand AS source_dataset, printf('%.4f', p_retailprice) AS token, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS padded, 'X' || p_partkey AS unversioned, CAST(p_size AS VARCHAR) AS chrom FROM part""")
def o80(s, d):
    p = N.source_parts(F.concat(F.lit("a/"), "p_brand"))
    return table(s, d, "part").select(
        "p_partkey", p["source"].alias("source"), p["source_dataset"].alias("source_dataset"), N.score_token(F.col("p_retailprice")).alias("token"), N.zero_padded(F.col("p_partkey"), 9).alias("padded"),
        N.no_version(F.concat(F.lit("X"), F.col("p_partkey").cast("string"), F.lit("."), F.col("p_size").cast("string"))).alias("unversioned"), N.chromosome(F.concat(F.lit("chr"), F.col("p_size").cast("string"))).alias("chrom"),
    )


@register("o82_o83_parse", """
SELECT event_id, 'PMID:' || event_id AS pmids, '10.1/' || lower(event_type) AS doi, 'uid' AS db, CAST(user_id AS VARCHAR) AS id, event_type AS label, 'a,' || event_type AS parts FROM events""")
def o82(s, d):
    e = F.col("event_id").cast("string")
    x = N.xref_token(F.concat(F.lit("uid:"), F.col("user_id").cast("string"), F.lit("("), "event_type", F.lit(")")))
    return table(s, d, "events").select("event_id", F.array_join(N.pmids(F.concat(F.lit("pubmed:"), e, F.lit(" and PMID "), e)), ",").alias("pmids"), N.doi(F.concat(F.lit("https://doi.org/10.1/"), F.upper("event_type"))).alias("doi"), x["db"].alias("db"), x["id"].alias("id"), x["label"].alias("label"), F.array_join(N.pipe_list(F.concat(F.lit("a | - ||"), "event_type")), ",").alias("parts"))


@register("o85_text_hash", "SELECT doc_id, sha256(text) AS sha FROM documents")
def o85(s, d):
    return table(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@register("o86_json_fields", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}' AS metadata_json FROM events")
def o86(s, d):
    return table(s, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.to_json(F.struct("event_type", "user_id")).alias("metadata_json"))


@register("o87_finite_numbers", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN NULL WHEN event_id % 5 = 2 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS v FROM events")
def o87(s, d):
    k = F.col("event_id") % 5
    t = F.when(k == 0, "x1").when(k == 1, "NaN").when(k == 2, "Infinity").otherwise(F.col("user_id").cast("string"))
    return table(s, d, "events").select("event_id", N.finite(t).alias("v"))


@register("o88_o89_lists_dates", "SELECT o_orderkey, o_orderpriority || '; x' AS vals, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def o88(s, d):
    v = N.joined(F.array(F.lit("x"), F.lit(""), F.col("o_orderpriority"), F.lit("x")))
    return table(s, d, "orders").select("o_orderkey", v.alias("vals"), N.first_date(F.lit("no date"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))


@register("o90_sequence_windows", """
SELECT doc_id, CAST(greatest(0, least(i * 200, n - 300)) AS INTEGER) AS "start", CAST(least(greatest(0, least(i * 200, n - 300)) + 300, n) AS INTEGER) AS "end" FROM (SELECT doc_id, length(text) AS n, unnest(range(0, CAST(greatest(0, ceil((length(text) - 300) / 200.0)) AS INTEGER) + 1)) AS i FROM documents WHERE length(text) > 0)""")
def o90(s, d):
    return table(s, d, "documents").select("doc_id", F.explode(N.windows(F.col("text"), 300, 200)).alias("w")).select("doc_id", F.col("w.start").cast("int").alias("start"), F.col("w.end").cast("int").alias("end"))


@register("o91_reverse_complement", "SELECT doc_id, reverse(translate(text, 'ACGTacgt', 'TGCAtgca')) AS rc, substring(text, 4, 9) AS around FROM documents")
def o91(s, d):
    return table(s, d, "documents").select("doc_id", N.reverse_complement(F.col("text")).alias("rc"), N.context(F.col("text"), F.lit(8), 4).alias("around"))


@register("o92_invalid_letters", """
SELECT p_partkey, nullif(array_to_string(list_sort(list_distinct(list_filter(string_split(upper(p_name), ''), lambda x: x NOT IN ('A', 'C', 'G', 'T', 'N', ''))))[1:10], ''), '') AS bad FROM part""")
def o92(s, d):
    return table(s, d, "part").select("p_partkey", N.invalid_letters(F.col("p_name"), "ACGTN").alias("bad"))


@register("o93_edge_weight", "SELECT l_orderkey, l_linenumber, round(CASE l_returnflag WHEN 'N' THEN 1.5 WHEN 'A' THEN 1.25 ELSE 1.0 END * CASE WHEN l_discount > 0 THEN least(l_discount, 1.0) ELSE 1.0 END, 6) AS weight FROM lineitem")
def o93(s, d):
    c = F.expr("CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END")
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(N.edge_weight(c, F.col("l_discount")), 6).alias("weight"))


@register("o94_o96_payload", "SELECT p_partkey, 'name: ' || p_name || chr(10) || 'brand: ' || p_brand AS payload, left(p_name, 10) AS short FROM part")
def o94(s, d):
    return table(s, d, "part").select("p_partkey", N.payload(name=F.col("p_name"), gap=F.lit("nan"), brand=F.col("p_brand")).alias("payload"), N.bounded_text(F.concat(F.lit(" "), "p_name"), 10).alias("short"))


@register("o95_hashed_text")
def o95(s, d):
    from ..operators.features import hashed_text

    v = hashed_text(table(s, d, "documents").select("doc_id", "text"), "text", 256)
    return v.select("doc_id", F.round(F.expr("aggregate(vector, 0D, (a, x) -> a + x * x)"), 6).alias("norm2"))


@register("o175_sql_functions", "SELECT id, regexp_replace(xref, '^(EFO|HP|UBERON)_', '\\1:') AS norm FROM nodes WHERE node_type <> 'order'", view=True)
def o175(s, d):
    return nodes(s, d).where("node_type <> 'order'").select("id", N.curie(F.col("xref")).alias("norm"))


@register("o178_sequence_lengths", "SELECT count(*) AS n, count(*) FILTER (length(text) > 1000) AS over, CAST(sum(CASE WHEN length(text) > 0 THEN greatest(0, ceil((length(text) - 1000) / 500.0)) + 1 ELSE 0 END) AS BIGINT) AS windows, CAST(min(length(text)) AS INTEGER) AS shortest, CAST(max(length(text)) AS INTEGER) AS longest FROM documents")
def o178(s, d):
    from ..operators.features import length_audit

    return length_audit(table(s, d, "documents"), "text", 1000, 500)
