"""Queries: manifests, exports, templates, artefacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import artefacts as A, compose as C, evidence as ev, graph as G
from .core import SP, supply
from .graph import APART2, APART3, COMMON2, COMMON3, NOVEL, PREMISES, SIGN2, premises
from .view import edges, evidence, nodes, register, table


#: Columns of the tables; the manifest leaves out the vectors, which the engines print differently.
COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate", "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars", "embeddings": "vec_id", "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}
_text = lambda c: f"CAST(epoch_us({c}) AS VARCHAR)" if c in ("ts", "o_orderdate", "l_shipdate") else f"CAST({c} AS VARCHAR)"
_canonical = lambda cols: " || ".join(f"coalesce(length({_text(c)}) || ':' || {_text(c)}, '-')" for c in cols)
DIGEST = " || ':' || ".join(f"coalesce(CAST(sum(CAST('0x' || substr(k, {at}, {n}) AS HUGEINT)) AS VARCHAR), '0')" for at, n in ((1, 11), (12, 11), (23, 10)))


@register("o07_manifest", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows, {DIGEST} AS content_digest FROM (SELECT md5({_canonical(c.split())}) AS k FROM {t})" for t, c in COLUMNS.items()))
def o07(s, d):
    from ..sources.readers import manifest

    return manifest({t: table(s, d, t).select(*c.split()) for t, c in COLUMNS.items()}).drop("schema_hash")


@register("o18_legacy_index", """
SELECT x_type, count(*) AS n, CAST(max(i) AS BIGINT) AS top FROM (SELECT 'customer' AS x_type, row_number() OVER (ORDER BY x_id) - 1 AS i FROM (SELECT DISTINCT x_id FROM edges WHERE relation = 'customer_in_nation') UNION ALL SELECT 'nation', row_number() OVER (ORDER BY y_id) - 1 FROM (SELECT DISTINCT y_id FROM edges WHERE relation = 'customer_in_nation')) GROUP BY x_type""", view=True)
def o18(s, d):
    e = edges(s, d).where("relation = 'customer_in_nation'")
    ends = e.select(F.col("x_type").alias("node_type"), F.col("x_id").alias("id")).unionAll(e.select("y_type", "y_id"))
    return G.dense_index(ends).groupBy(F.col("node_type").alias("x_type")).agg(F.count(F.lit(1)).alias("n"), F.max("index").alias("top"))


@register("o109_category_edges", """
SELECT 'nodes' AS part, (SELECT count(*) FROM nodes) + (SELECT count(DISTINCT p_brand) FROM part) AS n UNION ALL SELECT 'edges', (SELECT count(*) FROM edges) + (SELECT count(*) FROM part)""", view=True)
def o109(s, d):
    m = table(s, d, "part").select(F.concat(F.lit("part:"), F.col("p_partkey").cast("string"), F.lit(".0")).alias("id"), F.col("p_brand").alias("area"))
    n, e = A.add_category(nodes(s, d).select("id", "node_type", "name"), edges(s, d).select("x_id", "x_type", "y_id", "y_type", "relation"), m, "brand")
    return n.agg(F.count(F.lit(1)).alias("n")).select(F.lit("nodes").alias("part"), "n").unionAll(e.agg(F.count(F.lit(1)).alias("n")).select(F.lit("edges"), "n"))


SEQUENCE = "l0 AS (SELECT node_type AS g, i AS p, '=' || id AS v, 1 AS n FROM i)" + "".join(f", l{k} AS (SELECT g, p // 4096 AS p, sha256(string_agg(v, chr(10) ORDER BY p)) AS v, sum(n) AS n FROM l{k - 1} GROUP BY g, p // 4096)" for k in range(1, 5))


@register("o110_indexed_export", f"""
, i AS (SELECT id, node_type, row_number() OVER (PARTITION BY node_type ORDER BY id) - 1 AS i FROM nodes WHERE node_type <> 'order' AND NOT (node_type = 'part' AND id LIKE '%7')),
e AS (SELECT relation, x_id, y_id FROM edges WHERE x_type <> 'order' AND y_type <> 'order' UNION ALL SELECT 'rev_' || relation, y_id, x_id FROM edges WHERE x_type <> 'order' AND y_type <> 'order'),
j AS (SELECT relation, x_id, y_id, a.i AS src, b.i AS dst FROM e LEFT JOIN i a ON a.id = e.x_id LEFT JOIN i b ON b.id = e.y_id),
k AS (SELECT relation, md5({_canonical(['x_id', 'y_id', 'src', 'dst'])}) AS k, src IS NULL OR dst IS NULL AS lost FROM j), {SEQUENCE}
SELECT 'nodes' AS part, g AS name, CAST(n AS BIGINT) AS n_rows, v AS digest, CAST(NULL AS VARCHAR) AS issue FROM l4
UNION ALL SELECT 'edges', a.name, n_rows, digest, CASE WHEN lost > 0 THEN 'dangling_edges:' || lost END FROM (SELECT relation AS name, count(*) AS n_rows, {DIGEST} AS digest FROM k WHERE NOT lost GROUP BY relation) a JOIN (SELECT relation AS name, count(*) FILTER (lost) AS lost FROM k GROUP BY relation) b ON a.name = b.name""", view=True)
def o110(s, d):
    """A graph of which the parts whose id ends in 7 are no nodes: their edges are reported as dangling."""
    from ..operators.cuts import scratch
    from ..sources.export import indexed_export

    return indexed_export(nodes(s, d).where("not (node_type = 'part' and id like '%7')"), edges(s, d), scratch(s, "indexed"), exclude=("order",))


@register("o113_three_valued", "SELECT edge_key, CASE WHEN count(DISTINCT source) = 1 THEN 'known' ELSE 'conflicting' END AS state FROM evidence GROUP BY edge_key UNION ALL SELECT 'none', 'unknown'", view=True)
def o113(s, d):
    e = evidence(s, d).groupBy("edge_key").agg(F.array_join(F.collect_set("source"), ",").alias("v"))
    return e.unionAll(s.range(1).select(F.lit("none"), F.lit(" unknown ,"))).select("edge_key", C.resolved(F.col("v")).alias("state"))


@register("o114_context_gates", """
SELECT a = b AS agrees, a = b AS shares, a <> b AS apart, count(*) AS n FROM (SELECT lower(l_returnflag) AS a, CASE WHEN l_linestatus = 'O' THEN 'n' ELSE 'r' END AS b FROM lineitem) GROUP BY 1, 2, 3""")
def o114(s, d):
    a, b = F.col("l_returnflag"), F.when(F.col("l_linestatus") == "O", "N").otherwise("R")
    return table(s, d, "lineitem").groupBy(C.agree(a, b).alias("agrees"), C.shared(a, b).alias("shares"), C.independent(a, b).alias("apart")).agg(F.count(F.lit(1)).alias("n"))


@register("o115_sign_algebra", """
SELECT CAST(CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN -1 WHEN 2 THEN 0 END * CASE l_returnflag WHEN 'R' THEN -1 WHEN 'A' THEN 1 END AS INTEGER) AS disease_sign, count(*) AS n FROM lineitem GROUP BY 1""")
def o115(s, d):
    k = F.col("l_linenumber") % 4
    mechanism = F.when(k == 0, "gain_of_function").when(k == 1, "loss_of_function").when(k == 2, "increase, inhibitor").otherwise("hypomorphic")
    effect = F.when(F.col("l_returnflag") == "R", "protective").when(F.col("l_returnflag") == "A", "Risk").otherwise("unknown")
    return table(s, d, "lineitem").groupBy((C.sign(mechanism) * C.sign(effect)).alias("disease_sign")).agg(F.count(F.lit(1)).alias("n"))


def template(name, t, joins, reason="'accepted'"):
    """Registers a template's ledger of paths by reason."""
    sql = PREMISES + f"SELECT '{t.name}' AS template, {reason} AS reason, count(*) AS paths FROM {joins} GROUP BY ALL"

    @register(name, sql, view=True)
    def run(s, d, t=t):
        return C.counted(premises(s, d), t)


P = lambda a, r: f"(SELECT * FROM pre WHERE relation = '{r}') {a}"
case = lambda *conditions: f"CASE {' '.join(conditions)} ELSE 'accepted' END"
CO, OP, SN = "customer_places_order", "order_contains_part", "supplier_in_nation"
LOCAL = f"{P('a', SN)} JOIN {P('b', SP)} ON a.x_id = b.x_id"
MISMATCH2, MISMATCH3 = f"WHEN {APART2} THEN 'context_mismatch'", f"WHEN {APART3} THEN 'context_mismatch'"
BOUND2, BOUND3 = f"WHEN {COMMON2} THEN 'source_not_independent'", f"WHEN {COMMON3} THEN 'source_not_independent'"
SIGN3 = "WHEN a.sgn * b.sgn * c.sgn = 0 THEN 'conflicting_sign' WHEN a.sgn * b.sgn * c.sgn IS NULL THEN 'missing_sign' WHEN a.sgn * b.sgn * c.sgn <> -1 THEN 'other_sign'"
template("o120_two_premise_attribution", C.Template("order_attribution_v1", ((CO, "c", "o"), (OP, "o", "p")), ("c", "p"), "customer_gets_part", context=("tissue",)), f"{P('a', CO)} JOIN {P('b', OP)} ON a.y_id = b.x_id", case(MISMATCH2))
template("o121_three_premise_attribution", C.Template("chain_attribution_v1", ((SP, "s", "p"), (SN, "s", "n"), (OP, "o", "p")), ("o", "n"), "order_served_from", context=("tissue",)), f"{P('a', SP)} JOIN {P('b', SN)} ON a.x_id = b.x_id JOIN {P('c', OP)} ON c.y_id = a.y_id", case(MISMATCH3))
template("o122_independent_candidate", C.Template("nation_part_v1", ((SN, "s", "n"), (SP, "s", "p")), ("n", "p"), "nation_offers_part", context=("tissue",), independent=True), LOCAL, case(MISMATCH2, BOUND2))
template("o124_existential", C.Template("supplier_part_nation_v1", ((SN, "s", "n"), (SP, "s", "p")), ("p", "n"), "part_from_nation"), LOCAL)
template("o128_projection", C.Template("customer_supplier_v1", ((CO, "c", "o"), (OP, "o", "p"), (SP, "s", "p")), ("c", "s"), "customer_may_use_supplier", independent=True), f"{P('a', CO)} JOIN {P('b', OP)} ON a.y_id = b.x_id JOIN {P('c', SP)} ON c.y_id = b.y_id", case(BOUND3))
template("o135_triple_sign", C.Template("triple_sign_v1", ((SN, "s", "n"), (SP, "s", "p"), (OP, "o", "p")), ("n", "o"), "nation_hinders_order", signed=-1), f"{LOCAL} JOIN {P('c', OP)} ON c.y_id = b.y_id", case(SIGN3))


# Supplier, its nation and its part stand for variant, disease and protein; the order that holds the part for the gene.
GATED = ((SP, "s", "p"), (SN, "s", "n"))
LONG = (*GATED, (OP, "o", "p"))
TWO = f"{P('a', SP)} JOIN {P('b', SN)} ON a.x_id = b.x_id"
THREE = f"{TWO} JOIN {P('c', OP)} ON c.y_id = a.y_id"
REFUSED = "WHEN b.refused IS NOT NULL THEN b.refused"
#: Isoform ids that are known, of which nulls don't count, must agree.
ALIKE = "WHEN a.iso <> b.iso OR b.iso <> c.iso OR a.iso <> c.iso THEN 'isoform_or_assembly_mismatch'"
template("o125_gated_candidate", C.Template("part_nation_gated_v1", GATED, ("p", "n"), "part_matters_in_nation", context=("tissue",), gates=(C.pathogenic(1),)), TWO, case(REFUSED, MISMATCH2))
template("o126_gated_mapped_candidate", C.Template("order_nation_gated_v1", LONG, ("o", "n"), "order_matters_in_nation", mapping=("isoform_id",), gates=(C.pathogenic(1),)), THREE, case(REFUSED, ALIKE))
template("o127_mapped_candidate", C.Template("order_nation_mapped_v1", LONG, ("o", "n"), "order_shows_in_nation", context=("tissue",), mapping=("isoform_id",)), THREE, case(MISMATCH3, ALIKE))
template("o129_projection_by_mapping", C.Template("order_nation_projected_v1", LONG, ("o", "n"), "order_from_nation", mapping=("isoform_id", "tissue")), THREE, case(ALIKE, f"WHEN {APART3} THEN 'isoform_or_assembly_mismatch'"))
template("o130_named_isoform", C.Template("part_nation_named_v1", GATED, ("p", "n"), "part_named_in_nation", context=("tissue",), gates=(C.names(0, 0),)), TWO, case("WHEN NOT a.named THEN 'isoform_not_named'", MISMATCH2))
template("o133_localisation", C.Template("nation_part_localised_v1", ((SN, "s", "n"), (SP, "s", "p")), ("n", "p"), "nation_holds_part", context=("tissue",)), LOCAL, case(MISMATCH2))
template("o133_localisation_triangle", C.Template("nation_part_localised_triangle_v1", ((SN, "s", "n"), (SP, "s", "p")), ("n", "p"), "nation_holds_part", context=("tissue",), triangle="nation_offers_part"), f"{LOCAL} LEFT JOIN {P('c', 'nation_offers_part')} ON c.x_id = a.y_id AND c.y_id = b.y_id", case(MISMATCH2, "WHEN c.x_id IS NULL THEN 'no_closing_edge'"))
template("o136_efficacy", C.Template("part_nation_efficacy_v1", GATED, ("p", "n"), "part_works_in_nation", context=("tissue",), gates=(C.states(0, "direction", "increase", "no_benefit"), C.states(1, "pathogenicity", "pathogenic", "not_efficacy"))), TWO, case("WHEN coalesce(a.sgn, 0) <> 1 THEN 'no_benefit'", "WHEN NOT b.proven THEN 'not_efficacy'", MISMATCH2))


@register("o131_member_views", """
, m AS (SELECT DISTINCT x_id AS g, y_id AS m FROM edges WHERE relation = 'customer_places_order'), z AS (SELECT g, count(*) AS n_members FROM m GROUP BY g)
SELECT g, m, y_id AS y, n_members FROM m JOIN z USING (g) JOIN (SELECT DISTINCT x_id, y_id FROM edges WHERE relation = 'order_contains_part') t ON t.x_id = m WHERE n_members <= 500""", view=True)
def o131(s, d):
    e = edges(s, d)
    return C.member_views(e.where("relation = 'customer_places_order'"), e.where("relation = 'order_contains_part'"))


@register("o118_ledger_samples", PREMISES + """
SELECT reason, x_id, y_id, CAST(r AS INTEGER) AS r FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY x_id, y_id, path) AS r FROM (SELECT a.x_id, b.x_id AS y_id, 'supplier_supplies_part|' || a.x_id || '|' || a.y_id || '>order_contains_part|' || b.x_id || '|' || b.y_id AS path,
  CASE """ + SIGN2 + " WHEN " + APART2 + """ THEN 'context_mismatch' WHEN a.tissue IS NULL OR b.tissue IS NULL THEN 'missing_shared_context' END AS reason FROM """ + NOVEL + """) WHERE reason IS NOT NULL) WHERE r <= 5""", view=True)
def o118(s, d):
    from .graph import T_SIGNED

    return C.samples(premises(s, d), T_SIGNED, 5).select("reason", "x_id", "y_id", "r")


@register("o158_hierarchy_edges", "SELECT 'UBERON:' || lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS x_id, 'UBERON:' || lpad(CAST(n_regionkey AS VARCHAR), 7, '0') AS y_id FROM nation WHERE n_nationkey <> n_regionkey")
def o158(s, d):
    curie = lambda c: N.curie(F.concat(F.lit("UBERON_"), N.zero_padded(F.col(c), 7)))
    n = table(s, d, "nation").select(curie("n_nationkey").alias("x_id"), F.array(curie("n_regionkey")).alias("parents"))
    return n.select("x_id", F.explode("parents").alias("y_id")).where("x_id <> y_id").distinct()


@register("o161_mechanisms", "SELECT DISTINCT 'supplier:' || l_suppkey AS x_id, 'part:' || l_partkey AS y_id, CASE WHEN l_returnflag = 'R' THEN 'inhibitor' ELSE 'agonist' END AS action, CAST(CASE WHEN l_linenumber >= 4 THEN 3 WHEN l_linenumber >= 3 THEN 2 ELSE 1 END AS BIGINT) AS credibility FROM lineitem")
def o161(s, d):
    x = table(s, d, "lineitem").select(F.array(F.concat(F.lit("supplier:"), F.col("l_suppkey").cast("string"))).alias("drugs"), F.array(F.concat(F.lit("part:"), F.col("l_partkey").cast("string"))).alias("targets"), F.when(F.col("l_returnflag") == "R", "INHIBITOR").otherwise("AGONIST").alias("actionType"), "l_linenumber")
    x = x.select(F.explode("drugs").alias("x_id"), "targets", "actionType", "l_linenumber").select("x_id", F.explode("targets").alias("y_id"), F.lower("actionType").alias("action"), N.phase_credibility(F.col("l_linenumber")).alias("credibility"))
    return x.distinct()


@register("o165_existing_endpoints", "SELECT DISTINCT 'part:' || l_partkey AS x_id, 'HP:' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS y_id FROM lineitem JOIN customer ON c_custkey = l_orderkey % 400")
def o165(s, d):
    r = table(s, d, "lineitem").select(F.concat(F.lit("part:"), F.col("l_partkey").cast("string")).alias("x_id"), N.curie(F.concat(F.lit("HP_"), N.zero_padded(F.col("l_orderkey") % 400, 7))).alias("y_id"))
    known = nodes(s, d).where("node_type = 'customer'").select(N.curie(F.col("xref")).alias("y_id"))
    return r.join(known, "y_id", "left_semi").join(nodes(s, d).select(F.col("id").alias("x_id")), "x_id", "left_semi").select("x_id", "y_id").distinct()


@register("o174_text_features", "SELECT doc_id AS id, t AS text, sha256(t) AS content_hash FROM (SELECT doc_id, left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 200) AS t FROM documents) WHERE t <> ''")
def o174(s, d):
    t = table(s, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return A.text_features(t.select("id"), t, 200)


@register("o176_native_endpoint_gate", "SELECT x_id, y_id FROM edges WHERE relation = 'supplier_supplies_part' AND regexp_matches(y_id, '^part:[0-9]*[05]$')", view=True)
def o176(s, d):
    e = supply(s, d).where(F.col("y_id").rlike("^part:[0-9]*[05]$"))
    return e.join(nodes(s, d).select(F.col("id").alias("y_id")), "y_id", "left_semi").select("x_id", "y_id")


@register("o177_source_metadata", """
SELECT relation, CASE WHEN length(source) = 1 THEN 'ledger' ELSE source END AS source, CASE WHEN length(source) = 1 THEN source WHEN relation LIKE '%\\_in\\_nation' ESCAPE '\\' THEN 'geography' ELSE 'transactions' END AS dataset, CASE WHEN relation LIKE 'supplier%' THEN 'supply' WHEN relation LIKE 'customer%' THEN 'demand' ELSE 'reference' END AS kind, count(*) AS n FROM edges GROUP BY ALL""", view=True)
def o177(s, d):
    raw = F.when(F.length("source") == 1, F.concat(F.lit("ledger/"), "source")).otherwise(F.col("source"))
    m = edges(s, d).select("relation", A.source_metadata(F.col("relation"), raw).alias("m"))
    return m.groupBy("relation", F.col("m.source").alias("source"), F.col("m.dataset").alias("dataset"), F.col("m.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@register("o179_edge_text", """
SELECT edge_key, 'supplies: ' || x_id || ' ' || y_id || chr(10) || string_agg(source_record_id || ' ' || source, chr(10) ORDER BY source_record_id, source) AS payload FROM evidence GROUP BY edge_key, x_id, y_id""", view=True)
def o179(s, d):
    g = evidence(s, d).groupBy("edge_key", "x_id", "y_id").agg(F.array_sort(F.collect_list(F.struct("source_record_id", "source"))).alias("blocks"))
    body = F.array_join(F.transform("blocks", lambda b: F.concat_ws(" ", b["source_record_id"], b["source"])), "\n")
    return g.select("edge_key", F.concat(F.lit("supplies: "), "x_id", F.lit(" "), "y_id", F.lit("\n"), body).alias("payload"))


@register("o180_interval_rows", "SELECT k AS feature_key, o_orderkey AS id, c AS chromosome, sha256(k) AS coordinate_hash FROM (SELECT o_orderkey, CAST(o_custkey % 22 AS VARCHAR) AS c, o_orderkey || '|v1|' || (o_custkey % 22) || '|' || o_orderkey || '|' || (o_orderkey + 9) AS k FROM orders)")
def o180(s, d):
    r = table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("chr"), (F.col("o_custkey") % 22).cast("string")).alias("chromosome"), F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 9).alias("end"))
    return A.interval_features(r, "v1").select("feature_key", "id", "chromosome", "coordinate_hash")


@register("o181_compact_vectors", "SELECT CAST(64 AS INTEGER) AS dim, count(*) AS keys, count(*) FILTER (vec_id % 4 = 0) AS repeated FROM embeddings")
def o181(s, d):
    e = table(s, d, "embeddings")
    return A.compact([e.where("vec_id % 2 = 0"), e.where("vec_id % 2 = 1 or vec_id % 4 = 0")], "vec_id", "embedding")[1]


@register("o181_source_identity", "SELECT count(*) FILTER (doc_id % 3 <> 0 AND doc_id % 5 <> 0) AS shared, count(*) FILTER (doc_id % 3 <> 0 AND doc_id % 5 = 0) AS only_embedded, count(*) FILTER (doc_id % 3 = 0 AND doc_id % 5 <> 0) AS only_source, count(*) FILTER (doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND doc_id % 7 = 0) AS different FROM documents")
def o181b(s, d):
    t = table(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    changed = t.withColumn("h", F.when(F.col("doc_id") % 7 == 0, "other").otherwise(F.col("h")))
    return A.source_identity(t.where("doc_id % 3 <> 0"), changed.where("doc_id % 5 <> 0"), "doc_id", "h")


@register("o182_reconcile_unique", "SELECT p_partkey, CASE WHEN b IN ('Brand#11', 'Brand#12') OR row_number() OVER (PARTITION BY b ORDER BY p_partkey) > 1 THEN NULL ELSE b END AS brand FROM (SELECT p_partkey, p_brand AS b FROM part)")
def o182(s, d):
    p = table(s, d, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    old = s.range(1).select(F.explode(F.array(F.lit("Brand#11"), F.lit("Brand#12"))).alias("brand"), F.lit(-1).cast("long").alias("p_partkey"))
    return A.reconcile(p, "brand", "p_partkey", old)


@register("o186_first_xref", "SELECT c_custkey AS k, 'n' || x AS id, CASE WHEN c_custkey % 3 = 0 THEN 'b' ELSE 'a' END AS via FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN (c_custkey + 1) % 25 ELSE c_nationkey END AS x FROM customer)")
def o186(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey").cast("string")).alias("a"), ((F.col("c_custkey") + 1) % 25).cast("string").alias("b"))
    t = table(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("ref"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"))
    return A.first_xref(c, "k", ["a", "b"], t, "ref")


@register("o187_coverage_change", """
SELECT CASE WHEN c_custkey % 4 = 0 THEN 'absent' WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE 'known' END AS was, CASE WHEN c_custkey % 5 = 0 THEN 'absent' ELSE 'known' END AS now, count(*) AS n FROM customer WHERE NOT (c_custkey % 4 = 0 AND c_custkey % 5 = 0) GROUP BY ALL""")
def o187(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_mktsegment")
    return A.coverage_change(c.where("c_custkey % 4 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))), c.where("c_custkey % 5 <> 0"), "c_custkey", "c_mktsegment")


@register("o193_inventory_receipt", """
SELECT count(a) AS observed, count(a) FILTER (b IS NOT NULL) AS supported, count(*) FILTER (a IS NULL) AS orphans, count(*) FILTER (b IS NULL) AS gaps FROM (SELECT e.k AS a, v.k AS b FROM (SELECT DISTINCT x_id || y_id AS k FROM edges WHERE relation = 'supplier_supplies_part' AND credibility >= 2) e FULL JOIN (SELECT DISTINCT x_id || y_id AS k FROM evidence WHERE source <> 'A') v ON v.k = e.k)""", view=True)
def o193(s, d):
    return A.receipt(supply(s, d).where("credibility >= 2"), evidence(s, d).where("source <> 'A'"), ["x_id", "y_id"]).drop("observed_hash")
