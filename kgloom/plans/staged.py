"""Queries: sinks, exports, text readers, incremental append and jobs over staged sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..jobs import staged as J
from ..operators.cuts import scratch
from ..operators.features import bit_faults, sequence_faults, text_faults
from ..operators.intervals import interval_faults
from ..sources import readers, sinks
from ..streaming import append
from .core import FIRST_SEEN, assertions
from .view import edges, evidence, nodes, register, table


@register("o12_feature_sinks", """
SELECT 'sequences' AS "table", CASE WHEN f = '' THEN 'accepted' ELSE 'rejected' END AS part, f AS fault, count(*) AS n_rows FROM (
  SELECT CASE WHEN length(text) = 0 THEN 'empty' WHEN NOT regexp_matches(text, '^[\\x00-\\x7F]+$') THEN 'bad_alphabet' WHEN length(text) > 3000 THEN 'too_long' ELSE '' END AS f FROM documents) GROUP BY ALL
UNION ALL SELECT 'intervals', CASE WHEN f = '' THEN 'accepted' ELSE 'rejected' END, f, count(*) FROM (
  SELECT CASE WHEN l_linenumber - 1 < 1 THEN 'start_below_one' WHEN l_quantity - 10 < l_linenumber - 1 THEN 'end_before_start' WHEN l_returnflag = 'N' THEN 'bad_strand' ELSE '' END AS f FROM lineitem) GROUP BY ALL
UNION ALL SELECT 'fingerprints', CASE WHEN f = '' THEN 'accepted' ELSE 'rejected' END, f, count(*) FROM (
  SELECT CASE WHEN len(list_filter(embedding, lambda x: x > 0)) = 0 THEN 'all_zero' ELSE '' END AS f FROM embeddings) GROUP BY ALL""")
def o12(s, d):
    out = scratch(s, "features")
    strand = F.when(F.col("l_returnflag") == "N", "x").otherwise("+")
    bits = F.filter(F.transform("embedding", lambda x, i: F.when(x > 0, i)), lambda b: b.isNotNull())
    parts = {
        "sequences": sinks.validated(table(s, d, "documents").select("doc_id", "text"), sequence_faults(F.col("text"), r"^[\x00-\x7F]+$", 3000), f"{out}/sequences"),
        "intervals": sinks.validated(table(s, d, "lineitem"), interval_faults(F.col("l_linenumber") - 1, F.col("l_quantity") - 10, strand), f"{out}/intervals"),
        "fingerprints": sinks.validated(table(s, d, "embeddings").select("vec_id", bits.alias("bits")), bit_faults(F.col("bits"), 64), f"{out}/fingerprints"),
    }
    done = None
    for name, df in parts.items():
        row = df.select(F.lit(name).alias("table"), "part", "fault", "n_rows")
        done = row if done is None else done.unionAll(row)
    return done


@register("o12_summary_sink", """
SELECT CASE WHEN f = '' THEN 'accepted' ELSE 'rejected' END AS part, count(*) AS n_rows FROM (SELECT CASE WHEN trim(text) = '' OR length(text) > 2000 THEN 'bad' ELSE '' END AS f FROM documents WHERE text IS NOT NULL) GROUP BY ALL""")
def o12_summaries(s, d):
    t = table(s, d, "documents").where("text is not null").select("doc_id", "text")
    return sinks.validated(t, text_faults(F.col("text"), 2000), scratch(s, "summaries")).groupBy("part").agg(F.sum("n_rows").alias("n_rows"))


_cell = lambda c: f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
_digest = lambda cols, t: "(SELECT " + " || ':' || ".join(f"coalesce(CAST(sum(CAST('0x' || substr(k, {at}, {n}) AS HUGEINT)) AS VARCHAR), '0')" for at, n in ((1, 11), (12, 11), (23, 10))) + f" FROM (SELECT md5({' || '.join(map(_cell, cols.split()))}) AS k FROM {t}))"


@register("o13_export", f"""
, n AS (SELECT 'nodes' AS layer, 'nodes' AS name, count(*) AS n_rows, 5 AS n_columns, {_digest("id node_type name xref taxon", "nodes")} AS content_digest FROM nodes UNION ALL SELECT 'edges', 'edges', count(*), 8, {_digest("x_id x_type y_id y_type relation display_relation source credibility", "edges")} FROM edges
  UNION ALL SELECT 'edges', 'evidence', count(*), 15, {_digest("edge_key relation x_id x_type y_id y_type evidence_type source source_dataset source_record_id paper_id evidence_score direction l_orderkey l_linenumber", "evidence")} FROM evidence)
SELECT layer, name, n_rows, n_columns, content_digest, CAST(sum(n_rows) OVER (PARTITION BY layer) AS BIGINT) AS total_rows, 'v1' AS version FROM n""", view=True)
def o13(s, d):
    layers = {"nodes": {"nodes": nodes(s, d)}, "edges": {"edges": edges(s, d), "evidence": evidence(s, d)}}
    return sinks.export(layers, scratch(s, "export"), "v1").select("layer", "name", "n_rows", "n_columns", "content_digest", "total_rows", "version")


@register("o17_text_readers", """
SELECT 'delimited' AS reader, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS value FROM orders
UNION ALL SELECT 'stanzas', 'N:' || n_nationkey, n_name || '/R:' || n_regionkey FROM nation
UNION ALL SELECT 'attributes', 'G' || p_partkey, p_name FROM part
UNION ALL SELECT 'fasta', 'S' || s_suppkey, s_name || '/' || upper(s_name) FROM supplier""")
def o17(s, d):
    out = scratch(s, "texts")
    table(s, d, "orders").select("o_orderkey", "o_orderpriority").write.csv(f"{out}/tsv", sep="\t", header=True)
    n = table(s, d, "nation")
    cast = lambda c: F.col(c).cast("string")
    n.select(F.concat(F.lit("[Term]\nid: N:"), cast("n_nationkey"), F.lit("\nname: "), "n_name", F.lit("\nis_a: R:"), cast("n_regionkey"), F.lit("\n")).alias("value")).write.text(f"{out}/stanzas")
    table(s, d, "part").select(F.concat(F.lit('gene_id "G'), cast("p_partkey"), F.lit('"; gene_name "'), "p_name", F.lit('";')).alias("value")).write.text(f"{out}/attributes")
    table(s, d, "supplier").select(F.concat(F.lit(">S"), cast("s_suppkey"), F.lit(" "), "s_name", F.lit("\n"), F.upper("s_name")).alias("value")).write.text(f"{out}/fasta")
    rows = readers.delimited(s, f"{out}/tsv", "id string, value string").select(F.lit("delimited").alias("reader"), "id", "value")
    rows = rows.unionAll(readers.stanzas(s, f"{out}/stanzas").select(F.lit("stanzas"), "id", F.concat(F.col("fields")["name"][0], F.lit("/"), F.col("fields")["is_a"][0])))
    rows = rows.unionAll(readers.attributes(s.read.text(f"{out}/attributes"), "value").select(F.lit("attributes"), F.col("attrs")["gene_id"], F.col("attrs")["gene_name"]))
    return rows.unionAll(readers.fasta(s, f"{out}/fasta").select(F.lit("fasta"), "id", F.concat("description", F.lit("/"), "sequence")))


def supply_store(s, d, **options):
    """A store of supply edges, appended in three batches in line order."""
    out, rows = scratch(s, "append"), assertions(s, d)
    most = rows.agg(F.max("seq")).first()[0] or 0
    for k in range(3):
        rows.where((F.col("seq") > most * k // 3) & (F.col("seq") <= most * (k + 1) // 3)).coalesce(1).write.mode("append").parquet(f"{out}/in")
    append.append_edges(s, f"{out}/in", s.read.parquet(f"{out}/in").schema, f"{out}/store", f"{out}/log", **options)
    return f"{out}/store"


@register("o19_incremental_append", FIRST_SEEN)
def o19(s, d):
    return append.latest(s, supply_store(s, d)).drop("seq")


@register("o19_compacted_store", FIRST_SEEN)
def o19_compacted(s, d):
    """The same edges, from a store that has outgrown its four buckets."""
    return append.latest(s, supply_store(s, d, buckets=4, rows_per_bucket=500)).drop("seq")


@register("o53_anchor_from_store", f"SELECT * FROM ({FIRST_SEEN}) WHERE x_id = 'supplier:3'")
def o53_store(s, d):
    return append.edges_of(s, supply_store(s, d), "supplier_supplies_part", "supplier:3").drop("seq")


@register("o05_partitioned_shard", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey IN (1, 2, 3) AND l_quantity >= 45")
def o05_partitioned(s, d):
    """From a table partitioned by the flag and sorted by supplier: one partition's files are read, in them some row groups."""
    out = scratch(s, "shards")
    table(s, d, "lineitem").repartition("l_returnflag").sortWithinPartitions("l_returnflag", "l_suppkey").write.partitionBy("l_returnflag").parquet(out)
    return s.read.parquet(out).where("l_returnflag = 'R' and l_suppkey in (1, 2, 3) and l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_extendedprice")


@register("o192_layer_keys", """
SELECT 'nodes' AS name, 'id' AS keys, count(*) AS n_rows, count(DISTINCT id) AS n_keys FROM nodes
UNION ALL SELECT 'edges', 'relation,x_id,y_id', count(*), count(DISTINCT (relation, x_id, y_id)) FROM edges
UNION ALL SELECT 'evidence', 'edge_key', count(*), count(DISTINCT edge_key) FROM evidence""", view=True)
def o192(s, d):
    done = None
    for name, df in (("nodes", nodes(s, d)), ("edges", edges(s, d)), ("evidence", evidence(s, d))):
        keys = readers.key_columns(df)
        row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("k")).agg(F.sum("k").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")).select(F.lit(name).alias("name"), F.lit(",".join(keys)).alias("keys"), "n_rows", "n_keys")
        done = row if done is None else done.unionAll(row)
    return done


@register("o164_variant_nodes", """
WITH v AS (SELECT 'rs' || (l_orderkey * 10 + l_linenumber) AS id, l_suppkey % 40 AS chrom, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS pos, l_discount FROM lineitem),
l AS (SELECT o_custkey % 40 AS chrom, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS s, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) + o_orderkey % 3 AS e FROM orders),
n AS (SELECT id, count(*) AS n FROM v JOIN l ON v.chrom = l.chrom AND pos BETWEEN s AND e GROUP BY id)
SELECT id, coalesce(n, 0) AS n_loci, backed FROM (SELECT id, bool_or(l_discount < 0.02) AS backed FROM v GROUP BY id) LEFT JOIN n USING (id) WHERE coalesce(n, 0) > 0 OR backed""")
def o164(s, d):
    day = lambda c: F.datediff(F.col(c), F.lit("1992-01-01")).cast("long")
    v = table(s, d, "lineitem").select(F.concat(F.lit("rs"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("id"), (F.col("l_suppkey") % 40).alias("chrom"), day("l_shipdate").alias("pos"), "l_discount")
    loci = table(s, d, "orders").select((F.col("o_custkey") % 40).alias("chrom"), day("o_orderdate").alias("s"), (day("o_orderdate") + F.col("o_orderkey") % 3).alias("e"))
    return J.variant_nodes(v, v.where("l_discount < 0.02"), loci)


SITES = """
WITH f AS (SELECT doc_id, text, k, CAST(doc_id * k % 50 AS INTEGER) AS pos FROM documents, (VALUES (1), (7), (13)) v(k)),
s AS (SELECT DISTINCT doc_id || ':m:' || substring(text, pos, 1) || pos AS site_id, doc_id, pos, substring(text, pos, 1) AS residue, substring(text, greatest(1, pos - 5), pos + 5 - greatest(1, pos - 5) + 1) AS context FROM f WHERE pos BETWEEN 1 AND length(text)),
e AS (SELECT DISTINCT doc_id || ':m:' || substring(text, pos, 1) || pos AS site_id, unnest(CASE WHEN k = 1 THEN ['database', 'PMID:' || doc_id] ELSE ['database'] END) AS reference FROM f WHERE pos BETWEEN 1 AND length(text))
SELECT site_id, pos AS position, residue, context, count(*) AS n_evidence FROM s JOIN e USING (site_id) GROUP BY ALL"""


@register("o170_site_nodes", SITES)
def o170(s, d):
    feature = lambda k: F.struct(F.lit("m").alias("kind"), (F.col("doc_id") * k % 50).cast("int").alias("position"), (F.array(F.concat(F.lit("PMID:"), F.col("doc_id").cast("string")), F.lit("")) if k == 1 else F.array().cast("array<string>")).alias("papers"))
    e = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("sequence"), F.array(*(feature(k) for k in (1, 7, 13))).alias("features"))
    sites, found = J.site_nodes(e, 5)
    return sites.join(found.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_evidence")), "site_id").select("site_id", "position", "residue", "context", "n_evidence")


@register("o171_resolved_targets", """
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey % 97 AS code, l_suppkey AS symbol FROM lineitem),
c AS (SELECT p_partkey % 150 AS code, 'part:' || p_partkey AS target FROM part), c1 AS (SELECT code, min(target) AS target FROM c GROUP BY code HAVING count(DISTINCT target) = 1),
y AS (SELECT s_suppkey AS symbol, 'supplier:' || (s_suppkey + CASE WHEN s_suppkey % 3 = 0 THEN 1000000 ELSE 0 END) AS target FROM supplier WHERE s_suppkey % 5 <> 0),
j AS (SELECT r.id, coalesce(c1.target, y.target) AS target FROM r LEFT JOIN c1 USING (code) LEFT JOIN y USING (symbol))
SELECT id, CASE WHEN target LIKE 'part:%' OR split_part(target, ':', 2)::BIGINT < 1000000 THEN target END AS target, CASE WHEN target IS NULL THEN 'unmapped' WHEN target LIKE 'part:%' OR split_part(target, ':', 2)::BIGINT < 1000000 THEN 'accepted' ELSE 'missing_endpoint' END AS status FROM j""")
def o171(s, d):
    name = lambda kind, c: F.concat(F.lit(f"{kind}:"), c.cast("string"))
    rows = table(s, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_partkey") % 97).alias("code"), F.col("l_suppkey").alias("symbol"))
    code = table(s, d, "part").select((F.col("p_partkey") % 150).alias("code"), name("part", F.col("p_partkey")).alias("target"))
    moved = F.col("s_suppkey") + F.when(F.col("s_suppkey") % 3 == 0, 1_000_000).otherwise(0)
    symbol = table(s, d, "supplier").where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("symbol"), name("supplier", moved).alias("target"))
    return J.resolved_targets(rows, code, symbol, nodes(s, d))


@register("o183_vendor_ids", """
WITH v AS (SELECT DISTINCT c_custkey AS id, 'c_mktsegment' AS vendor, c_mktsegment AS vendor_id FROM customer UNION SELECT c_custkey, 'alias', c_name || c_custkey % 7 FROM customer)
SELECT vendor, vendor_id, min(id) AS id FROM v GROUP BY vendor, vendor_id HAVING count(*) = 1""")
def o183(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment", F.concat("c_name", (F.col("c_custkey") % 7).cast("string")).alias("alias"))
    return J.vendor_ids(c, ["c_mktsegment", "alias"])


@register("o185_text_summaries", "SELECT 'nation:' || n_nationkey AS id, left(n_name || '. region ' || n_regionkey, 20) AS summary FROM nation WHERE n_nationkey % 2 = 0")
def o185(s, d):
    out = scratch(s, "stanzas")
    key = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey")).otherwise(F.col("n_nationkey") + 1000).cast("string")
    table(s, d, "nation").select(F.concat(F.lit("[Term]\nid: nation:"), key, F.lit("\nname: "), "n_name", F.lit("\ndef: region "), F.col("n_regionkey").cast("string"), F.lit("\n")).alias("value")).write.text(out)
    return J.summaries(readers.stanzas(s, out), nodes(s, d), ["name", "def"], 20)


@register("o188_trial_texts", """
WITH r AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents), k AS (SELECT doc_id FROM r WHERE t <> ''), l AS (SELECT DISTINCT doc_id FROM labels)
SELECT 'rows' AS "check", count(*) AS n FROM k UNION ALL SELECT 'repeated_keys', count(*) FROM (SELECT doc_id FROM k GROUP BY doc_id HAVING count(*) > 1)
UNION ALL SELECT 'orphan_features', count(*) FROM k WHERE doc_id NOT IN (SELECT doc_id FROM l) UNION ALL SELECT 'edges_without_feature', count(*) FROM l WHERE doc_id NOT IN (SELECT doc_id FROM k)""")
def o188(s, d):
    return J.trial_texts(table(s, d, "documents"), table(s, d, "labels"), "doc_id", "text")[1]


@register("o188_trial_text_rows", """
SELECT doc_id, sha256(t) AS content_sha256 FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents) WHERE t <> ''""")
def o188_rows(s, d):
    return J.trial_texts(table(s, d, "documents"), table(s, d, "labels"), "doc_id", "text")[0].select("doc_id", "content_sha256")
