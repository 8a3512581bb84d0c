"""Queries: source jobs, run over records derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..jobs import nested, tabular
from .view import register, table


def text(p, c):
    return F.concat(F.lit(p), c.cast("string"))


def order_records(s, d):
    """Orders as nested targets: lines as transcripts with a part as protein, suppliers as accessions."""
    line = table(s, d, "lineitem")
    return line.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.collect_list(F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), text("part:", F.col("l_partkey")).alias("protein"))).alias("transcripts"),
        F.collect_list(F.struct(F.when(F.col("l_returnflag") == "R", "uniprot_swissprot").otherwise("uniprot_trembl").alias("source"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("id"))).alias("proteinIds"),
    )


@register("o156_central_dogma", """
SELECT 'gene_has_transcript' AS part, count(*) AS n, CAST(NULL AS BIGINT) AS check_sum FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) UNION ALL SELECT 'transcript_encodes_protein', count(*), NULL FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)
UNION ALL SELECT 'accessions', count(*), CAST(sum(CAST(s AS BIGINT)) AS BIGINT) FROM (SELECT l_orderkey, min_by(lpad(CAST(l_suppkey AS VARCHAR), 6, '0'), CASE WHEN l_returnflag = 'R' THEN '0' ELSE '1' END || lpad(CAST(l_suppkey AS VARCHAR), 6, '0')) AS s FROM lineitem GROUP BY l_orderkey)""")
def o156(s, d):
    t = nested.dogma(order_records(s, d))
    n = lambda k: t[k].agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("part"), "n", F.lit(None).cast("long").alias("check_sum"))
    a = t["accessions"].agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("uniprot_id").cast("long")).alias("check_sum")).select(F.lit("accessions").alias("part"), "n", "check_sum")
    return n("gene_has_transcript").unionAll(n("transcript_encodes_protein")).unionAll(a)


HOMOLOGY = "(SELECT user_id AS gene, event_id % 60 AS target, CASE WHEN event_type = 'purchase' THEN 'within_species_paralog' ELSE 'ortholog_one2one' END AS ht, event_id % 4 AS species, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS confidence FROM events)"
REASON = "CASE WHEN gene = target THEN 'self_pair' WHEN species = 3 THEN 'other_species' WHEN confidence < 20 THEN 'low_confidence' WHEN target >= 50 THEN 'unknown_target' END"


@register("o157_orthology", f"""
SELECT 'edge' AS part, relation AS name, count(*) AS n FROM (SELECT DISTINCT CASE WHEN ht LIKE '%paralog%' THEN least(gene, target) ELSE gene END AS x, CASE WHEN ht LIKE '%paralog%' THEN greatest(gene, target) ELSE target END AS y, CASE WHEN ht LIKE '%paralog%' THEN 'gene_paralog_of_gene' ELSE 'gene_ortholog_of_gene' END AS relation FROM {HOMOLOGY} WHERE {REASON} IS NULL) GROUP BY relation
UNION ALL SELECT 'reject', {REASON}, count(*) FROM {HOMOLOGY} WHERE {REASON} IS NOT NULL GROUP BY 2""")
def o157(s, d):
    e = table(s, d, "events")
    rows = e.select(F.col("user_id").alias("gene"), (F.col("event_id") % 60).alias("target"), F.when(F.col("event_type") == "purchase", "within_species_paralog").otherwise("ortholog_one2one").alias("homology_type"), (F.col("event_id") % 4).cast("string").alias("species"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("confidence"))
    out, bad = nested.orthology(rows, s.range(50), ["0", "1", "2"], 20)
    a = out.groupBy(F.col("relation").alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("edge").alias("part"), "name", "n")
    return a.unionAll(bad.select(F.lit("reject"), F.col("reason"), "n"))


@register("o159_undirected_interactions", """
SELECT least(a, b) AS x_id, greatest(a, b) AS y_id, max(v) AS score, count(*) AS n, CAST(CASE WHEN max(v) <= 30 THEN 1 WHEN max(v) <= 90 THEN 2 ELSE 3 END AS BIGINT) AS credibility FROM (SELECT user_id AS a, event_id % 80 AS b, value AS v FROM events) WHERE a <> b GROUP BY 1, 2""")
def o159(s, d):
    rows = table(s, d, "events").select(F.col("user_id").alias("a"), (F.col("event_id") % 80).alias("b"), F.col("value").alias("score"))
    return nested.interactions(rows, [(30, 1), (90, 2)])


@register("o160_evidence_fan_out", "SELECT CASE event_type WHEN 'click' THEN 'r1' WHEN 'view' THEN 'r1' WHEN 'purchase' THEN 'r2' ELSE 'unrouted' END AS relation, count(*) AS n, max(value) AS best FROM events GROUP BY 1")
def o160(s, d):
    rows = table(s, d, "events").withColumnRenamed("event_type", "datatype")
    return nested.evidence_fan_out(rows, {"r1": ["click", "view"], "r2": ["purchase"]}).groupBy("relation").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("best"))


@register("o162_triple_nested_explode", "SELECT DISTINCT o_custkey AS gene, l_suppkey AS tissue, l_orderkey AS cell_line, l_discount AS effect FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity > 25")
def o162(s, d):
    line = table(s, d, "lineitem").join(table(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    screens = line.groupBy("o_custkey", "l_suppkey").agg(F.collect_list(F.struct(F.col("l_orderkey").alias("cellLineName"), F.when(F.col("l_quantity") > 25, F.col("l_discount")).alias("geneEffect"))).alias("screens"))
    maps = screens.groupBy(F.col("o_custkey").alias("id")).agg(F.array(F.struct(F.collect_list(F.struct(F.col("l_suppkey").alias("tissueName"), "screens")).alias("depMapEssentiality"))).alias("geneEssentiality"))
    return nested.essentiality(maps)


@register("o163_expression", "SELECT l_partkey AS gene, l_suppkey AS tissue, l_extendedprice AS value FROM lineitem WHERE l_extendedprice >= 60000")
def o163(s, d):
    t = table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.collect_list(F.struct(F.col("l_suppkey").alias("efo_code"), F.struct(F.col("l_extendedprice").alias("value")).alias("rna"))).alias("tissues"))
    return nested.expression(t, 60000)


@register("o163_phenotypes", """
SELECT 'EFO:' || l_partkey AS x_id, 'HP:' || l_suppkey AS y_id, CAST(CASE WHEN count(*) FILTER (l_returnflag = 'A') > 0 THEN 3 WHEN count(*) FILTER (l_returnflag = 'N') > 0 THEN 1 ELSE 2 END AS BIGINT) AS credibility FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) FILTER (l_quantity > 45) = 0""")
def o163b(s, d):
    kind = F.when(F.col("l_returnflag") == "A", "TAS").when(F.col("l_returnflag") == "N", "IEA").otherwise("ND")
    r = table(s, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.collect_list(F.struct((F.col("l_quantity") > 45).alias("qualifierNot"), kind.alias("evidenceType"))).alias("evidence"))
    return nested.phenotypes(r.select(text("EFO_", F.col("l_partkey")).alias("disease"), text("HP_", F.col("l_suppkey")).alias("phenotype"), "evidence"))


@register("o166_interaction_table", """
WITH m AS (SELECT acc, CASE WHEN count(DISTINCT p) = 1 THEN min(p) END AS p FROM (SELECT 'A' || (p_partkey % 900) AS acc, p_partkey AS p FROM part) GROUP BY acc),
r AS (SELECT l_orderkey, l_linenumber, x.p AS pa, y.p AS pb, CASE WHEN l_linenumber = 7 THEN 'negative_evidence' WHEN l_returnflag = 'R' THEN 'non_human_or_cross_species' WHEN l_linestatus = 'F' THEN 'interaction_type_association_too_broad'
  WHEN x.p IS NULL OR y.p IS NULL THEN 'protein_node_unmapped' WHEN x.p = y.p AND l_quantity <= 25 THEN 'self_loop_requires_homodimer_support' END AS reason
  FROM lineitem LEFT JOIN m x ON x.acc = 'A' || (l_partkey % 1000) LEFT JOIN m y ON y.acc = 'A' || (l_suppkey % 1000))
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n, CAST(sum(CASE WHEN reason IS NULL THEN least(pa, pb) END) AS BIGINT) AS check_x FROM r GROUP BY 1""")
def o166(s, d):
    acc = table(s, d, "part").select(text("A", F.col("p_partkey") % 900).alias("accession"), F.col("p_partkey").alias("protein"))
    ln = table(s, d, "lineitem")
    rows = ln.select(
        F.concat(text("uniprotkb:A", F.col("l_partkey") % 1000), F.lit("(x)")).alias("a"), text("uniprotkb:A", F.col("l_suppkey") % 1000).alias("b"), F.lit("taxid:9606(human)").alias("taxid_a"),
        F.when(F.col("l_returnflag") == "R", "taxid:10090(mouse)").otherwise("taxid:9606(human)").alias("taxid_b"), F.when(F.col("l_linestatus") == "F", 'psi-mi:"MI:0914"(association)').otherwise('psi-mi:"MI:0407"(direct interaction)').alias("type"),
        (F.col("l_linenumber") == 7).cast("string").alias("negative"), F.when(F.col("l_quantity") > 25, "homodimer").alias("features"),
    )
    out = tabular.mitab(rows, acc, ["MI:0407"])
    return out.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("reason").isNull(), F.col("x_id"))).alias("check_x"))


@register("o167_complexes", """
WITH m AS (SELECT acc, CASE WHEN count(DISTINCT p) = 1 THEN min(p) END AS p, count(DISTINCT p) AS k FROM (SELECT 'A' || (p_partkey % 1500) AS acc, p_partkey AS p FROM part) GROUP BY acc),
t AS (SELECT 'C' || l_orderkey AS c, 'A' || l_partkey AS part FROM lineitem UNION ALL SELECT 'C' || o_orderkey, 'C' || (o_orderkey % 50) FROM orders),
j AS (SELECT t.*, m.p, m.k, k.c IS NOT NULL AS is_complex FROM t LEFT JOIN m ON m.acc = t.part LEFT JOIN (SELECT DISTINCT 'C' || l_orderkey AS c FROM lineitem) k ON k.c = t.part WHERE t.c IN (SELECT 'C' || l_orderkey FROM lineitem)),
r AS (SELECT *, CASE WHEN part = c THEN 'self_reference' WHEN k > 1 AND NOT is_complex THEN 'ambiguous_accession' WHEN p IS NULL AND NOT is_complex THEN 'unmapped' END AS reason FROM j)
SELECT coalesce(reason, CASE WHEN is_complex THEN 'complex_part_of_complex' ELSE 'complex_contains_protein' END) AS name, count(*) AS n FROM r GROUP BY 1""")
def o167(s, d):
    ln = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.concat(text("A", F.col("l_partkey")), F.lit("("), F.col("l_linenumber").cast("string"), F.lit(")"))).alias("p"))
    rows = ln.select(text("C", F.col("l_orderkey")).alias("complex_ac"), F.array_join(F.concat("p", F.array(F.concat(text("C", F.col("l_orderkey") % 50), F.lit("(0)")))), "|").alias("participants"), F.lit(1).alias("seq"))
    old = rows.withColumn("participants", F.lit("A1(1)|A2(1)")).withColumn("seq", F.lit(0))
    acc = table(s, d, "part").select(text("A", F.col("p_partkey") % 1500).alias("accession"), F.col("p_partkey").cast("string").alias("protein"))
    out, bad = tabular.complexes(rows.unionAll(old), acc)
    return out.groupBy(F.col("relation").alias("name")).agg(F.count(F.lit(1)).alias("n")).unionAll(bad.select("reason", "n"))


@register("o168_pathway_members", """
WITH m AS (SELECT acc, count(DISTINCT p) AS k FROM (SELECT 'A' || (p_partkey % 1200) AS acc, p_partkey AS p FROM part) GROUP BY acc)
SELECT coalesce(CASE WHEN k > 1 THEN 'ambiguous_accession' WHEN k IS NULL THEN 'unmapped_accession' WHEN l_suppkey % 9 = 0 THEN 'missing_pathway' END, 'accepted') AS reason, count(*) AS n FROM lineitem LEFT JOIN m ON acc = 'A' || (l_partkey % 1300) GROUP BY 1""")
def o168(s, d):
    acc = table(s, d, "part").select(text("A", F.col("p_partkey") % 1200).alias("accession"), F.col("p_partkey").alias("protein"))
    rows = table(s, d, "lineitem").select(text("A", F.col("l_partkey") % 1300).alias("accession"), F.col("l_suppkey").alias("pathway"))
    paths = table(s, d, "supplier").where("s_suppkey % 9 <> 0").select(F.col("s_suppkey").alias("id"))
    return tabular.pathway_members(rows, acc, paths).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@register("o169_localisations", """
WITH r AS (SELECT l_partkey % 500 AS acc, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS level, unnest(['mode ' || l_linestatus, 'site ' || (l_suppkey % 4)]) AS label FROM lineitem),
c AS (SELECT acc, level, CASE WHEN label = 'mode O' THEN 'GO:1' WHEN label = 'site 1' THEN 'SL:1' WHEN label = 'site 2' THEN 'SL:2' ELSE 'local:' || replace(lower(label), ' ', '_') END AS component FROM r)
SELECT p_partkey AS protein, component, CAST(max(level) AS BIGINT) AS credibility FROM c JOIN part ON p_partkey % 500 = acc GROUP BY 1, 2""")
def o169(s, d):
    ln = table(s, d, "lineitem")
    word = F.when(F.col("l_returnflag") == "R", "Uncertain").when(F.col("l_returnflag") == "A", "Approved").otherwise("Enhanced")
    rows = ln.select((F.col("l_partkey") % 500).alias("accession"), word.alias("reliability"), F.concat(F.lit("Mode "), "l_linestatus", F.lit("; site "), (F.col("l_suppkey") % 4).cast("string")).alias("labels"))
    first = s.range(1).select(F.inline(F.array(F.struct(F.lit("mode O").alias("label"), F.lit("GO:1").alias("component")))))
    second = s.range(1).select(F.inline(F.array(*(F.struct(F.lit(a).alias("label"), F.lit(b).alias("component")) for a, b in (("site 1", "SL:1"), ("Site 2", "SL:2"), ("mode o", "SL:9"))))))
    return tabular.localisations(rows, table(s, d, "part").select((F.col("p_partkey") % 500).alias("accession"), F.col("p_partkey").alias("protein")), first, second)


@register("o172_condition_candidates", """
SELECT reasons, count(*) AS n, CAST(sum(k) AS BIGINT) AS cells FROM (SELECT count(*) AS k, concat_ws(';', CASE WHEN count(*) < 5 THEN 'few_cells' END, CASE WHEN a IS NULL THEN 'missing_a' END) AS reasons FROM (SELECT nullif(event_type, 'error') AS a, user_id AS b FROM events) GROUP BY a, b) GROUP BY reasons""")
def o172(s, d):
    cells = table(s, d, "events").select(F.nullif("event_type", F.lit("error")).alias("a"), F.col("user_id").alias("b"))
    return tabular.condition_candidates(cells, ["a", "b"], 5).groupBy("reasons").agg(F.count(F.lit(1)).alias("n"), F.sum("n_cells").alias("cells"))


@register("o172_wide_cells", "SELECT 'p_name' AS \"column\", count(*) AS filled, count(*) AS n FROM part UNION ALL SELECT 'p_partkey', count(*), count(*) FROM part UNION ALL SELECT 'p_brand', count(*), count(*) FROM part UNION ALL SELECT 'p_type', count(*), count(*) FROM part UNION ALL SELECT 'p_size', count(*), count(*) FROM part UNION ALL SELECT 'p_retailprice', count(*), count(*) FROM part")
def o172b(s, d):
    return tabular.long_cells(table(s, d, "part").withColumn("key", F.col("p_partkey")), "key", "p_")


@register("o173_paper_provenance", """
WITH w AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'DOI:10.1/x' || o_orderkey WHEN o_orderkey % 3 = 1 THEN 'PMID:' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS paper FROM orders)
SELECT a.paper AS x_id, b.paper AS y_id, CAST(i AS INTEGER) AS pos FROM (SELECT id, paper, unnest([id + 1, id + 7]) AS ref, unnest([0, 1]) AS i FROM w) a JOIN w b ON b.id = a.ref""")
def o173(s, d):
    k = F.col("o_orderkey")
    w = table(s, d, "orders").select(k.cast("string").alias("id"), F.when(k % 3 == 0, text("https://doi.org/10.1/X", k)).alias("doi"), F.when(k % 3 == 1, k.cast("string")).alias("pmid"), F.array((k + 1).cast("string"), (k + 7).cast("string"), (k + 9).cast("string")).alias("references"), F.lit("d").alias("dataset"))
    return tabular.provenance(w, 2)["citations"].select("x_id", "y_id", "pos")


@register("o184_symbol_mapping", """
WITH r AS (SELECT DISTINCT p_partkey AS gene, p_partkey // 2 AS symbol, p_partkey AS transcript, p_size AS precursor FROM part WHERE p_partkey % 3 <> 0)
SELECT DISTINCT gene, precursor, CASE WHEN reasons = '' THEN 'high' ELSE 'ambiguous' END AS confidence, reasons FROM (SELECT gene, precursor, concat_ws(';', CASE WHEN a > 1 THEN 'transcripts_per_gene' END, CASE WHEN b > 1 THEN 'genes_per_symbol' END, CASE WHEN c > 1 THEN 'precursors_per_symbol' END, CASE WHEN e > 1 THEN 'symbols_per_precursor' END) AS reasons
  FROM (SELECT gene, precursor, (SELECT count(DISTINCT transcript) FROM r z WHERE z.gene = r.gene) AS a, (SELECT count(DISTINCT gene) FROM r z WHERE z.symbol = r.symbol) AS b, (SELECT count(DISTINCT precursor) FROM r z WHERE z.symbol = r.symbol) AS c, (SELECT count(DISTINCT symbol) FROM r z WHERE z.precursor = r.precursor) AS e FROM r))""")
def o184(s, d):
    rows = table(s, d, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("gene"), F.floor(F.col("p_partkey") / 2).alias("symbol"), F.col("p_partkey").alias("transcript"), F.col("p_size").alias("precursor"))
    return tabular.symbol_mapping(rows)


@register("o189_source_gate", "SELECT l_returnflag AS source, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1")
def o189(s, d):
    gate = table(s, d, "lineitem").select(F.col("l_returnflag").alias("source"), F.when(F.col("l_returnflag") == "R", "rejected").otherwise("accepted").alias("status")).distinct()
    return tabular.gated(table(s, d, "lineitem").withColumnRenamed("l_returnflag", "source"), gate, ["accepted"]).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("o190_feature_refs", "SELECT o_orderkey, CAST(count(l_orderkey) AS INTEGER) AS n_refs, coalesce(string_agg(l_linenumber, ',' ORDER BY l_linenumber), '') AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 40 GROUP BY o_orderkey")
def o190(s, d):
    refs = table(s, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    out = tabular.with_refs(table(s, d, "orders").select("o_orderkey"), refs, "o_orderkey")
    return out.select("o_orderkey", F.size("refs").alias("n_refs"), F.array_join(F.transform("refs", lambda r: r["l_linenumber"].cast("string")), ",").alias("lines"))
