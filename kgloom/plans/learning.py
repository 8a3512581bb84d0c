"""Queries: splits, negatives, labels and metrics for link prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G, metrics as M, splits as S
from .core import SP, supply
from .view import edges, nodes, register, table

#: An order that SQL can repeat; production uses the seeded hash.
ORDER = ["x_id", "y_id"]
TARGET = "order_contains_part"


def target(s, d):
    return edges(s, d).where(f"relation = '{TARGET}'").select("relation", "x_id", "x_type", "y_id", "y_type")


SPLIT = """
, s AS (SELECT relation, x_id, y_id, row_number() OVER (PARTITION BY relation ORDER BY x_id, y_id) AS r, count(*) OVER (PARTITION BY relation) AS n FROM edges),
t AS (SELECT *, CASE WHEN r <= round(n * 0.05) THEN 'test' WHEN r <= round(n * 0.05) + round((n - round(n * 0.05)) * (0.11875 / 0.95)) THEN 'valid' ELSE 'train' END AS split FROM s)
"""


@register("o139_stratified_split", SPLIT + "SELECT relation, x_id, y_id, split FROM t", view=True)
def o139(s, d):
    return S.stratified(edges(s, d).select("relation", "x_id", "y_id"), 1, 0.05, 0.11875, ORDER)


@register("o139_hashed_split")
def o139b(s, d):
    return S.stratified(edges(s, d).select("relation", "x_id", "y_id"), 1, 0.05, 0.11875).groupBy("relation", "split").agg(F.count(F.lit(1)).alias("n"))


@register("o140_entity_hold_out", """
, h AS (SELECT *, y_id LIKE '%5' AS held FROM edges WHERE relation = 'order_contains_part'), r AS (SELECT *, row_number() OVER (ORDER BY x_id, y_id) AS r, count(*) OVER () AS n FROM h WHERE NOT held)
SELECT split, count(*) AS n FROM (SELECT 'test' AS split FROM h WHERE held UNION ALL SELECT CASE WHEN r <= round(n * 0.05) THEN 'valid' ELSE 'train' END FROM r) GROUP BY split""", view=True)
def o140(s, d):
    held = nodes(s, d).where("node_type = 'part' and id like '%5'").select("id")
    return S.hold_out(target(s, d), held, 1, 0.05, ORDER).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("o141_group_split", """
, e AS (SELECT y_id, row_number() OVER (ORDER BY y_id) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT y_id FROM edges WHERE relation = 'order_contains_part'))
SELECT x_id, y_id, CASE WHEN r <= round(n * 0.2) THEN 'test' WHEN r <= round(n * 0.2) + round(n * 0.1) THEN 'valid' ELSE 'train' END AS split FROM edges JOIN e USING (y_id) WHERE relation = 'order_contains_part'""", view=True)
def o141(s, d):
    return S.by_entity(target(s, d), "y_id", 1, 0.2, 0.1, [F.col("y_id")]).select("x_id", "y_id", "split")


@register("o142_few_neighbours", """
, t AS (SELECT DISTINCT y_id AS id FROM edges WHERE relation = 'order_contains_part'), n AS (SELECT id, count(*) AS n FROM (SELECT x_id AS id FROM edges WHERE relation <> 'order_contains_part' UNION ALL SELECT y_id FROM edges WHERE relation <> 'order_contains_part') GROUP BY id)
SELECT t.id, coalesce(n.n, 0) AS n FROM t LEFT JOIN n ON n.id = t.id WHERE coalesce(n.n, 0) <= 20""", view=True)
def o142(s, d):
    return S.few_neighbours(edges(s, d), [TARGET], 20)


@register("o143_few_targets", "SELECT y_id AS id, count(*) AS n FROM edges WHERE relation = 'order_contains_part' GROUP BY y_id HAVING count(*) <= 20", view=True)
def o143(s, d):
    return S.few_targets(edges(s, d), [TARGET], 20)


@register("o144_cross_validation_folds", """
, e AS (SELECT y_id, CAST(ntile(20) OVER (ORDER BY y_id) AS INTEGER) AS fold FROM (SELECT DISTINCT y_id FROM edges WHERE relation = 'order_contains_part')) SELECT fold, count(*) AS n, count(DISTINCT y_id) AS entities FROM edges JOIN e USING (y_id) WHERE relation = 'order_contains_part' GROUP BY fold""", view=True)
def o144(s, d):
    return S.folds(target(s, d), "y_id", 20, 1, [F.col("y_id")]).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("y_id").alias("entities"))


@register("o145_full_graph_split", SPLIT.replace("0.05)", "0.0)").replace("0.11875 / 0.95", "0.05") + "SELECT relation, CASE split WHEN 'valid' THEN 'valid' ELSE split END AS split, count(*) AS n FROM t GROUP BY ALL", view=True)
def o145(s, d):
    return S.stratified(edges(s, d).select("relation", "x_id", "y_id"), 1, 0.0, 0.05, ORDER).groupBy("relation", "split").agg(F.count(F.lit(1)).alias("n"))


@register("o146_area_filter", "SELECT x_id, y_id FROM edges WHERE relation = 'order_contains_part' AND CAST(split_part(y_id, ':', 2) AS INTEGER) % 10 IN (3, 4)", view=True)
def o146(s, d):
    merged = F.concat_ws("_", F.split("y_id", ":")[1], (F.split("y_id", ":")[1].cast("int") + 1).cast("string"))
    t = target(s, d).withColumn("merged", merged)
    area = table(s, d, "part").where("p_partkey % 10 = 4").select(F.col("p_partkey").cast("string").alias("part"))
    ids = t.select("x_id", "y_id", F.explode(F.split("merged", "_")).alias("part"))
    return ids.join(area, "part", "left_semi").select("x_id", "y_id").distinct()


def negative_sql(side, own, total, value):
    """Draws of negatives by the hash of the positive, among all but itself."""
    return f"""
, i AS (SELECT node_type, id, row_number() OVER (PARTITION BY node_type ORDER BY id) - 1 AS "index", count(*) OVER (PARTITION BY node_type) AS m FROM nodes),
p AS (SELECT e.x_id, e.y_id, k, a."index" AS ox, b."index" AS oy, a.m AS mx, b.m AS my, CAST('0x' || substr(md5('3|' || x_id || '|' || y_id || '|' || k), 1, 15) AS BIGINT) AS h FROM edges e JOIN i a ON a.id = x_id JOIN i b ON b.id = y_id, (VALUES (1), (2)) v(k) WHERE relation = 'supplier_supplies_part'),
q AS (SELECT *, h % ({total} - 1) + CASE WHEN h % ({total} - 1) >= {own} THEN 1 ELSE 0 END AS r FROM p)
SELECT {value} FROM q JOIN i x ON x.node_type = 'supplier' JOIN i y ON y.node_type = 'part' WHERE {side}"""


@register("o147_uniform_negatives", negative_sql('x.id = q.x_id AND y."index" = r', "oy", "my", "q.x_id AS x_pos, q.y_id AS y_pos, k, q.x_id, y.id AS y_id"), view=True)
def o147(s, d):
    return S.negatives(supply(s, d), G.dense_index(nodes(s, d)), 3, k=2).select("x_pos", "y_pos", "k", "x_id", "y_id")


@register("o147_negatives_of_sources", negative_sql('y.id = q.y_id AND x."index" = r', "ox", "mx", "q.x_id AS x_pos, q.y_id AS y_pos, k, x.id AS x_id, q.y_id"), view=True)
def o147_sources(s, d):
    return S.negatives(supply(s, d), G.dense_index(nodes(s, d)), 3, k=2, side="x").select("x_pos", "y_pos", "k", "x_id", "y_id")


@register("o147_negatives_of_both_ends", negative_sql('x."index" = r // my AND y."index" = r % my', "(ox * my + oy)", "mx * my", "q.x_id AS x_pos, q.y_id AS y_pos, k, x.id AS x_id, y.id AS y_id"), view=True)
def o147_both(s, d):
    return S.negatives(supply(s, d), G.dense_index(nodes(s, d)), 3, k=2, side="both").select("x_pos", "y_pos", "k", "x_id", "y_id")


@register("o147_weighted_negatives", """
, g AS (SELECT y_id AS id, greatest(1, CAST(round(1000 * pow(count(*), 0.75)) AS BIGINT)) AS w FROM edges WHERE relation = 'supplier_supplies_part' GROUP BY y_id),
c AS (SELECT id, sum(w) OVER (ORDER BY id) - w AS lo, sum(w) OVER (ORDER BY id) AS hi, sum(w) OVER () AS total FROM g),
p AS (SELECT x_id, y_id, CAST('0x' || substr(md5('3|' || x_id || '|' || y_id), 1, 15) AS BIGINT) % (SELECT max(total) FROM c) AS u FROM edges WHERE relation = 'supplier_supplies_part')
SELECT p.x_id, c.id AS y_id, count(*) AS n FROM p JOIN c ON u >= lo AND u < hi GROUP BY ALL""", view=True)
def o147_weighted(s, d):
    deg = supply(s, d).groupBy(F.col("y_id").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    return S.weighted_negatives(supply(s, d), deg, 3).groupBy("x_id", "y_id").agg(F.count(F.lit(1)).alias("n"))


@register("o148_filtered_negatives", """
SELECT x_id AS x_pos, y_id AS y_pos, CAST(2 AS BIGINT) AS found, CAST(0 AS BIGINT) AS existing, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS wrong_type, CAST(0 AS BIGINT) AS unexplained FROM edges WHERE relation = 'order_contains_part'""", view=True)
def o148(s, d):
    """Properties of each positive's two negatives: all there, none exists or comes twice, both ends of the right type."""
    e = edges(s, d).where("relation = 'order_contains_part'")
    n = S.filtered_negatives(e, e, G.dense_index(nodes(s, d)), 3, k=2)
    known = e.select("x_id", "y_id", F.lit(1).alias("seen"))
    many = n.groupBy("x_id", "y_id").agg(F.count(F.lit(1)).alias("times"))
    typed = F.startswith("x_id", F.lit("order:")) & F.startswith("y_id", F.lit("part:"))
    n = n.join(known, ["x_id", "y_id"], "left").join(many, ["x_id", "y_id"], "left")
    return n.groupBy("x_pos", "y_pos").agg(
        F.count("y_id").alias("found"), F.count("seen").alias("existing"), F.count_if(F.col("times") > 1).alias("repeated"), F.count_if(~typed).alias("wrong_type"), F.count_if(F.col("y_id").isNull() & F.col("reason").isNull()).alias("unexplained"))


@register("o149_three_way_split", """
, s AS (SELECT relation, row_number() OVER (PARTITION BY relation ORDER BY x_id, y_id) AS r, greatest(1, least(count(*) OVER (PARTITION BY relation) // 5, 1024)) AS k FROM edges) SELECT relation, CASE WHEN r <= k THEN 'test' WHEN r <= 2 * k THEN 'valid' ELSE 'train' END AS split, count(*) AS n FROM s GROUP BY ALL""", view=True)
def o149(s, d):
    return S.three_way(edges(s, d), 1, 1024, ORDER).groupBy("relation", "split").agg(F.count(F.lit(1)).alias("n"))


@register("o078_split_leaks", """
WITH s AS (SELECT 1 AS relation, l_orderkey % 300 AS x, l_partkey % 300 AS y, l_linenumber AS n FROM lineitem),
p AS (SELECT DISTINCT x, y, CASE WHEN n = 1 THEN 'test' WHEN n = 2 THEN 'valid' ELSE 'train' END AS split FROM s),
h AS (SELECT DISTINCT x, y FROM p WHERE split IN ('test', 'valid'))
SELECT 'train_valid' AS "check", count(*) AS n FROM p a JOIN p b USING (x, y) WHERE a.split = 'train' AND b.split = 'valid' UNION ALL SELECT 'train_test', count(*) FROM p a JOIN p b USING (x, y) WHERE a.split = 'train' AND b.split = 'test'
UNION ALL SELECT 'valid_test', count(*) FROM p a JOIN p b USING (x, y) WHERE a.split = 'valid' AND b.split = 'test' UNION ALL SELECT 'reversed', count(*) FROM p h JOIN p t ON t.split = 'train' AND t.x = h.y AND t.y = h.x WHERE h.split IN ('test', 'valid')""")
def o78(s, d):
    """A split by line number, of pairs that repeat, leaks: the audit counts each kind of leak."""
    n = F.col("l_linenumber")
    pairs = table(s, d, "lineitem").select(F.lit("r").alias("relation"), (F.col("l_orderkey") % 300).alias("x_id"), (F.col("l_partkey") % 300).alias("y_id"), F.when(n == 1, "test").when(n == 2, "valid").otherwise("train").alias("split"))
    return S.leaks(pairs)


@register("o078_clean_split", """
SELECT 'train_valid' AS "check", CAST(0 AS BIGINT) AS n UNION ALL SELECT 'train_test', 0 UNION ALL SELECT 'valid_test', 0 UNION ALL SELECT 'reversed', 0""")
def o78_clean(s, d):
    return S.leaks(S.stratified(edges(s, d).select("relation", "x_id", "y_id"), 1, 0.05, 0.11875))


@register("o150_label_matrix", """
, s AS (SELECT x_id, y_id, row_number() OVER (ORDER BY x_id, y_id) AS r, count(*) OVER () AS n FROM edges WHERE relation = 'supplier_supplies_part')
SELECT y_id, x_id, CASE WHEN r <= round(n * 0.3) THEN 1 ELSE -1 END AS label, (SELECT count(DISTINCT x_id) FROM s) - count(*) OVER (PARTITION BY y_id) AS n_other FROM s""", view=True)
def o150(s, d):
    sp = S.stratified(supply(s, d).select("relation", "x_id", "y_id"), 1, 0.3, 0.1, ORDER)
    return S.label_matrix(sp, sp, sp)


SCORED = "(SELECT l.quality AS label, d.lang, d.doc_id, d.source, (d.n_chars % 97) / 100.0 AS score FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"


def scored(s, d):
    return table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id").select(F.col("quality").alias("label"), "lang", "doc_id", "source", ((F.col("n_chars") % 97) / 100.0).alias("score"))


@register("o151_auroc_and_ap", f"""
WITH r AS (SELECT lang, score, label, false AS micro FROM {SCORED} UNION ALL SELECT 'micro', score, label, true FROM {SCORED}),
g AS (SELECT lang, micro, score, sum(label) AS p, sum(1 - label) AS n FROM r GROUP BY ALL),
c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY lang, micro) AS pp, sum(n) OVER (PARTITION BY lang, micro) AS nn FROM g WINDOW w AS (PARTITION BY lang, micro ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
m AS (SELECT lang, micro, CAST(max(pp) AS BIGINT) AS positives, CAST(max(nn) AS BIGINT) AS negatives, sum(n * (tp - p / 2)) / nullif(max(pp) * max(nn), 0) AS auroc, sum(p * tp / (tp + fp)) / nullif(max(pp), 0) AS ap FROM c GROUP BY ALL)
SELECT lang, positives, negatives, round(auroc, 6) AS auroc, round(ap, 6) AS ap FROM m UNION ALL SELECT 'macro', CAST(sum(positives) AS BIGINT), CAST(sum(negatives) AS BIGINT), round(avg(auroc), 6), round(avg(ap), 6) FROM m WHERE NOT micro""")
def o151(s, d):
    return M.auroc_ap(scored(s, d), "lang")


RANKING = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank, count(*) OVER (PARTITION BY source) AS n FROM {SCORED}),
h AS (SELECT *, sum(label) OVER (PARTITION BY source ORDER BY rank) AS seen FROM r),
cuts AS (SELECT h.*, cut, CAST(CASE WHEN share > 0 THEN floor(n * share) ELSE fixed END AS BIGINT) AS k FROM h, (VALUES ('1%', 0.01::DOUBLE, 0), ('5%', 0.05::DOUBLE, 0), ('10%', 0.1::DOUBLE, 0), ('10', 0.0::DOUBLE, 10), ('50', 0.0::DOUBLE, 50), ('100', 0.0::DOUBLE, 100)) v(cut, share, fixed)),
g AS (SELECT source, cut, k, count(*) AS candidates, CAST(sum(label) AS BIGINT) AS positives, count(*) FILTER (label = 1 AND rank <= k) AS hits, min(rank) FILTER (label = 1 AND rank <= k) AS first, sum(seen / rank) FILTER (label = 1 AND rank <= k) AS prec FROM cuts GROUP BY source, cut, k),
m AS (SELECT source, cut, k, candidates, positives, hits, CASE WHEN positives = 0 THEN -1.0 ELSE round(hits / positives, 6) END AS recall, CASE WHEN positives = 0 THEN -1.0 ELSE round(least(1.0, k / candidates), 6) END AS random_recall,
  CASE WHEN positives = 0 THEN -1.0 ELSE round(coalesce(hits / positives / nullif(least(1.0, k / candidates), 0), 0.0), 6) END AS enrichment, CASE WHEN positives = 0 THEN -1.0 ELSE round(coalesce(1 / first, 0.0), 6) END AS mrr,
  CASE WHEN positives = 0 THEN -1.0 ELSE round(coalesce(prec / nullif(least(positives, k), 0), 0.0), 6) END AS ap FROM g)
"""


@register("o152_ranking_metrics", RANKING + "SELECT * FROM m")
def o152(s, d):
    return M.ranking(scored(s, d), "source", "doc_id")


@register("o152_hits_and_missed", RANKING + """
, o AS (SELECT *, row_number() OVER (PARTITION BY source, cut, rank <= k ORDER BY rank) AS place FROM cuts WHERE label = 1)
SELECT g.source, g.cut, g.k, coalesce((SELECT list(doc_id ORDER BY rank) FROM o WHERE o.source = g.source AND o.cut = g.cut AND rank <= o.k AND place <= 4), []) AS hits_list,
  coalesce((SELECT list(doc_id ORDER BY rank) FROM o WHERE o.source = g.source AND o.cut = g.cut AND rank > o.k AND place <= 4), []) AS missed_list FROM g""")
def o152_lists(s, d):
    return M.ranking(scored(s, d), "source", "doc_id", listed=4).select("source", "cut", "k", "hits_list", "missed_list")


@register("o153_confusion_metrics", f"""
WITH g AS (SELECT lang, count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 1) AS fn, count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM {SCORED} GROUP BY lang)
SELECT lang, tp, fp, fn, tn, round((tp + tn) / nullif(tp + fp + fn + tn, 0), 6) AS accuracy, round(tp / nullif(tp + fn, 0), 6) AS sensitivity, round(tn / nullif(tn + fp, 0), 6) AS specificity, round(tp / nullif(tp + fp, 0), 6) AS ppv, round(tn / nullif(tn + fn, 0), 6) AS npv,
  round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round(fp / nullif(fp + tn, 0), 6) AS fpr, round(fn / nullif(fn + tp, 0), 6) AS fnr, round(fp / nullif(fp + tp, 0), 6) AS fdr FROM g""")
def o153(s, d):
    return M.confusion(scored(s, d), "lang")


@register("o154_metric_summary", RANKING + " UNION ALL ".join(f"SELECT '{c}' AS metric, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(avg({c}) FILTER ({c} <> -1), 6) AS mean_defined FROM m WHERE cut = '10'" for c in ("recall", "mrr", "ap")))
def o154(s, d):
    return M.summarise(M.ranking(scored(s, d), "source", "doc_id", (("10", 10),)), ["recall", "mrr", "ap"])


@register("o155_id_mapping", 'SELECT node_type, id, name, CAST(row_number() OVER (PARTITION BY node_type ORDER BY id) - 1 AS BIGINT) AS "index" FROM nodes', view=True)
def o155(s, d):
    n = nodes(s, d)
    return G.dense_index(n).join(n.select("node_type", "id", "name"), ["node_type", "id"]).select("node_type", "id", "name", "index")


@register("o191_split_sanity", """
, i AS (SELECT id FROM nodes WHERE right(id, 1) <> '7') SELECT relation, count(*) AS n, count(*) FILTER (x_id NOT IN (SELECT id FROM i) OR y_id NOT IN (SELECT id FROM i)) AS out_of_bounds FROM edges GROUP BY relation""", view=True)
def o191(s, d):
    """Edges of a graph of which the nodes whose id ends in 7 have no index: their ends are out of bounds."""
    ix = G.dense_index(nodes(s, d).where("right(id, 1) <> '7'"))
    top = ix.groupBy("node_type").agg(F.max("index").alias("top"))
    ends = lambda e, t: top.select(F.col("node_type").alias(f"{e}_type"), F.col("top").alias(t))
    j = G.edge_index(edges(s, d), ix).join(ends("y", "ty"), "y_type", "left").join(ends("x", "tx"), "x_type", "left")
    bad = ~(F.col("src").between(0, F.col("tx")) & F.col("dst").between(0, F.col("ty")))
    return j.groupBy("relation").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(bad, F.lit(True))).alias("out_of_bounds"))
