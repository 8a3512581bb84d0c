"""Ranking and classification metrics over scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .cuts import cut
from .graph import numbered


#: Cut-offs of ranking metrics: shares of the candidates and numbers of items.
CUTS = (("1%", 0.01), ("5%", 0.05), ("10%", 0.1), ("10", 10), ("50", 50), ("100", 100))


def auroc_ap(scored: DataFrame, group: str) -> DataFrame:
    """(group, positives, negatives, auroc, ap) with ties averaged, a row a group and the rows `micro`, over all rows together,
    and `macro`, the mean over the groups in which a value is defined.

    Rows are first counted per distinct score; sums along the scores come from written range partitions, so a group with many
    different scores needs no task of its own.
    """
    g = scored.groupBy(F.col(group).cast("string").alias(group), "score").agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("p"), F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).alias("n"))
    g = cut(g)
    pooled = g.groupBy("score").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    g = numbered(g.withColumn("__micro", F.lit(False)).unionByName(pooled.select(F.lit(None).cast("string").alias(group), "score", "p", "n", F.lit(True).alias("__micro"))), ["__micro", group], [-F.col("score")], F.col("p"), {"n": F.col("n")})
    out = g.groupBy("__micro", group).agg(
        F.max("__all").alias("positives"), F.max("__all_n").alias("negatives"),
        F.sum(F.col("n") * (F.col("__w") - F.col("p") / 2)).alias("area"), F.sum(F.col("p") * F.col("__w") / (F.col("__w") + F.col("__w_n"))).alias("precision"),
    )
    auc = F.col("area") / F.nullif(F.col("positives") * F.col("negatives"), F.lit(0))
    out = out.select("__micro", group, "positives", "negatives", auc.alias("auroc"), (F.col("precision") / F.nullif(F.col("positives"), F.lit(0))).alias("ap"))
    macro = out.where("not __micro").agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), F.avg("auroc").alias("auroc"), F.avg("ap").alias("ap")).select(F.lit("macro").alias(group), "positives", "negatives", "auroc", "ap")
    out = out.withColumn(group, F.when(F.col("__micro"), "micro").otherwise(F.col(group))).drop("__micro").unionByName(macro)
    return out.withColumns({c: F.round(c, 6) for c in ("auroc", "ap")})


def ranking(scored: DataFrame, entity: str, item: str, cuts: tuple = CUTS, listed: int = 0) -> DataFrame:
    """A row an entity and cut-off, over items by score (highest first) then id: k (a share of the candidates is rounded down),
    candidates, positives, hits, recall, random recall k/N, enrichment, MRR (1 / rank of the first hit), AP; without positives
    the metrics are -1. With `listed`, also hits_list and missed_list: the first so many positives up to k, and behind it.

    Ranks are offsets of written range partitions; all cut-offs are summed up in one pass over them, so no entity is sorted or
    gathered in one task.
    """
    r = numbered(scored, [entity], [-F.col("score"), F.col(item)], (F.col("label") == 1).cast("long"))
    r = r.select(entity, F.col(item).alias("__item"), F.col("label") == 1, F.col("__r").alias("rank"), F.col("__n").alias("n"), F.col("__w").alias("so_far")).toDF(entity, "__item", "__hit", "rank", "n", "so_far")
    at = lambda c: F.floor(F.col("n") * c).cast("long") if isinstance(c, float) else F.lit(c).cast("long")
    sums = []
    for j, (_, c) in enumerate(cuts):
        hit = F.col("__hit") & (F.col("rank") <= at(c))
        sums += [F.count_if(hit).alias(f"h{j}"), F.min(F.when(hit, F.col("rank"))).alias(f"f{j}"), F.sum(F.when(hit, F.col("so_far") / F.col("rank"))).alias(f"p{j}")]
    g = r.groupBy(entity).agg(F.max("n").alias("n"), F.count_if("__hit").alias("positives"), *sums)
    one = lambda j, name, c: F.struct(F.lit(name).alias("cut"), at(c).alias("k"), F.col(f"h{j}").alias("hits"), F.col(f"f{j}").alias("first"), F.col(f"p{j}").alias("prec"))
    g = g.select(entity, F.col("n").alias("candidates"), "positives", F.explode(F.array(*(one(j, name, c) for j, (name, c) in enumerate(cuts)))).alias("c")).select(entity, "candidates", "positives", "c.*")
    none, recall = F.col("positives") == 0, F.col("hits") / F.nullif(F.col("positives"), F.lit(0))
    chance = F.least(F.lit(1.0), F.col("k") / F.col("candidates"))
    m = lambda c: F.round(F.when(none, -1.0).otherwise(F.coalesce(c, F.lit(0.0))), 6)
    out = g.select(
        entity, "cut", "k", "candidates", "positives", "hits", m(recall).alias("recall"), m(chance).alias("random_recall"), m(recall / F.nullif(chance, F.lit(0.0))).alias("enrichment"),
        m(1 / F.col("first")).alias("mrr"), m(F.col("prec") / F.nullif(F.least(F.col("positives"), F.col("k")), F.lit(0))).alias("ap"),
    )
    if not listed:
        return out
    # A positive's place among the positives tells whether it is one of the first before or behind each cut-off.
    p = r.where("__hit").join(g.select(F.col(entity).alias("__e"), "cut", "k", "hits"), F.col(entity).eqNullSafe(F.col("__e"))).drop("__e")
    p = p.withColumn("__found", F.col("rank") <= F.col("k")).where(F.col("so_far") <= F.when(F.col("__found"), listed).otherwise(F.col("hits") + listed))
    items = lambda found: F.transform(F.array_sort(F.collect_list(F.when(F.col("__found") == found, F.struct("rank", "__item")))), lambda x: x["__item"])
    lists = p.groupBy(F.col(entity).alias("__e"), F.col("cut").alias("__c")).agg(items(True).alias("hits_list"), items(False).alias("missed_list"))
    empty = lambda c: F.coalesce(c, F.array().cast(f"array<{dict(scored.dtypes)[item]}>")).alias(c)
    return out.join(lists, F.col(entity).eqNullSafe(F.col("__e")) & (F.col("cut") == F.col("__c")), "left").select(*out.columns, empty("hits_list"), empty("missed_list"))


def confusion(scored: DataFrame, group: str, threshold: float = 0.5) -> DataFrame:
    """Thresholded counts and rates per group; a zero denominator gives null."""
    yes, pos = F.col("score") >= threshold, F.col("label") == 1
    g = scored.groupBy(group).agg(F.count_if(yes & pos).alias("tp"), F.count_if(yes & ~pos).alias("fp"), F.count_if(~yes & pos).alias("fn"), F.count_if(~yes & ~pos).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    over = lambda a, b: F.round(a / F.nullif(b, F.lit(0)), 6)
    return g.select(
        group, "tp", "fp", "fn", "tn", over(tp + tn, tp + fp + fn + tn).alias("accuracy"), over(tp, tp + fn).alias("sensitivity"), over(tn, tn + fp).alias("specificity"),
        over(tp, tp + fp).alias("ppv"), over(tn, tn + fn).alias("npv"), over(2 * tp, 2 * tp + fp + fn).alias("f1"), over(fp, fp + tn).alias("fpr"), over(fn, fn + tp).alias("fnr"), over(fp, fp + tp).alias("fdr"),
    )


def summarise(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, mean, std, mean_defined): over all rows, population deviation, and the mean without the -1 of undefined rows."""
    long = rows.select(*(F.col(m).cast("double").alias(m) for m in metrics)).unpivot([], metrics, "metric", "value")
    return long.groupBy("metric").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("std"), F.round(F.avg(F.when(F.col("value") != -1, F.col("value"))), 6).alias("mean_defined"))
