"""Cross-reference maps, id remaps, projections through bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def one_to_one(pairs: DataFrame, source: str, target: str) -> DataFrame:
    """(source, targets, status): mapped when a source has one target, else ambiguous."""
    g = pairs.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(source, target).distinct().groupBy(source).agg(F.min(target).alias("t"), F.count(F.lit(1)).alias("n_targets"))
    one = F.col("n_targets") == 1
    return g.select(source, F.when(one, F.col("t")).alias(target), F.when(one, "mapped").otherwise("ambiguous").alias("status"), "n_targets")


def mutual(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs whose two sides have no other partner."""
    g = pairs.select(a, b).distinct()
    return g.withColumn("__a", F.count(F.lit(1)).over(W.partitionBy(a))).withColumn("__b", F.count(F.lit(1)).over(W.partitionBy(b))).where("__a = 1 and __b = 1").select(a, b)


def remap(edges: DataFrame, mapping: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, quarantined, collisions) after both ends went through a mapping (old_id, new_id, status).

    An end without an entry stays; one whose entry isn't accepted quarantines the row with a reason. Rows that fall on one
    key are ranked by credibility, source, display relation and sequence; the first is kept, the others are collisions that
    name it. The three parts add up to the input.
    """
    m = mapping.select("old_id", "new_id", F.col("status").alias("st"))
    j = edges
    for end in ("x", "y"):
        j = j.join(m.select(F.col("old_id").alias(f"{end}_id"), F.col("new_id").alias(f"{end}_new"), F.col("st").alias(f"{end}_st")), f"{end}_id", "left")
    bad = lambda e: F.col(f"{e}_st").isNotNull() & (F.col(f"{e}_st") != "accepted")
    reason = F.when(bad("x"), F.concat(F.lit("x_"), "x_st")).when(bad("y"), F.concat(F.lit("y_"), "y_st"))
    j = j.withColumn("reason", reason)
    cols = edges.columns
    ok = j.where("reason is null").withColumns({"x_id": F.coalesce("x_new", "x_id"), "y_id": F.coalesce("y_new", "y_id")})
    w = W.partitionBy("relation", "x_id", "y_id").orderBy(F.desc("credibility"), F.desc("source"), F.desc("display_relation"), seq)
    ranked = ok.withColumn("__r", F.row_number().over(w)).withColumn("kept_seq", F.first(seq).over(w))
    return ranked.where("__r = 1").select(*cols), j.where("reason is not null").select(*cols, "reason"), ranked.where("__r > 1").select(*cols, "kept_seq")


def projected_rows(edges: DataFrame, bridge: DataFrame, key: str) -> int:
    """How many rows a projection through the bridge will have: the sum of fan-outs, before any join of the rows."""
    fan = bridge.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return int(edges.groupBy(key).agg(F.count(F.lit(1)).alias("m")).join(fan, key).agg(F.coalesce(F.sum(F.col("m") * F.col("n")), F.lit(0))).first()[0])


def project(edges: DataFrame, bridge: DataFrame, key: str, most: int) -> DataFrame:
    """edges joined through the bridge, distinct; an error when the estimate is above the cap."""
    n = projected_rows(edges, bridge, key)
    if n > most:
        raise ValueError(f"the projection would have {n} rows, more than {most}")
    return edges.join(bridge, key).drop(key).distinct()


def alias_lists(old: DataFrame, aliases: DataFrame, key: str, alias: str, column: str) -> DataFrame:
    """old with the sorted distinct aliases of each key merged into its |-joined column."""
    new = aliases.groupBy(key).agg(F.collect_set(alias).alias("__new"))
    had = F.filter(F.split(F.coalesce(column, F.lit("")), r"\|"), lambda x: x != "")
    merged = F.array_join(F.array_sort(F.array_union(had, F.coalesce("__new", F.array().cast("array<string>")))), "|")
    return old.join(new, key, "left").withColumn(column, merged).drop("__new")
