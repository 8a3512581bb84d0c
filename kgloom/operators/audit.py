"""Integrity audits: membership, dangling ends, contracts, coverage, drift, conservation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per relation and type pair: rows, rows with a missing source, a missing target, and with either (each counted once)."""
    ids = nodes.select("node_type", "id").distinct()
    x = ids.select(F.col("node_type").alias("x_type"), F.col("id").alias("x_id"), F.lit(True).alias("x_ok"))
    y = ids.select(F.col("node_type").alias("y_type"), F.col("id").alias("y_id"), F.lit(True).alias("y_ok"))
    j = edges.select("relation", "x_type", "x_id", "y_type", "y_id").join(x, ["x_type", "x_id"], "left").join(y, ["y_type", "y_id"], "left")
    nx, ny = F.col("x_ok").isNull(), F.col("y_ok").isNull()
    return j.groupBy("relation", "x_type", "y_type").agg(F.count(F.lit(1)).alias("edges"), F.count_if(nx).alias("missing_x"), F.count_if(ny).alias("missing_y"), F.count_if(nx | ny).alias("dangling"))


def missing_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node_type, id) of distinct ends that no node has."""
    ends = edges.select(F.col("x_type").alias("node_type"), F.col("x_id").alias("id")).unionAll(edges.select("y_type", "y_id")).distinct()
    return ends.join(nodes.select("node_type", "id"), ["node_type", "id"], "left_anti")


def stubs(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """nodes with a stub row for every missing end; columns the stub lacks are null."""
    return nodes.withColumn("stub", F.lit(False)).unionByName(missing_endpoints(edges, nodes).withColumn("stub", F.lit(True)), allowMissingColumns=True)


def contract(edges: DataFrame, registry: DataFrame, key: list[str] = ["relation", "x_id", "y_id"]) -> DataFrame:  # noqa: B006
    """Per relation: rows, nulls in required columns, unknown relation, type mismatches, duplicate keys, blank sources,
    credibility null or outside 1..3. The registry is a small table with one row per relation."""
    r = F.broadcast(registry.select(F.col("relation").alias("__rel"), "source_type", "target_type"))
    dup = edges.groupBy(*key).count().where("count > 1").groupBy("relation").agg(F.sum(F.col("count") - 1).alias("duplicates"))
    j = edges.join(r, F.col("relation") == F.col("__rel"), "left")
    required = [F.col(c).isNull() for c in ("x_id", "x_type", "y_id", "y_type")]
    null = required[0] | required[1] | required[2] | required[3]
    out = j.groupBy("relation").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(null).alias("null_required"), F.count_if(F.col("__rel").isNull()).alias("unregistered"),
        F.count_if((F.col("x_type") != F.col("source_type")) | (F.col("y_type") != F.col("target_type"))).alias("type_mismatch"),
        F.count_if(F.trim(F.coalesce("source", F.lit(""))) == "").alias("blank_source"), F.count_if(F.coalesce(~F.col("credibility").between(1, 3), F.lit(True))).alias("bad_credibility"),
    )
    return out.join(dup, "relation", "left").withColumn("duplicates", F.coalesce("duplicates", F.lit(0)))


def drift(source: DataFrame, target: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """One row: keys missing in the target and, per field, how many shared keys differ (nulls are equal)."""
    t = target.select(*key, *(F.col(f).alias(f"__{f}") for f in fields), F.lit(True).alias("__hit"))
    j = source.select(*key, *fields).join(t, key, "left")
    hit = F.col("__hit").isNotNull()
    return j.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(~hit).alias("missing"), *(F.count_if(hit & ~F.col(f).eqNullSafe(F.col(f"__{f}"))).alias(f"{f}_differs") for f in fields))


def upsert(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """The target with the source's rows put in by key; both have the same columns."""
    return source.unionByName(target.join(source.select(*key), key, "left_anti").select(*source.columns))


def upsert_counts(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """A dry run: how many source keys exist in the target and how many don't."""
    t = target.select(*key).distinct().withColumn("__hit", F.lit(True))
    return source.join(t, key, "left").agg(F.count("__hit").alias("existing"), F.count_if(F.col("__hit").isNull()).alias("missing"))


def first_reason(**reasons: Column) -> Column:
    """The name of the first condition that holds, in order; null if none does."""
    return F.coalesce(*(F.when(c, k) for k, c in reasons.items()))


def all_reasons(**reasons: Column) -> Column:
    return F.concat_ws(";", *(F.when(c, k) for k, c in reasons.items()))


def coverage(features: DataFrame, nodes: DataFrame, length: str) -> DataFrame:
    """One row: nodes, feature rows, covered nodes, their share, shortest and longest value."""
    ids = nodes.select("id").distinct()
    f = features.select("id", F.col(length).alias("__n"))
    j = ids.join(f.groupBy("id").agg(F.min("__n").alias("lo"), F.max("__n").alias("hi"), F.count(F.lit(1)).alias("k")), "id", "left")
    return j.agg(F.count(F.lit(1)).alias("nodes"), F.coalesce(F.sum("k"), F.lit(0)).alias("feature_rows"), F.count("k").alias("covered"), F.round(F.count("k") / F.count(F.lit(1)), 6).alias("coverage"), F.min("lo").alias("shortest"), F.max("hi").alias("longest"))


def denominator(expected: DataFrame, done: DataFrame, key: str, **reasons: DataFrame) -> DataFrame:
    """Every expected key with one outcome: done, the first named set it is in, or unknown."""
    out = expected.select(key).distinct().join(done.select(key).distinct().withColumn("__done", F.lit(True)), key, "left")
    status = F.when(F.col("__done"), "done")
    for name, df in reasons.items():
        out = out.join(df.select(key).distinct().withColumn(f"__{name}", F.lit(True)), key, "left")
        status = status.when(F.col(f"__{name}"), name)
    return out.select(key, status.otherwise("unknown").alias("reason"))


def degrees(edges: DataFrame) -> DataFrame:
    """Incident edges per node, both directions summed."""
    return edges.select(F.col("x_id").alias("id")).unionAll(edges.select("y_id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def mirrored(edges: DataFrame) -> DataFrame:
    """Unordered pairs that stand in both directions."""
    pair = edges.select("relation", F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"), (F.col("x_id") < F.col("y_id")).alias("up"))
    return pair.where("a <> b").groupBy("relation", "a", "b").agg(F.countDistinct("up").alias("n")).where("n = 2").drop("n")


def keep_ranked(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, with the size of its group."""
    w = W.partitionBy(*key)
    return df.withColumn("group_size", F.count(F.lit(1)).over(w)).withColumn("__r", F.row_number().over(w.orderBy(*order))).where("__r = 1").drop("__r")
