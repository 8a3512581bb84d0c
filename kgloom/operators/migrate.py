"""Legacy relations and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def migrate(edges: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(migrated, unmapped): rules (old, relation, source_type, target_type) rename relations; a row whose types stand the
    other way round is flipped. Rules are a small registry, one row per relation."""
    j = edges.withColumnRenamed("relation", "old").join(F.broadcast(rules), "old", "left")
    ok = j.where("relation is not null")
    flip = (F.col("x_type") == F.col("target_type")) & (F.col("y_type") == F.col("source_type")) & (F.col("source_type") != F.col("target_type"))
    pick = lambda a, b: F.when(flip, F.col(b)).otherwise(F.col(a))
    new = {"x_id": pick("x_id", "y_id"), "x_type": pick("x_type", "y_type"), "y_id": pick("y_id", "x_id"), "y_type": pick("y_type", "x_type")}
    return ok.select(*(new.get(c, F.col(c)).alias(c) for c in edges.columns)), j.where("relation is null").groupBy("old").agg(F.count(F.lit(1)).alias("n"))
