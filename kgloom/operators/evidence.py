"""Evidence per edge: summaries, consensus, keys, contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.normalize import joined

EDGE = ["relation", "x_id", "y_id"]
DEDUP = [*EDGE, "evidence_type", "source", "source_dataset", "source_record_id", "paper_id", "dataset_id", "study_id", "predicate"]
# Evidence types that a feature-context table may hold, and those it must not.
CONTEXT_TYPES = ["correlative", "non_causal", "predictive", "association_score", "candidate_context"]
CAUSAL_TYPES = ["causal", "mechanistic", "regulatory", "physical_interaction", "ppi", "direct_binding", "direct_regulation"]


def summary(evidence: DataFrame, key: list[str] = ["x_id", "y_id"]) -> DataFrame:  # noqa: B006
    """Per edge: count, sorted distinct sources joined by `; `, best score."""
    return evidence.groupBy(*key).agg(F.count(F.lit(1)).alias("evidence_count"), joined(F.collect_set("source")).alias("evidence_sources"), F.max("evidence_score").alias("best_score"))


def keep_last(df: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The last row of each key in the order of seq."""
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*key).orderBy(F.desc(seq)))).where("__r = 1").drop("__r")


def edge_key(relation: Column, x: Column, y: Column) -> Column:
    return F.concat_ws("|", relation, x, y)


def coerce_evidence(rows: DataFrame, registry: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows that keep the contract (relation known, end types as registered), blanks filled, keyed, the last duplicate kept."""
    known = rows.join(F.broadcast(registry.select("relation", F.col("source_type").alias("x_type"), F.col("target_type").alias("y_type"))), ["relation", "x_type", "y_type"], "left_semi")
    for c in DEDUP:
        known = known.withColumn(c, F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit(""))
    return keep_last(known.withColumn("edge_key", edge_key(F.col("relation"), F.col("x_id"), F.col("y_id"))), DEDUP, seq)


def coerce_context(rows: DataFrame, endpoints: list[tuple[str, str]], key: list[str], seq: str = "seq") -> DataFrame:
    """Feature-context rows of allowed end types and evidence types, with their composite key; the last duplicate is kept."""
    pairs = F.array(*(F.lit(f"{a}|{b}") for a, b in endpoints))
    ok = F.array_contains(pairs, F.concat_ws("|", "x_type", "y_type")) & F.col("evidence_type").isin(CONTEXT_TYPES)
    return keep_last(rows.where(ok).withColumn("feature_key", F.concat_ws("|", *(F.coalesce(F.col(k), F.lit("")) for k in key))), key, seq)


def consensus(rows: DataFrame, key: list[str], value: str, assertion: str) -> DataFrame:
    """Per edge: status unknown (no usable value), conflicting (several values), single or consensus (by distinct
    assertions), and the sorted values as JSON."""
    usable = F.nullif(F.trim(value), F.lit(""))
    g = rows.groupBy(*key).agg(F.array_sort(F.collect_set(usable)).alias("vals"), F.countDistinct(F.when(usable.isNotNull(), F.col(assertion))).alias("n_assertions"))
    status = F.when(F.size("vals") == 0, "unknown").when(F.size("vals") > 1, "conflicting").when(F.col("n_assertions") > 1, "consensus").otherwise("single")
    return g.select(*key, status.alias("status"), F.to_json("vals").alias("values_json"), "n_assertions")


def assertion_conflicts(rows: DataFrame, key: list[str], value: str, assertion: str) -> DataFrame:
    """rows with `conflicting`: the same assertion gives several values on one edge."""
    w = W.partitionBy(*key, assertion)
    return rows.withColumn("conflicting", F.size(F.collect_set(F.nullif(F.trim(value), F.lit(""))).over(w)) > 1)


OPPOSITES = [("increase", "decrease"), ("sensitive", "resistant"), ("increased_efficacy", "decreased_efficacy"), ("increased_toxicity", "decreased_toxicity"), ("increased_exposure", "decreased_exposure")]


def direction_features(edges: DataFrame, evidence: DataFrame, key: list[str] = ["x_id", "y_id"]) -> DataFrame:  # noqa: B006
    """Each edge with the status of its evidence's directions; opposite directions conflict; edges without evidence are
    unknown with count 0."""
    g = evidence.groupBy(*key).agg(F.array_sort(F.collect_set(F.nullif(F.trim("direction"), F.lit("")))).alias("directions"), F.count(F.lit(1)).alias("n"))
    clash = F.lit(False)
    for a, b in OPPOSITES:
        clash = clash | (F.array_contains("directions", a) & F.array_contains("directions", b))
    status = F.when(F.coalesce(F.size("directions"), F.lit(0)) <= 0, "unknown").when(clash, "conflicting").when(F.size("directions") > 1, "mixed").otherwise("known")
    return edges.join(g, key, "left").select(*key, status.alias("direction_status"), F.coalesce(F.array_join("directions", ","), F.lit("")).alias("directions"), F.coalesce("n", F.lit(0)).alias("evidence_count"))


def parity(edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per relation: edges, evidence keys, edges without evidence, evidence without edge."""
    a = edges.select("relation", edge_key(F.col("relation"), F.col("x_id"), F.col("y_id")).alias("k")).distinct().withColumn("e", F.lit(True))
    b = evidence.select("relation", "edge_key").distinct().withColumnRenamed("edge_key", "k").withColumn("v", F.lit(True))
    j = a.join(b, ["relation", "k"], "full")
    return j.groupBy("relation").agg(
        F.count("e").alias("edge_keys"), F.count("v").alias("evidence_keys"), F.count_if(F.col("v").isNull()).alias("edges_without_evidence"), F.count_if(F.col("e").isNull()).alias("evidence_without_edge")
    )


def evidence_context(evidence: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per edge and field: the one distinct value, or its status `conflicting` with the sorted values."""
    vals = evidence.groupBy(key).agg(*(F.array_sort(F.collect_set(F.nullif(F.lower(F.trim(f)), F.lit("")))).alias(f"{f}_values") for f in fields))
    out = [F.col(key)]
    for f in fields:
        v = F.col(f"{f}_values")
        out += [F.when(F.size(v) == 1, v[0]).alias(f), F.when(F.size(v) == 0, "unknown").when(F.size(v) == 1, "known").otherwise("conflicting").alias(f"{f}_status"), F.array_join(v, ",").alias(f"{f}_values")]
    return vals.select(*out)
