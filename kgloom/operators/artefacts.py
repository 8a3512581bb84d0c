"""Derived artefacts: text rows, interval rows, vector parts, receipts, coverage comparisons, record mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import normalize as N


def text_features(nodes: DataFrame, texts: DataFrame, most: int) -> DataFrame:
    """(id, text, content_hash) of texts whose id is a node: white space folded, length bounded, blank ones dropped."""
    t = texts.join(nodes.select("id"), "id", "left_semi").select("id", N.bounded_text(F.col("text"), most).alias("text")).where("text <> ''")
    return t.withColumn("content_hash", F.sha2("text", 256))


def interval_features(rows: DataFrame, assembly: str) -> DataFrame:
    """(feature_key, id, chromosome, start, end, coordinate_hash) of interval rows."""
    c = N.chromosome(F.col("chromosome"))
    key = F.concat_ws("|", "id", F.lit(assembly), c, F.col("start").cast("string"), F.col("end").cast("string"))
    return rows.select(key.alias("feature_key"), "id", c.alias("chromosome"), "start", "end", F.sha2(key, 256).alias("coordinate_hash"))


def compact(parts: list[DataFrame], key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(one row per key, the first part's; report of sizes): later parts don't override, the report counts keys with several
    rows and vectors of each size."""
    all_ = None
    for i, p in enumerate(parts):
        p = p.select(key, vector, F.lit(i).alias("part"))
        all_ = p if all_ is None else all_.unionByName(p)
    one = all_.groupBy(key).agg(F.min_by(vector, "part").alias(vector), F.count(F.lit(1)).alias("n"))
    report = one.groupBy(F.size(vector).alias("dim")).agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("repeated"))
    return one.drop("n"), report


def source_identity(embedded: DataFrame, source: DataFrame, key: str, digest: str) -> DataFrame:
    """One row: keys on both sides, on one side only, and keys whose digests differ."""
    a, b = embedded.select(key, F.col(digest).alias("__a"), F.lit(True).alias("__l")), source.select(key, F.col(digest).alias("__b"), F.lit(True).alias("__r"))
    j = a.join(b, key, "full")
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    return j.agg(F.count_if(both).alias("shared"), F.count_if(F.col("__r").isNull()).alias("only_embedded"), F.count_if(F.col("__l").isNull()).alias("only_source"), F.count_if(both & ~F.col("__a").eqNullSafe(F.col("__b"))).alias("different"))


def coverage_change(before: DataFrame, after: DataFrame, key: str, field: str) -> DataFrame:
    """(was, now, n): how a field's state moved from one table to the other; a missing row is `absent`."""
    state = lambda c: F.when(F.col(c).isNull(), "unknown").otherwise("known")
    a, b = before.select(key, state(field).alias("was")), after.select(key, state(field).alias("now"))
    return a.join(b, key, "full").groupBy(F.coalesce("was", F.lit("absent")).alias("was"), F.coalesce("now", F.lit("absent")).alias("now")).agg(F.count(F.lit(1)).alias("n"))


def reconcile(records: DataFrame, unique: str, key: str, existing: DataFrame) -> DataFrame:
    """records whose secondary unique value is blanked where another record, or an earlier one, already has it."""
    e = existing.select(F.col(unique), F.col(key).alias("__owner"))
    first = F.row_number().over(W.partitionBy(unique).orderBy(key)) == 1
    j = records.withColumn("__first", first).join(e, unique, "left")
    keep = F.when(F.col("__owner").isNotNull(), F.col("__owner") == F.col(key)).otherwise(F.col("__first"))
    return j.withColumn(unique, F.when(keep, F.col(unique))).drop("__first", "__owner")


def receipt(observed: DataFrame, supported: DataFrame, key: list[str]) -> DataFrame:
    """One row: observed, supported, orphan and gap keys with order-free hashes of the key sets."""
    a, b = observed.select(*key).distinct().withColumn("__a", F.lit(True)), supported.select(*key).distinct().withColumn("__b", F.lit(True))
    j = a.join(b, key, "full")
    return j.agg(
        F.count("__a").alias("observed"), F.count(F.when(F.col("__a") & F.col("__b"), 1)).alias("supported"), F.count_if(F.col("__a").isNull()).alias("orphans"), F.count_if(F.col("__b").isNull()).alias("gaps"),
        F.bit_xor(F.when(F.col("__a"), F.xxhash64(*key))).alias("observed_hash"),
    )


def source_metadata(relation: Column, source: Column) -> Column:
    """Struct (source, dataset, kind) derived from a raw source and the relation: explicit parts first, then by relation."""
    p = N.source_parts(source)
    dataset = F.when(p["source_dataset"] != "", p["source_dataset"]).when(F.endswith(relation, F.lit("_in_nation")), "geography").otherwise("transactions")
    kind = F.when(F.startswith(relation, F.lit("supplier")), "supply").when(F.startswith(relation, F.lit("customer")), "demand").otherwise("reference")
    return F.struct(p["source"].alias("source"), dataset.alias("dataset"), kind.alias("kind"))


def add_category(nodes: DataFrame, edges: DataFrame, members: DataFrame, category: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) with category nodes and membership edges put in where they are missing; member ids lose a `.0`."""
    m = members.select(F.regexp_replace("id", r"\.0$", "").alias("id"), F.col("area")).distinct()
    cats = m.select(F.concat(F.lit(f"{category}:"), "area").alias("id"), F.lit(category).alias("node_type"), F.col("area").alias("name")).distinct()
    new = cats.join(nodes.select("id"), "id", "left_anti")
    e = m.join(nodes.select("id", F.col("node_type").alias("x_type")), "id").select(F.col("id").alias("x_id"), "x_type", F.concat(F.lit(f"{category}:"), "area").alias("y_id"), F.lit(category).alias("y_type"), F.lit(f"in_{category}").alias("relation"))
    e = e.join(edges.select("x_id", "y_id", "relation"), ["x_id", "y_id", "relation"], "left_anti")
    return nodes.unionByName(new, allowMissingColumns=True), edges.unionByName(e, allowMissingColumns=True)


def first_xref(df: DataFrame, key: str, columns: list[str], targets: DataFrame, target_id: str) -> DataFrame:
    """(key, id, via): the target of the first cross-reference column, in order, that a target has."""
    long = df.select(key, F.posexplode(F.array(*(F.struct(F.lit(c).alias("via"), F.col(c).cast("string").alias("ref")) for c in columns))).alias("pos", "x")).select(key, "pos", "x.via", "x.ref").where("ref is not null")
    hit = long.join(targets.select(F.col(target_id).alias("ref"), "id"), "ref")
    return hit.groupBy(key).agg(F.min_by(F.struct("id", "via"), F.struct("pos", "id")).alias("m")).select(key, "m.id", "m.via")
