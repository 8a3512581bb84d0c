"""Jobs over staged source files: variants and loci, sites, target catalogues, vendor ids, text summaries, trial texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.intervals import contains
from ..operators.mapping import one_to_one


def variant_nodes(variants: DataFrame, backed: DataFrame, loci: DataFrame) -> DataFrame:
    """(id, n_loci, backed) of variants (id, chrom, pos) that lie in a locus (chrom, s, e, both ends inside) or are backed (id)
    by evidence; a variant outside every locus and without evidence is no node."""
    where = contains(variants.select("id", "chrom", "pos"), loci, "chrom", "pos", "s", "e").groupBy("id").agg(F.count(F.lit(1)).alias("n_loci"))
    known = variants.select("id").distinct().join(where, "id", "left").join(backed.select("id").distinct().withColumn("backed", F.lit(True)), "id", "left")
    return known.select("id", F.coalesce("n_loci", F.lit(0)).alias("n_loci"), F.coalesce("backed", F.lit(False)).alias("backed")).where("n_loci > 0 or backed")


def site_nodes(entries: DataFrame, around: int) -> tuple[DataFrame, DataFrame]:
    """Sites of entries (id, sequence, features array<struct<kind, position, papers array<string>>>) and their evidence.

    A feature counts when its position, from 1, is exact and inside the sequence. A site is (site_id, id, position, residue,
    context), context being up to `around` letters on both sides. Its evidence is one row of the database and one a paper.
    """
    f = entries.select("id", "sequence", F.explode("features").alias("f")).select("id", "sequence", "f.*").where("position between 1 and length(sequence)")
    site = F.concat_ws(":", "id", "kind", F.concat(F.substring("sequence", F.col("position"), F.lit(1)), F.col("position").cast("string")))
    first = F.greatest(F.lit(1), F.col("position") - around)
    f = f.withColumns({"site_id": site, "residue": F.substring("sequence", F.col("position"), F.lit(1)), "context": F.substring("sequence", first, F.col("position") + around - first + 1)})
    sites = f.groupBy("site_id").agg(*(F.first(c).alias(c) for c in ("id", "position", "residue", "context")))
    papers = F.filter(F.coalesce("papers", F.array().cast("array<string>")), lambda p: p.isNotNull() & (p != ""))
    evidence = f.select("site_id", F.explode(F.concat(F.array(F.lit("database")), papers)).alias("reference")).distinct()
    return sites, evidence


def resolved_targets(rows: DataFrame, by_code: DataFrame, by_symbol: DataFrame, known: DataFrame) -> DataFrame:
    """rows (id, code, symbol) with target and status: the target of a unique code, else of a unique symbol, when it is a known
    id; else why not (unmapped, missing_endpoint). by_code: (code, target), by_symbol: (symbol, target)."""
    code = one_to_one(by_code, "code", "target").select("code", F.col("target").alias("__c"))
    symbol = one_to_one(by_symbol, "symbol", "target").select("symbol", F.col("target").alias("__s"))
    out = rows.join(code, "code", "left").join(symbol, "symbol", "left").withColumn("target", F.coalesce("__c", "__s")).drop("__c", "__s")
    out = out.join(known.select(F.col("id").alias("target")).distinct().withColumn("__k", F.lit(True)), "target", "left")
    status = F.when(F.col("target").isNull(), "unmapped").when(F.col("__k").isNull(), "missing_endpoint").otherwise("accepted")
    return out.select("id", F.when(status == "accepted", F.col("target")).alias("target"), status.alias("status"))


def vendor_ids(cells: DataFrame, columns: list[str]) -> DataFrame:
    """(vendor, vendor_id, id): the ids that cells (id and one column a vendor) have at each vendor, those of one cell only."""
    every = cells.select("id", F.explode(F.array(*(F.struct(F.lit(c).alias("vendor"), F.trim(c).alias("vendor_id")) for c in columns))).alias("v")).select("id", "v.*").where("vendor_id <> ''").distinct()
    only = every.groupBy("vendor", "vendor_id").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    return only.where("n = 1").select("vendor", "vendor_id", "id")


def summaries(terms: DataFrame, nodes: DataFrame, fields: list[str], most: int) -> DataFrame:
    """(id, summary) of stanzas (id, fields) whose id is a node: the first value of each field, joined and cut to `most`."""
    first = lambda f: F.try_element_at(F.try_element_at("fields", F.lit(f)), F.lit(1))
    text = F.substring(F.concat_ws(". ", *(first(f) for f in fields)), 1, most)
    return terms.select("id", text.alias("summary")).where("summary <> ''").join(nodes.select("id").distinct(), "id", "left_semi")


def trial_texts(trials: DataFrame, edges: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Feature rows (key, text, content_sha256) of trials with a text, and the checks of the artefact (check, n): rows, keys that
    stand twice, features without an edge and edges without a feature."""
    rows = trials.select(key, F.trim(F.regexp_replace(text, r"\s+", " ")).alias("text")).where("text <> ''").withColumn("content_sha256", F.sha2("text", 256))
    linked = edges.select(key).distinct()
    count = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
    checks = count("rows", rows).unionAll(count("repeated_keys", rows.groupBy(key).count().where("count > 1")))
    checks = checks.unionAll(count("orphan_features", rows.join(linked, key, "left_anti"))).unionAll(count("edges_without_feature", linked.join(rows, key, "left_anti")))
    return rows, checks
