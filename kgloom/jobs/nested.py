"""Jobs over nested source records: targets, orthology, interactions, evidence fan-out, essentiality, expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import normalize as N
from ..operators.audit import first_reason


def edge(df: DataFrame, x: Column, xt: str, y: Column, yt: str, relation: str, source: Column, credibility: Column) -> DataFrame:
    """Distinct edge rows with the eight core columns; rows with a missing end are left out."""
    out = df.select(x.cast("string").alias("x_id"), F.lit(xt).alias("x_type"), y.cast("string").alias("y_id"), F.lit(yt).alias("y_type"), F.lit(relation).alias("relation"), F.lit(relation.replace("_", " ")).alias("display_relation"), source.alias("source"), credibility.cast("long").alias("credibility"))
    return out.where("x_id is not null and y_id is not null").distinct()


def dogma(targets: DataFrame) -> dict[str, DataFrame]:
    """Targets (id, transcripts array<struct<id, protein>>, proteinIds array<struct<source, id>>) to gene-transcript and
    transcript-protein edges and one accession per gene: a reviewed one first, then any, by id."""
    t = targets.select("id", F.explode("transcripts").alias("t"))
    acc = targets.select("id", F.explode_outer("proteinIds").alias("p"))
    best = W.partitionBy("id").orderBy(F.when(F.col("p.source") == "uniprot_swissprot", 0).otherwise(1), F.col("p.id"))
    s = F.lit("targets")
    return {
        "gene_has_transcript": edge(t, F.col("id"), "gene", F.col("t.id"), "transcript", "gene_has_transcript", s, F.lit(3)),
        "transcript_encodes_protein": edge(t, F.col("t.id"), "transcript", F.col("t.protein"), "protein", "transcript_encodes_protein", s, F.lit(3)),
        "accessions": acc.withColumn("r", F.row_number().over(best)).where("r = 1").select("id", F.col("p.id").alias("uniprot_id")),
    }


def orthology(rows: DataFrame, canonical: DataFrame, species: list[str], least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(edges, rejects) of homologue rows (gene, target, homology_type, species, confidence): paralogs are kept once per pair,
    self pairs, other species, low confidence and unknown targets are named rejects."""
    known = canonical.select(F.col("id").alias("target"), F.lit(True).alias("__known"))
    j = rows.join(known, "target", "left")
    why = first_reason(self_pair=F.col("gene") == F.col("target"), other_species=~F.col("species").isin(species), low_confidence=F.coalesce(F.col("confidence") < least, F.lit(False)), unknown_target=F.col("__known").isNull())
    j = j.withColumn("reason", why)
    para = F.col("homology_type").contains("paralog")
    ok = j.where("reason is null")
    x, y = F.when(para, F.least("gene", "target")).otherwise(F.col("gene")), F.when(para, F.greatest("gene", "target")).otherwise(F.col("target"))
    out = ok.select(x.alias("x_id"), y.alias("y_id"), F.when(para, "gene_paralog_of_gene").otherwise("gene_ortholog_of_gene").alias("relation")).distinct()
    return out, j.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def interactions(rows: DataFrame, bins: list[tuple[float, int]] = [(0.4, 1), (0.7, 2)], top: int = 3) -> DataFrame:  # noqa: B006
    """Undirected pairs (a, b, score): one row per unordered pair with its best score and level; self pairs are left out."""
    p = rows.where("a <> b").select(F.least("a", "b").alias("x_id"), F.greatest("a", "b").alias("y_id"), "score")
    return p.groupBy("x_id", "y_id").agg(F.max("score").alias("score"), F.count(F.lit(1)).alias("n")).withColumn("credibility", N.bins(F.col("score"), *bins, top=top))


def evidence_fan_out(rows: DataFrame, routes: dict[str, list[str]]) -> DataFrame:
    """Evidence rows sent to relations by data type; a row whose type has no route is counted as `unrouted`."""
    rel = F.lit(None).cast("string")
    for relation, types in routes.items():
        rel = F.coalesce(rel, F.when(F.col("datatype").isin(types), relation))
    return rows.withColumn("relation", F.coalesce(rel, F.lit("unrouted")))


def essentiality(records: DataFrame) -> DataFrame:
    """(gene, tissue, cell_line, effect) of triple-nested screens; a screen without an explicit measurement is left out, zero
    is one."""
    a = records.select("id", F.explode("geneEssentiality").alias("e")).select("id", F.explode("e.depMapEssentiality").alias("d"))
    s = a.select("id", F.col("d.tissueName").alias("tissue"), F.explode("d.screens").alias("s"))
    return s.where(N.measured(F.col("s.geneEffect"))).select(F.col("id").alias("gene"), "tissue", F.col("s.cellLineName").alias("cell_line"), F.col("s.geneEffect").alias("effect")).distinct()


def expression(records: DataFrame, least: float) -> DataFrame:
    """(gene, tissue, value) of nested tissue values at or above a level."""
    t = records.select("id", F.explode("tissues").alias("t"))
    return t.where(F.col("t.rna.value") >= least).select(F.col("id").alias("gene"), F.col("t.efo_code").alias("tissue"), F.col("t.rna.value").alias("value"))


def phenotypes(records: DataFrame) -> DataFrame:
    """Disease-phenotype pairs without any negated evidence, with the level that their evidence codes give."""
    ok = records.where(~F.exists("evidence", lambda e: F.coalesce(e["qualifierNot"], F.lit(False))))
    return ok.select(N.curie(F.col("disease")).alias("x_id"), N.curie(F.col("phenotype")).alias("y_id"), N.codes_credibility(F.transform("evidence", lambda e: e["evidenceType"])).alias("credibility"))
