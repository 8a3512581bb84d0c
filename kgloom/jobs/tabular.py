"""Jobs over flat source files: interaction tables, complexes, pathway members, localisations, ontologies, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import normalize as N
from ..operators.audit import first_reason
from ..operators.mapping import one_to_one


def mitab(rows: DataFrame, proteins: DataFrame, allowed: list[str], taxon: str = "9606") -> DataFrame:
    """Interaction rows (a, b, taxid_a, taxid_b, type, negative, features) with `reason`, null for accepted ones, and the
    canonical pair (x_id, y_id). Ends are mapped by unambiguous accessions; a self pair needs an explicit homomer feature."""
    acc = one_to_one(proteins, "accession", "protein").where("status = 'mapped'")
    m = lambda e: acc.select(F.col("accession").alias(f"acc_{e}"), F.col("protein").alias(f"p_{e}"))
    token = lambda c: N.xref_token(F.col(c))["id"]
    j = rows.withColumn("acc_a", token("a")).withColumn("acc_b", token("b")).join(m("a"), "acc_a", "left").join(m("b"), "acc_b", "left")
    tax = lambda c: F.contains(F.coalesce(F.col(c), F.lit("")), F.lit(f"taxid:{taxon}("))
    why = first_reason(
        negative_evidence=F.lower(F.coalesce("negative", F.lit("false"))) == "true", non_human_or_cross_species=~(tax("taxid_a") & tax("taxid_b")),
        unsupported_endpoint_namespace=F.col("acc_a").isNull() | F.col("acc_b").isNull(), interaction_type_association_too_broad=F.contains("type", F.lit("(association)")),
        interaction_type_not_allowlisted=~F.regexp_extract("type", r"(MI:[0-9]+)", 1).isin(allowed), protein_node_unmapped=F.col("p_a").isNull() | F.col("p_b").isNull(),
        self_loop_requires_homodimer_support=(F.col("p_a") == F.col("p_b")) & ~F.contains(F.lower(F.coalesce("features", F.lit(""))), F.lit("homo")),
    )
    return j.withColumn("reason", why).withColumn("x_id", F.least("p_a", "p_b")).withColumn("y_id", F.greatest("p_a", "p_b"))


def complexes(rows: DataFrame, proteins: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(edges, rejects) of complex rows (complex_ac, participants `id(stoichiometry)|...`): the last row of a complex counts;
    a complex as participant gives child -> parent, an unambiguous accession complex -> protein."""
    last = rows.withColumn("__r", F.row_number().over(W.partitionBy("complex_ac").orderBy(F.desc(seq)))).where("__r = 1")
    p = last.select("complex_ac", F.explode(N.pipe_list(F.col("participants"))).alias("token"))
    p = p.select("complex_ac", "token", F.nullif(F.regexp_extract("token", r"^([^()]+)", 1), F.lit("")).alias("part"), F.regexp_extract("token", r"\(([0-9]+)\)$", 1).try_cast("int").alias("stoichiometry"))
    acc = one_to_one(proteins, "accession", "protein").select(F.col("accession").alias("part"), "protein", "status")
    known = last.select(F.col("complex_ac").alias("part"), F.lit(True).alias("is_complex"))
    j = p.join(acc, "part", "left").join(known, "part", "left")
    why = first_reason(
        no_id=F.col("part").isNull(), self_reference=F.col("part") == F.col("complex_ac"), ambiguous_accession=F.coalesce(F.col("status") == "ambiguous", F.lit(False)) & F.col("is_complex").isNull(),
        unmapped=F.col("protein").isNull() & F.col("is_complex").isNull(),
    )
    j = j.withColumn("reason", why)
    ok = j.where("reason is null")
    nested = ok.where("is_complex").select(F.col("part").alias("x_id"), F.col("complex_ac").alias("y_id"), F.lit("complex_part_of_complex").alias("relation"), "stoichiometry")
    direct = ok.where("is_complex is null").select(F.col("complex_ac").alias("x_id"), F.col("protein").alias("y_id"), F.lit("complex_contains_protein").alias("relation"), "stoichiometry")
    return nested.unionByName(direct), j.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def pathway_members(rows: DataFrame, proteins: DataFrame, pathways: DataFrame) -> DataFrame:
    """Membership rows (accession, pathway) with the protein and `reason`: ambiguous, unmapped or missing pathway."""
    acc = one_to_one(proteins, "accession", "protein").select("accession", "protein", "status")
    j = rows.join(acc, "accession", "left").join(pathways.select(F.col("id").alias("pathway"), F.lit(True).alias("__has")), "pathway", "left")
    return j.withColumn("reason", first_reason(ambiguous_accession=F.coalesce(F.col("status") == "ambiguous", F.lit(False)), unmapped_accession=F.col("status").isNull(), missing_pathway=F.col("__has").isNull())).drop("__has", "status")


# Reliability words of localisation rows and their level; the largest is clamped to the contract's 3.
RELIABILITY = {"enhanced": 3, "supported": 3, "approved": 2, "uncertain": 1}


def localisations(rows: DataFrame, proteins: DataFrame, *mappings: DataFrame) -> DataFrame:
    """(protein, component, credibility) of rows (accession, reliability, labels `a;b`): a label's component comes from the
    first mapping (label, component) that has it, else it is local:<label>; ambiguous accessions are expanded.

    An accession's components are summed up before proteins join, so that its rows don't multiply by its proteins.
    """
    level = F.lit(1)
    for k, v in RELIABILITY.items():
        level = F.when(F.lower("reliability") == k, v).otherwise(level)
    r = rows.select("accession", level.alias("level"), F.explode(F.split("labels", ";")).alias("label")).withColumn("label", F.lower(F.trim("label"))).where("label <> ''")
    found = []
    for i, m in enumerate(mappings):
        r = r.join(m.groupBy(F.lower("label").alias("label")).agg(F.min("component").alias(f"__m{i}")), "label", "left")
        found.append(F.col(f"__m{i}"))
    component = F.coalesce(*found, F.concat(F.lit("local:"), F.regexp_replace("label", " ", "_")))
    held = r.groupBy("accession", component.alias("component")).agg(F.max("level").alias("level"))
    return held.join(proteins.distinct(), "accession").groupBy("protein", "component").agg(F.max("level").cast("long").alias("credibility"))


def ontology_edges(terms: DataFrame, known: DataFrame, prefix: str, part_prefix: str) -> DataFrame:
    """Edges of stanzas (id, fields): is_a to terms of the same ontology, part_of to the other; both ends must be known, and
    rows carry a reason where not."""
    targets = lambda f, p: F.transform(F.filter(F.coalesce(F.col("fields")[f], F.array().cast("array<string>")), lambda x: F.regexp_like(x, F.lit(p))), lambda x: F.regexp_extract(x, p, 1))
    isa = terms.select("id", F.explode(targets("is_a", f"^({prefix}:\\S+)")).alias("to")).withColumn("relation", F.lit("subtype_of"))
    part = terms.select("id", F.explode(targets("relationship", f"^(?:part_of|located_in) ({part_prefix}:\\S+)")).alias("to")).withColumn("relation", F.lit("part_of"))
    ok = lambda c, n: known.select(F.col("id").alias(c), F.lit(True).alias(n))
    j = isa.unionByName(part).join(ok("id", "__a"), "id", "left").join(ok("to", "__b"), "to", "left")
    return j.select(F.col("id").alias("x_id"), F.col("to").alias("y_id"), "relation", first_reason(unknown_source=F.col("__a").isNull(), unknown_target=F.col("__b").isNull()).alias("reason"))


def condition_candidates(cells: DataFrame, by: list[str], least: int) -> DataFrame:
    """Groups of cells with their count and all reasons against them, joined."""
    from ..operators.audit import all_reasons

    g = cells.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cells"))
    return g.withColumn("reasons", all_reasons(few_cells=F.col("n_cells") < least, **{f"missing_{c}": N.clean(F.col(c).cast("string")).isNull() for c in by}))


def provenance(works: DataFrame, first: int) -> dict[str, DataFrame]:
    """Works (id, doi, pmid, references array<string>, dataset) to paper ids (DOI, else PMID, else work id), paper-dataset
    edges and the first k citations of each."""
    pid = F.coalesce(F.concat(F.lit("DOI:"), N.doi(F.col("doi"))), F.concat(F.lit("PMID:"), N.clean(F.col("pmid"))), N.clean(F.col("id")))
    w = works.withColumn("paper", pid)
    cites = w.select("paper", F.posexplode(F.slice("references", 1, first)).alias("pos", "cited")).join(w.select(F.col("id").alias("cited"), F.col("paper").alias("target")), "cited")
    return {
        "papers": w.select("paper").distinct(), "datasets": w.where("dataset is not null").select(F.col("paper").alias("x_id"), F.col("dataset").alias("y_id"), F.lit(1).cast("long").alias("credibility")).distinct(),
        "citations": cites.select(F.col("paper").alias("x_id"), F.col("target").alias("y_id"), "pos", F.lit(3).cast("long").alias("credibility")),
    }


def symbol_mapping(rows: DataFrame) -> DataFrame:
    """(gene, symbol, transcript, precursor) to one row per gene and precursor: `high` where all four relations are one to
    one, else `ambiguous` with the reasons."""
    from ..operators.audit import all_reasons

    n = lambda what, by: F.size(F.collect_set(what).over(W.partitionBy(by)))
    r = rows.distinct().withColumns({"a": n("transcript", "gene"), "b": n("gene", "symbol"), "c": n("precursor", "symbol"), "d": n("symbol", "precursor")})
    why = all_reasons(transcripts_per_gene=F.col("a") > 1, genes_per_symbol=F.col("b") > 1, precursors_per_symbol=F.col("c") > 1, symbols_per_precursor=F.col("d") > 1)
    return r.select("gene", "precursor", F.when(why == "", "high").otherwise("ambiguous").alias("confidence"), why.alias("reasons")).distinct()


def gated(rows: DataFrame, audit: DataFrame, accepted: list[str]) -> DataFrame:
    """Rows whose source has an accepted audit status."""
    return rows.join(audit.where(F.col("status").isin(accepted)).select("source").distinct(), "source", "left_semi")


def with_refs(rows: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    """rows with the sorted list of their side-table references; none gives an empty list."""
    cols = [c for c in refs.columns if c != key]
    g = refs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("refs"))
    return rows.join(g, key, "left").withColumn("refs", F.coalesce("refs", F.array().cast(g.schema["refs"].dataType)))


def long_cells(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """Wide columns of one prefix as (key, column, filled): which cells hold anything."""
    cols = [c for c in rows.columns if c.startswith(prefix)]
    long = rows.select(key, *(F.col(c).cast("string").alias(c) for c in cols)).unpivot([key], cols, "column", "value")
    return long.groupBy("column").agg(F.count_if(N.clean(F.col("value")).isNotNull()).alias("filled"), F.count(F.lit(1)).alias("n"))
