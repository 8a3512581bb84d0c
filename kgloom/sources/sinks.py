"""Writing tables: keep-last nodes, merged edges, validated features, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.credibility import KEY, dedup_edges
from ..operators.evidence import keep_last
from .export import content_digest


def merged_nodes(stored: DataFrame | None, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Stored and new nodes, all columns text, the last row of each id kept; stored rows come before new ones."""
    both = new.withColumn("__batch", F.lit(1))
    if stored is not None:
        both = stored.withColumn("__batch", F.lit(0)).unionByName(both, allowMissingColumns=True)
    both = both.where("id is not null").withColumn("__seq", F.struct("__batch", F.coalesce(F.col(seq), F.lit(0))))
    out = keep_last(both, ["id"], "__seq").drop("__seq", "__batch", seq)
    return out.select(*(F.col(c).cast("string").alias(c) for c in out.columns))


def merged_edges(stored: DataFrame | None, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Stored and new edges after the edge dedup over both; stored rows come first.

    A stored row may hold several sources, comma-joined: each counts as an assertion of its own, in its order, and the stored
    credibility is the least that the result can have. Which papers and authors a stored score came from is not in the row;
    where that matters, append assertions (streaming.append) and derive the edges from them.
    """
    if stored is None:
        return dedup_edges(new, seq)
    each = stored.select(*(c for c in stored.columns if c not in ("source", seq)), F.posexplode_outer(F.split("source", ",")).alias("__at", "source"))
    each = each.withColumn(seq, F.struct(F.lit(0).alias("batch"), F.coalesce("__at", F.lit(0)).cast("long").alias("at"))).drop("__at")
    late = new.withColumn(seq, F.struct(F.lit(1).alias("batch"), F.col(seq).cast("long").alias("at")))
    out = dedup_edges(each.unionByName(late, allowMissingColumns=True), seq)
    floor = stored.groupBy(*KEY).agg(F.max("credibility").alias("__least"))
    return out.join(floor, KEY, "left").withColumn("credibility", F.greatest("credibility", "__least")).select(*out.columns)


def write_new(df: DataFrame, path: str, *partition: str) -> None:
    """A whole new table directory; the caller swaps it in, so readers never see half a table."""
    df.write.mode("errorifexists").partitionBy(*partition).parquet(path)


def without_source(edges: DataFrame, source: str) -> DataFrame:
    """Rows of other sources; a null source stays."""
    return edges.where(~F.coalesce(F.col("source") == source, F.lit(False)))


def validated(df: DataFrame, fault, out: str) -> DataFrame:
    """Writes the rows without a fault to out/accepted, the others with their fault to out/rejected, in one table write, and
    returns the counts (part, fault, n_rows) of what was written. `fault` is a column: null for a good row, else its reason."""
    part = F.when(F.col("__fault").isNull(), "accepted").otherwise("rejected")
    df.withColumn("__fault", fault).withColumn("part", part).withColumnRenamed("__fault", "fault").write.mode("errorifexists").partitionBy("part").parquet(out)
    written = df.sparkSession.read.parquet(out)
    return written.groupBy("part", F.coalesce("fault", F.lit("")).alias("fault")).agg(F.count(F.lit(1)).alias("n_rows"))


def export(layers: dict[str, dict[str, DataFrame]], out: str, version: str) -> DataFrame:
    """Writes layers of named tables below out/version and their receipt, a row a table, which is returned: layer, name,
    n_rows, n_columns, schema_sha256, content_digest, total_rows (of the layer) and the provenance fields version and format.

    The rows are counted, and their digest taken, from what was written. A version that is there already is an error, so no export is half replaced.
    """
    done = None
    for layer, tables in layers.items():
        for name, df in tables.items():
            path = f"{out}/{version}/{layer}/{name}"
            df.write.mode("errorifexists").parquet(path)
            row = content_digest(df.sparkSession.read.parquet(path)).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.sha2(F.lit(",".join(f"{c} {t}" for c, t in df.dtypes)), 256).alias("schema_sha256"), F.col("digest").alias("content_digest")
            )
            done = row if done is None else done.unionAll(row)
    totals = done.groupBy("layer").agg(F.sum("n_rows").alias("total_rows"))
    receipt = done.join(totals, "layer").withColumns({"version": F.lit(version), "format": F.lit("parquet")})
    receipt.coalesce(1).write.mode("errorifexists").json(f"{out}/{version}/receipt")
    return done.sparkSession.read.schema(receipt.schema).json(f"{out}/{version}/receipt")
