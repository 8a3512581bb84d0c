"""Exports that can be verified: digests of contents and of sequences, an indexed graph export and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.graph import dense_index, edge_index, reversed_edges

#: Values of a block, and levels of blocks: up to BLOCK ** LEVELS values have one digest.
BLOCK, LEVELS = 4096, 4


def canonical(df: DataFrame, column: str) -> Column:
    """A column's value as text that says where it ends: its length, a colon and the value; null is a lone minus."""
    c, kind = F.col(column), df.schema[column].dataType
    text = F.unix_micros(c.cast("timestamp")).cast("string") if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else F.base64(c) if isinstance(kind, T.BinaryType) else c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def content_digest(df: DataFrame) -> DataFrame:
    """One row (n_rows, digest): a digest of the rows as a multiset. The md5 of a row's canonical text is cut into three
    numbers, which are summed up over all rows: the order of rows and partitions doesn't matter, a row that stands twice
    counts twice. One aggregate with partial sums; empty tables have sums of 0."""
    row = F.md5(F.concat(*(canonical(df, c) for c in df.columns)))
    part = lambda at, n: F.coalesce(F.sum(F.conv(F.substring(row, at, n), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", part(1, 11), part(12, 11), part(23, 10)).alias("digest"))


def sequence_digests(df: DataFrame, group: str, value: str, place: str) -> DataFrame:
    """(group, n, digest) of the values of each group in the order of their places 0, 1, 2, ...: a list of hashes over blocks of
    4,096 neighbours, hashed again in blocks, four times, so that no task holds more than a block and the digest depends on
    the sequence only, not on partitions. A null value counts as such."""
    rows = df.select(F.col(group).alias("g"), F.col(place).cast("long").alias("p"), F.coalesce(F.concat(F.lit("="), F.col(value).cast("string")), F.lit("null")).alias("v"), F.lit(1).cast("long").alias("n"))
    for _ in range(LEVELS):
        held = F.transform(F.array_sort(F.collect_list(F.struct("p", "v"))), lambda x: x["v"])
        rows = rows.groupBy("g", F.expr(f"p div {BLOCK}").alias("q")).agg(F.sha2(F.array_join(held, "\n"), 256).alias("v"), F.sum("n").alias("n")).select("g", F.col("q").alias("p"), "v", "n")
    return rows.select(F.col("g").alias(group), "n", F.col("v").alias("digest"))


def indexed_export(nodes: DataFrame, edges: DataFrame, out: str, exclude: tuple[str, ...] = ("paper",)) -> DataFrame:
    """Writes the graph with dense indexes below `out` and returns the validation report, which is written there, too.

    out/nodes holds (node_type, id, index), out/edges (relation, x_id, y_id, src, dst) with reverse relations, partitioned by
    type and relation; node types in `exclude` (provenance by default) and their edges are left out. The report has a row a
    node type, with the digest of its id sequence, and a row a relation, with the content digest of its edges: part, name,
    n_rows, digest, issue. Issues: `duplicate_ids:<n>`, `null_ids:<n>`, `dangling_edges:<n>` (edges with an end that is no node,
    which aren't written); null where there is none. Rows are counted from what was written.
    """
    spark = nodes.sparkSession
    n = nodes.where(~F.col("node_type").isin(*exclude))
    dense_index(n).write.mode("errorifexists").partitionBy("node_type").parquet(f"{out}/nodes")
    index = spark.read.parquet(f"{out}/nodes").select("node_type", "id", "index")
    kept = edges.where(~F.col("x_type").isin(*exclude) & ~F.col("y_type").isin(*exclude))
    mapped = edge_index(reversed_edges(kept.select("x_id", "x_type", "y_id", "y_type", "relation")), index).select("relation", "x_id", "y_id", "src", "dst")
    mapped.withColumn("part", F.when(F.col("src").isNull() | F.col("dst").isNull(), "dangling").otherwise("edges")).write.mode("errorifexists").partitionBy("part", "relation").parquet(f"{out}/graph")
    written = spark.read.parquet(f"{out}/graph")
    rows = n.groupBy("node_type").agg(F.count("id").alias("__all"), F.count_if(F.col("id").isNull()).alias("__null"))
    report = _node_digests(index).join(rows, F.col("name") == F.col("node_type"), "full")
    many = lambda what, c: F.when(c > 0, F.concat(F.lit(f"{what}:"), c.cast("string")))
    blank = lambda c: F.when(c == "", F.lit(None).cast("string")).otherwise(c)
    told = blank(F.concat_ws(",", many("null_ids", F.col("__null")), many("duplicate_ids", F.col("__all") - F.coalesce("n_rows", F.lit(0)))))
    report = report.select(F.lit("nodes").alias("part"), F.coalesce("name", "node_type").alias("name"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "digest", told.alias("issue"))
    lost = written.where("part = 'dangling'").groupBy(F.col("relation").alias("__rel")).agg(F.count(F.lit(1)).alias("__lost"))
    pairs = _edge_digests(written.where("part = 'edges'")).join(lost, F.col("name") == F.col("__rel"), "full")
    pairs = pairs.select(F.lit("edges").alias("part"), F.coalesce("name", "__rel").alias("name"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "digest", blank(F.coalesce(many("dangling_edges", F.col("__lost")), F.lit(""))).alias("issue"))
    report.unionByName(pairs).coalesce(1).write.mode("errorifexists").json(f"{out}/report", ignoreNullFields=False)
    return spark.read.schema(REPORT).json(f"{out}/report")


REPORT = "part string, name string, n_rows long, digest string, issue string"


def _node_digests(index: DataFrame) -> DataFrame:
    return sequence_digests(index, "node_type", "id", "index").toDF("name", "n_rows", "digest")


def _edge_digests(edges: DataFrame) -> DataFrame:
    """The multiset digest of (x_id, y_id, src, dst) a relation."""
    cols = edges.select("x_id", "y_id", "src", "dst")
    row = F.md5(F.concat(*(canonical(cols, c) for c in cols.columns)))
    part = lambda at, n: F.sum(F.conv(F.substring(row, at, n), 16, 10).cast("decimal(38,0)")).cast("string")
    return edges.groupBy(F.col("relation").alias("name")).agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", part(1, 11), part(12, 11), part(23, 10)).alias("digest"))


def verify_export(spark: SparkSession, out: str) -> DataFrame:
    """The report's rows whose table now has another number of rows or another digest, as (part, name, said, found)."""
    said = spark.read.schema(REPORT).json(f"{out}/report").where("n_rows > 0").select("part", "name", F.concat_ws(" ", F.col("n_rows").cast("string"), "digest").alias("said"))
    index = spark.read.parquet(f"{out}/nodes").select("node_type", "id", "index")
    now = _node_digests(index).withColumn("part", F.lit("nodes")).unionByName(_edge_digests(spark.read.parquet(f"{out}/graph").where("part = 'edges'")).withColumn("part", F.lit("edges")))
    now = now.select("part", "name", F.concat_ws(" ", F.col("n_rows").cast("string"), "digest").alias("found"))
    return said.join(now, ["part", "name"], "full").where(~F.col("said").eqNullSafe(F.col("found")))
