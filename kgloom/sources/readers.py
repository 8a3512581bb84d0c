"""Reading tables and text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .export import content_digest


def select_available(df: DataFrame, want: list[str]) -> DataFrame:
    """The wanted columns; those the table lacks are null strings."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in want))


def bounded(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows offset..offset+limit in the order of a key; file order is no guarantee."""
    return df.orderBy(*order).offset(offset).limit(limit)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows, n_columns) of each table; only counts are read."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        out = row if out is None else out.unionAll(row)
    return out


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows, schema_hash, content_digest): the inventory with a hash of each table's column names and types, and the
    order-free digest of its rows (export.content_digest)."""
    out = None
    for name, df in tables.items():
        row = content_digest(df).select(F.lit(name).alias("name"), "n_rows", F.sha2(F.lit(",".join(f"{c} {t}" for c, t in df.dtypes)), 256).alias("schema_hash"), F.col("digest").alias("content_digest"))
        out = row if out is None else out.unionAll(row)
    return out


def key_columns(df: DataFrame) -> list[str]:
    """The key that a table's columns imply: edge_key, the edge identity, node_id or id."""
    have = set(df.columns)
    return next((k for k in (["edge_key"], ["relation", "x_id", "y_id"], ["node_id"], ["id"]) if set(k) <= have), [])


def delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = True) -> DataFrame:
    return spark.read.csv(path, schema=schema, sep=sep, header=header, nullValue="-")


def stanzas(spark: SparkSession, path: str, kind: str = "Term") -> DataFrame:
    """Blank-line stanzas of `key: value` lines: (id, fields map of key to values). Each stanza is one record of the scan."""
    # Lines may end in \r\n: a blank line is then cut inside, and a lone \r goes with its line.
    whole = spark.read.text(path, lineSep="\n[").select(F.regexp_replace("value", "\r", "").alias("value"))
    whole = whole.select(F.when(F.startswith("value", F.lit("[")), F.col("value")).otherwise(F.concat(F.lit("["), "value")).alias("value"))
    s = whole.where(F.startswith("value", F.lit(f"[{kind}]"))).select(F.substring_index("value", "\n\n", 1).alias("value"))
    pairs = F.transform(F.filter(F.split("value", "\n"), lambda x: F.contains(x, F.lit(": "))), lambda x: F.struct(F.substring_index(x, ": ", 1).alias("key"), F.regexp_replace(x, "^[^:]+: ", "").alias("val")))
    keyed = s.select(F.regexp_extract("value", r"(?m)^id: (\S+)", 1).alias("id"), pairs.alias("pairs"))
    return keyed.select("id", F.map_from_entries(F.transform(F.array_distinct(F.transform("pairs", lambda p: p["key"])), lambda k: F.struct(k, F.transform(F.filter("pairs", lambda p: p["key"] == k), lambda p: p["val"])))).alias("fields"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, description, sequence) of records that begin with `>` at the start of a line; a `>` elsewhere is text."""
    r = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("value")).where(F.trim("value") != "")
    head = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "")
    return r.select(F.regexp_extract(head, r"^(\S+)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"), body.alias("sequence"))


def attributes(df: DataFrame, column: str) -> DataFrame:
    """df with `attrs`: the map of `key "value";` pairs of an attribute column."""
    items = F.regexp_extract_all(column, F.lit(r'(\w+) "[^"]*"'), F.lit(1))
    vals = F.regexp_extract_all(column, F.lit(r'\w+ "([^"]*)"'), F.lit(1))
    first = F.filter(F.transform(items, lambda k, i: F.when(F.array_position(items, k) == i + 1, F.struct(k.alias("k"), F.element_at(vals, i + 1).alias("v")))), lambda x: x.isNotNull())
    return df.withColumn("attrs", F.map_from_entries(first))


def legacy_edges(spark: SparkSession, path: str) -> DataFrame:
    """The legacy comma-separated edge list, with its line order in `seq`."""
    return spark.read.csv(path, header=True, schema="x_type string, x_id string, relation string, y_type string, y_id string").withColumn("seq", F.monotonically_increasing_id())
