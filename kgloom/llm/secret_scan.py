"""Secret scans (operator 5), DataFrame functions only: an incremental ledger of content-addressed blobs.

Each version of a path is a blob, addressed by the SHA-256 of its text. The ledger holds, for each pair of blob and rule
version, the findings of one scan. A run scans only pairs that the ledger has not, appends them, and joins findings back to
every path. A new rule version leaves old entries alone.

Positions come from the pieces between matches: a match starts after all pieces and matches before it, so a running sum
over them gives code-point offsets in time linear in the matches.

Defined results: a null text is an empty blob; rows that repeat keep their own result row; an empty table gives no rows and
no entries; pairs that the ledger holds twice, as two runs at once can leave them, count once; extra columns are kept, but
for any named blob or spans, which the results replace.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window as W, functions as F

from .storage import new_path

# The rules by kind, in the order in which kinds are listed: pattern, group whose length counts, least length.
# A run of hex digits or of an access key is maximal, so its least length can stand in the pattern; an assignment whose
# value is short still consumes its text, so it is matched first and dropped afterwards.
RULES = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]


def scan(blobs: DataFrame) -> DataFrame:
    """(blob, spans) of blobs (blob, text), all rules in one pass; spans are structs (start, kind, end), kind an index into
    RULES. Blobs in which nothing is found have no row."""
    hits = []
    for k, (_, pattern, group, _) in enumerate(RULES):
        found = F.struct(
            F.lit(k).alias("kind"), F.split("text", pattern, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("all"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("part"),
        )
        hits.append(F.when(F.col("text").rlike(pattern), found))
    each = blobs.select("blob", F.explode(F.array_compact(F.array(*hits))).alias("hit"))
    each = each.select("blob", "hit.kind", F.posexplode(F.arrays_zip("hit.gaps", "hit.all", "hit.part")).alias("i", "x")).select(
        "blob", "kind", "i", F.length("x.gaps").alias("gap"), F.coalesce(F.length("x.all"), F.lit(0)).alias("len"), F.coalesce(F.length("x.part"), F.lit(-1)).alias("value")
    )
    upto = W.partitionBy("blob", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    least = F.element_at(F.array(*(F.lit(r[3]) for r in RULES)), F.col("kind") + 1)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).where(F.col("value") >= least)
    span = F.struct((F.col("end") - F.col("len")).alias("start"), "kind", "end")
    return each.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


SPANS = "array<struct<start: bigint, kind: int, end: bigint>>"


def scan_history(versions: DataFrame, ledger: str, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """versions with columns blob and spans added (replaced, if there are such); ledger is the path of the ledger table,
    created when missing.

    Only blobs without an entry for this rule version are scanned; their entries are appended, whether or not anything
    was found.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    schema = f"blob string, rule_version string, spans {SPANS}"
    known = _ledger(spark, ledger, schema)
    if known is not None:
        keyed = keyed.join(known.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    fresh = keyed.dropDuplicates(["blob"])
    # A blob enters the ledger as seen in any case; its spans are rows of their own.
    kept = new_path(spark, "blobs")
    fresh.select("blob", "text").write.parquet(kept)
    unseen = spark.read.schema("blob string, text string").parquet(kept)
    entries = unseen.select("blob").join(scan(unseen), "blob", "left")
    entries.select("blob", F.lit(rule_version).alias("rule_version"), F.coalesce(F.col("spans").cast(SPANS), F.array().cast(SPANS)).alias("spans")).write.mode("append").parquet(ledger)
    entries = _ledger(spark, ledger, schema).where(F.col("rule_version") == rule_version).groupBy(F.col("blob").alias("__blob")).agg(F.first("spans").alias("__spans"))
    out = versions.withColumn("__key", F.sha2(text, 256)).join(entries, F.col("__key") == F.col("__blob"), "left")
    mine = [c for c in versions.columns if c not in ("blob", "spans")]
    return out.select(*mine, F.col("__key").alias("blob"), F.col("__spans").alias("spans"))


def _ledger(spark, path: str, schema: str) -> DataFrame | None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.schema(schema).parquet(path) if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) else None


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = scan_history(docs, new_path(spark, "ledger")).select("doc_id", "spans")
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    names = F.array(*(F.lit(r[0]) for r in RULES))
    said = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    out = out.withColumn("said", said)
    return out.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2("said", 256).alias("base_sha256"), F.col("said").alias("spans"))
