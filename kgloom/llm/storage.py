"""Tables that outlive lost executors: written once to the shared folder that the session names."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, in local mode only, one temporary folder for the session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.kgloom.scratch", None)
    if not found:
        # In local mode driver and executors share one machine; on a cluster each would write to a disk of its own.
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="kgloom-")
        spark.conf.set("spark.kgloom.scratch", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/kgloom/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """df as a Parquet table: its lineage is cut, later readers prune columns, and each row is computed once."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kgloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize made and that nothing reads any more; other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "kgloom_path", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


#: Bits of a filter: eight megabytes, whatever it holds.
BLOOM_BITS = 1 << 26


def bloom(df: DataFrame, col: str) -> np.ndarray:
    """A Bloom filter, as 32-bit words, of a column of hashes; its words reach the driver, BLOOM_BITS / 32 rows at most."""
    pos = F.pmod(F.col(col), F.lit(BLOOM_BITS))
    rows = df.select(F.shiftright(pos, 5).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod({col}, 32) as int))").alias("m")).groupBy("w").agg(F.expr("bit_or(m)").alias("m")).toArrow()
    bits = np.zeros(BLOOM_BITS // 32, dtype=np.uint32)
    if rows.num_rows:
        bits[rows["w"].to_numpy()] = rows["m"].to_numpy()
    return bits


def passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the hashes (unsigned) the filter lets through."""
    return (bits[(h & np.uint64(BLOOM_BITS - 1)) >> np.uint64(5)] >> (h & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)


def likely(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """df less rows whose id is certainly not in ids (id): what a join would drop anyway needn't be shuffled.

    A filter of fixed size goes to the scan; as it fills up, more rows pass, none is lost.
    """
    hashed = ids.select(F.xxhash64("id").alias("h"))
    shared = df.sparkSession.sparkContext.broadcast(bloom(hashed, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("__h").to_numpy().view(np.uint64)
            yield b.drop_columns(["__h"]).filter(pa.array(passes(h, shared.value)))

    schema = df.schema
    return df.withColumn("__h", F.xxhash64(id_col)).mapInArrow(run, schema)
