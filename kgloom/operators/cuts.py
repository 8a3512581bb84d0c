"""Cutting lineage: results that later jobs must see alike, written once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, named by spark.checkpoint.dir.

    In local mode, where driver and executors share a machine, a temporary one is set if there is none; elsewhere its absence
    is an error.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="kgloom-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept as a table of compressed columns in the checkpoint folder. Later readers take the columns
    they need; rows may come in other partitions than df's."""
    if any(isinstance(f.dataType, NullType) for f in df.schema):
        # Parquet has no such column.
        shared_folder(df.sparkSession)
        return df.checkpoint()
    path = scratch(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
