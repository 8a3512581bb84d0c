"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir), calls one operator of kgloom.llm on all that its predecessor kept, and returns a
DataFrame; all but the last return the columns of documents. run() writes each stage's result to the shared folder and
reads it back as the next one's docs. Python workers are reused from stage to stage, two or more beside an executor's heap, so
each stage gets its rows in Arrow batches of bounded bytes, not of 10,000 texts whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from kgloom.llm import byte_bpe, decontamination, language_id, line_dedup, near_dedup
from kgloom.llm.storage import materialize


#: Bytes of a batch of rows on its way to a Python worker and back; rows are never cut.
BATCH_BYTES = "4m"


def bounded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, run with Arrow batches of about BATCH_BYTES. The setting stays: the result is computed after the call."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the labelled ones show, go."""
    return language_id.keep_recognised(docs, language_id.fit(docs.where(~language_id.held_out())))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines stay in their first document only."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more."""
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: the number and digest of its token ids, and the digest of the bytes that they decode to."""
    return byte_bpe.code_digests(docs)


STAGES = [(name, bounded(f)) for name, f in (("language_id", languages), ("line_dedup", lines), ("near_dedup", near_duplicates), ("decontamination", benchmark), ("byte_bpe", tokens))]

#: Language ID is learned; no SQL gives its rows. tests/llm checks each stage on planted cases and its operator by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
