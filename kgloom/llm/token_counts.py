"""Token counts (operator 6): a digest cache.

A text's content is normalised (null: empty; else a column expression, identity by default since the byte-level tokenizer
has no normaliser) and addressed by its SHA-256; the tokenizer by the SHA-256 of its file. Counts are stored under both
digests. A run joins the two digests to the stored counts, encodes each distinct missing content once, appends the counts
and joins them to every row.

Defined results: null and empty texts have no bytes and no tokens; repeated rows and texts are encoded once and keep their
rows; an empty table gives no rows; counts that the cache holds twice, as two runs at once can leave them, count once; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .secret_scan import _ledger
from .storage import new_path
from .textops import column
from .units import Remembered, pieces

_encoders: dict[str, Callable[[list[str]], list[int]]] = {}


def counter(name: str) -> Callable[[list[str]], list[int]]:
    """Counts tokens as the library for the named file does; loaded once per Python worker."""
    if name in _encoders:
        return _encoders[name]
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    else:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        batch = lambda texts: [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)]
        if "ByteLevel(add_prefix_space=False" in repr(t.pre_tokenizer) and t.normalizer is None and not any(" " in str(x.content) or x.lstrip or x.rstrip for x in t.get_added_tokens_decoder().values()):
            first, later = Remembered(lambda p: batch([p])[0]), Remembered(lambda p: batch([" " + p])[0])

            def count(texts: list[str]) -> list[int]:
                parts = [pieces(x) for x in texts]
                new = list({p for x in parts for p in x[1:] if len(p) <= later.LONGEST and p not in later})
                if len(later) + len(new) > later.MOST:
                    later.clear()
                    new = list({p for x in parts for p in x[1:] if len(p) <= later.LONGEST})
                later.update(zip(new, batch([" " + p for p in new])))
                return [first[x[0]] + sum([later[p] for p in x[1:]]) for x in parts]
        else:
            count = batch
    return _encoders.setdefault(name, count)


def _encode(name: str, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(name)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                n = count(column(part, "text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("content"), pa.array([tokenizer] * len(n), pa.string()), pa.array(n, pa.int64())], ["content", "tokenizer", "n_tokens"])

    return run


def token_counts(docs: DataFrame, name: str, cache: str, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(id, n_bytes, n_tokens) per row; name is a file of public_tokenizers, cache the path of the table of counts."""
    spark = docs.sparkSession
    with open(public_tokenizers.path(name), "rb") as f:
        tokenizer = hashlib.sha256(f.read()).hexdigest()
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("content"))
    todo = docs.select(F.sha2(text, 256).alias("content"), text.alias("text"))
    schema = "content string, tokenizer string, n_tokens long"
    known = _ledger(spark, cache, schema)
    if known is not None:
        todo = todo.join(known.where(F.col("tokenizer") == tokenizer).select("content"), "content", "left_anti")
    todo.dropDuplicates(["content"]).mapInArrow(_encode(name, tokenizer), schema).write.mode("append").parquet(cache)
    stored = _ledger(spark, cache, schema).where(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.first("n_tokens").alias("n_tokens"))
    return rows.join(stored, "content", "left").select(id_col, "n_bytes", "n_tokens")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = token_counts(docs, "byte_bpe_50k.json", new_path(spark, "token-counts"))
    return out.withColumn("over_limit", F.col("n_tokens") > 512)
