"""Benchmark decontamination (operator 4): prefix-filtered set join of document shingles and item-sized windows.

Words are runs of ASCII letters (lower-cased), digits and bytes beyond ASCII. A window is `size` consecutive words of an
item; an item of fewer words is one window. A window's set holds its shingles of up to four words. All shingles of the
benchmark are counted over all documents and ordered by rarity; a window can only occur where the first shingle of that
order, its necessary prefix, occurs. Occurrences are found by an equi-join on prefix shingles; the offset of the shingle
in the window bounds where a window can start, the window's length bounds where it can end, and what is left is verified
word by word. Windows with a shingle that no document has are dropped: they cannot occur.

A Bloom filter of fixed size keeps positions that cannot match from leaving the scan; it never drops a match.

Defined results: null and empty texts have no words; repeated items give one window with several owners; items with a null
id count for hits, not for items; rows that share an id but not the text are judged each by itself, repeated rows alike;
extra columns are ignored by `contamination` and kept by `decontaminate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .storage import bloom, materialize, passes
from .textops import ALNUM, column, ngrams, signed, words

SHINGLE = 4
#: Prefix shingles up to this many are broadcast to the join; beyond it both sides are shuffled.
BROADCAST_ROWS = 100_000


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("item_id").to_pylist()
            out: dict[str, list] = {"item_id": [], "win": [], "n": [], "grams": []}
            for w in words(column(b, "text"), ALNUM):
                for r in range(w.n):
                    lo, hi = int(w.bounds[r]), int(w.bounds[r + 1])
                    if lo == hi:
                        continue
                    n = min(size, hi - lo)
                    s = min(n, SHINGLE)
                    g = ngrams(w.h[lo:hi], s).view(np.int64)
                    text = [w.text(i).decode() for i in range(lo, hi)]
                    for at in range(hi - lo - n + 1):
                        out["item_id"].append(ids[w.row0 + r])
                        out["win"].append(" ".join(text[at : at + n]))
                        out["n"].append(n)
                        out["grams"].append(g[at : at + n - s + 1].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.string()), pa.array(out["win"], pa.string()), pa.array(out["n"], pa.int32()), pa.array(out["grams"], pa.list_(pa.int64()))], list(out))

    return run


def _positions(w, sizes: list[int], bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(s, word positions, shingles) of s-word shingles inside one row that pass the filter."""
    left = np.repeat(w.bounds[1:], np.diff(w.bounds)) - np.arange(len(w.h))
    for s in sizes:
        g = ngrams(w.h, s)
        at = np.flatnonzero(passes(g, bits) & (left[: len(g)] >= s))
        yield s, at, g[at]


def _count(sizes: list[int], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(column(b, "text"), ALNUM):
                for _, _, g in _positions(w, sizes, shared.value):
                    u, n = np.unique(g, return_counts=True)
                    yield pa.RecordBatch.from_arrays([signed(u), pa.array(n, pa.int64())], ["gram", "n"])

    return run


def _find(sizes: list[int], size: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("p", pa.int32()), ("gram", pa.int64()), ("lo", pa.int32()), ("ctx", pa.string())]))
        for b in batches:
            for w in words(column(b, "text"), ALNUM):
                found: list[list | None] = [None] * w.n
                rows = np.repeat(np.arange(w.n), np.diff(w.bounds))
                for s, at, g in _positions(w, sizes, shared.value):
                    for i, x in zip(at.tolist(), g.view(np.int64).tolist()):
                        r = rows[i]
                        first, last = int(w.bounds[r]), int(w.bounds[r + 1])
                        lo, hi = max(first, i - size + 1), min(last, i + size)
                        ctx = " ".join(w.text(k).decode() for k in range(lo, hi))
                        if found[r] is None:
                            found[r] = []
                        found[r].append({"p": i - first, "gram": x, "lo": lo - first, "ctx": ctx})
                yield pa.RecordBatch.from_arrays([b.column(c).slice(w.row0, w.n) for c in ("row", "id")] + [pa.array(np.diff(w.bounds), pa.int64()), pa.array(found, kind)], ["row", "id", "n_words", "hits"])

    return run


def _judged(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Per document: row (a hash of id and text), id, n_words, n_hit, items, n_items, contaminated."""
    spark = docs.sparkSession
    src = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    owned = materialize(items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_windows(size), "item_id string, win string, n int, grams array<long>"), "windows")
    wins = owned.dropDuplicates(["win"]).select("win", "n", "grams")
    sizes = sorted(r[0] for r in wins.select(F.least("n", F.lit(SHINGLE)).alias("s")).distinct().collect())
    grams = wins.select("win", "n", F.posexplode("grams").alias("off", "gram"))
    # Rarity: how often each of the benchmark's shingles occurs in all documents.
    every = spark.sparkContext.broadcast(bloom(grams, "gram"))
    counts = src.select("text").mapInArrow(_count(sizes, every), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("freq"))
    ranked = grams.join(counts, "gram", "left").groupBy("win", "n").agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "gram", "off")).alias("x"))
    prefix = materialize(ranked.where("x.freq > 0").select("win", "n", F.col("x.gram").alias("gram"), F.col("x.off").alias("off")), "prefix")
    probe = spark.sparkContext.broadcast(bloom(prefix, "gram"))
    table = src.mapInArrow(_find(sizes, size, probe), T_FOUND.format(dict(src.dtypes)["id"]))
    table = materialize(table, "hits")
    side = F.broadcast(prefix) if prefix.count() <= BROADCAST_ROWS else prefix
    hits = table.where("hits is not null").select("row", "n_words", F.explode("hits").alias("h")).select("row", "n_words", "h.*")
    at = hits.join(side, "gram").withColumn("start", F.col("p") - F.col("off")).where("start >= 0 and start >= lo and start + n <= n_words")
    at = at.where(F.array_join(F.slice(F.split("ctx", " "), F.col("start") - F.col("lo") + 1, F.col("n")), " ") == F.col("win"))
    occ = materialize(at.select("row", "win", "start", (F.col("start") + F.col("n")).alias("end")), "occurrences")
    # Words covered: each interval adds what lies beyond the farthest end of those before it in its document.
    spans = occ.select("row", "start", "end").distinct()
    before = W.partitionBy("row").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("far", F.coalesce(F.max("end").over(before), F.lit(0)))
    n_hit = spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "far"))).alias("n_hit"))
    owners = occ.select("row", "win").distinct().join(owned.select("win", "item_id").distinct(), "win").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    out = table.select("row", "id", "n_words").join(n_hit, "row", "left").join(owners, "row", "left")
    out = out.select("row", "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted ids as strings), n_items, contaminated."""
    return _judged(docs, items, id_col, text_col, size).drop("row").withColumnRenamed("id", id_col)


T_FOUND = "row long, id {}, n_words long, hits array<struct<p: int, gram: long, lo: int, ctx: string>>"


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """The documents, with all their columns, that aren't contaminated."""
    bad = _judged(docs, items, id_col, text_col, size).where("contaminated").select(F.col("row").alias("__bad")).distinct()
    return docs.join(bad, F.xxhash64(id_col, text_col) == F.col("__bad"), "left_anti")


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = contamination(docs, items)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
