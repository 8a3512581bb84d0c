"""MinHash near-dedup (operator 3): HyperMinHash registers, banded and collision-corrected, then full verification.

A document's set holds its distinct n-word shingles. Each set is hashed once; a hash's high half picks one of K buckets,
and a bucket keeps its least low half as a 16-bit register: the count of leading zeros and ten mantissa bits. Bands of
registers are the candidate keys: at a Jaccard similarity of 0.85 a pair of large sets shares no band with probability
(1 - 0.85**7)**36 < 1e-6. Small sets give their first n - ceil(t * n) + 1 hashes, those of rare words first, as keys, of
which a pair at the threshold always shares one. The share of equal registers, corrected for chance collisions, estimates
the similarity; what may reach the threshold is verified on the full sets.

Defined results: null and empty texts, and texts without words, have an empty set and link with nothing; equal sets are
collapsed first, so groups of exact copies cost one row each; ids may be of any type that has an order; repeated rows (id
and text alike) act as one document, rows that share an id but not the text are compared each by itself; rows whose id is
null keep a null component and are kept; extra columns are ignored by `near_duplicates` and kept by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .linking import Likeness, link_groups, shared_buckets
from .storage import discard, likely, materialize
from .textops import SPACED, U, column, levels_of, mix, ngrams, ordered, shingle_set, signed, word_levels, words

K, MANTISSA = 252, 10
#: Chance that two different minima give one register, for sets much larger than K.
COLLISION = 0.1699 * 2.0**-MANTISSA


def registers(s: np.ndarray, row: np.ndarray | int = 0, rows: int = 1) -> np.ndarray:
    """The K compressed registers of each row; s holds the rows' sorted distinct hashes, row by row. An empty bucket is 0."""
    out = np.zeros(rows * K, dtype=np.uint16)
    if len(s):
        bucket = ((s >> U(32)) * U(K) >> U(32)).astype(np.int64) + row * K
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        low = np.minimum.reduceat(s & U(0xFFFFFFFF), first)
        bits = np.frexp(low.astype(np.float64))[1]
        zeros = 32 - bits
        mantissa = (low << zeros.astype(U) & U(0x7FFFFFFF)) >> U(31 - MANTISSA)
        out[bucket[first]] = ((zeros + 1) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    return out


def _matrix(col) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint16).reshape(-1, K)


def estimate(equal: np.ndarray, union: np.ndarray) -> np.ndarray:
    """Jaccard similarity from equal and non-empty registers, less the collisions expected by chance."""
    return np.clip((equal / np.maximum(union, 1) - COLLISION) / (1 - COLLISION), 0, 1)


def scorer(threshold: float):
    def score(x: np.ndarray, y: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
        if not cross:
            equal, union = ((x == y) & (x > 0)).sum(axis=1), ((x > 0) | (y > 0)).sum(axis=1)
        else:
            equal, union = np.zeros((len(x), len(y))), np.zeros((len(x), len(y)))
            for at in range(0, len(x), 16):
                p, q = x[at : at + 16, None, :], y[None, :, :]
                equal[at : at + 16] = ((p == q) & (p > 0)).sum(axis=2)
                union[at : at + 16] = ((p > 0) | (q > 0)).sum(axis=2)
        # Five standard deviations of the estimate at the threshold.
        return estimate(equal, union), threshold - 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(union, 1))

    return score


def preparer(shingle: int):
    def prepare(col) -> list[np.ndarray]:
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        return [shingle_set(w.h[w.bounds[i] : w.bounds[i + 1]], shingle) for w in words(col, SPACED) for i in range(w.n)]

    return prepare


def verifier(percent: int):
    """100 * intersection >= percent * union, on full sets."""

    def same(left, right, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        ok = np.zeros(len(i), dtype=bool)
        for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
            a, b = left[x], right[y]
            if len(a) and len(b) and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = np.concatenate([a, b])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                ok[k] = 100 * inter >= percent * (len(a) + len(b) - inter)
        return ok

    return same


def _ranked(h: np.ndarray, grams: np.ndarray, n: int, level: np.ndarray) -> np.ndarray:
    """Keys of the n-word shingles of word hashes h that put those of rare words first, then order by hash."""
    of = levels_of(level, h).astype(U)
    common = np.minimum(sum(of[k : k + len(grams)] for k in range(n)), U(255))
    return common << U(56) | grams >> U(8)


def _sketch(shingle: int, percent: int, shared):
    classes = Classes(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(column(b, "text"), SPACED):
                # Shingles of all rows at once; those that run over a row's end stand in no row's slice.
                grams = ngrams(w.h, shingle)
                spans = [(i, j, shingle) if j - i >= shingle else (i, j, j - i) for i, j in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist())]
                sets = [ordered(grams[i : j - n + 1]) if n == shingle else shingle_set(w.h[i:j], shingle) for i, j, n in spans]
                size = np.array([len(s) for s in sets], dtype=np.int64)
                flat, row = np.concatenate(sets), np.repeat(np.arange(w.n), size)
                sums = np.zeros((2, w.n), dtype=U)
                full = np.flatnonzero(size)
                if len(full):
                    begins = (np.cumsum(size) - size)[full]
                    sums[0, full] = np.add.reduceat(flat, begins)
                    sums[1, full] = np.add.reduceat(mix(flat ^ U(0x5851F42D4C957F2D)), begins)
                sk = registers(flat, row, w.n).tobytes()
                ends = np.arange(w.n + 1, dtype=np.int32) * 2 * K
                # Of A's n hashes ceil(t * n) at least are in any B linked to it, so the first of those both have is here.
                take = np.where(classes.small(size), size + percent * size // -100 + 1, 0) * (size > 0)
                low, ranked = [], _ranked(w.h, grams, shingle, shared.value)
                for k in np.flatnonzero(take).tolist():
                    i, j, n = spans[k]
                    key = ordered(ranked[i : j - n + 1]) if n == shingle else _ranked(w.h[i:j], ngrams(w.h[i:j], n), n, shared.value)
                    low.append(key[: take[k]])
                many = np.zeros(w.n, dtype=np.int64)
                many[take > 0] = [len(x) for x in low]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), signed(np.concatenate([np.zeros(0, dtype=U), *low])))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(w.row0, w.n) for c in ("key", "id")] + [pa.array(size), signed(sums[0]), signed(sums[1]), pa.Array.from_buffers(pa.binary(), w.n, [None, pa.py_buffer(ends), pa.py_buffer(sk)]), lists],
                    ["key", "id", "n_shingles", "set_a", "set_b", "sketch", "low"],
                )

    return run


def band_width(threshold: float) -> int:
    """The most registers a band may have for a miss, at the threshold, under one in a hundred thousand."""
    return next((r for r in (7, 6, 4, 3, 2) if (1 - threshold**r) ** (K // r) < 1e-5), 1)


class Classes:
    """Size classes: sizes of a linked pair are in one class or in neighbouring ones. From the class `first` on a pair at the
    threshold can have as many differing shingles as there are bands."""

    def __init__(self, threshold: float):
        self.bands, self.step = K // band_width(threshold), 1 / (threshold - 0.01)
        self.first = next(c for c in range(10_000) if int((1 - threshold) * 2 * self.step ** (c + 1) / (1 + threshold)) + 1 >= self.bands) if threshold < 1 else 0

    def of(self, size) -> np.ndarray:
        return np.floor(np.log(np.maximum(size, 1)) / np.log(self.step) + 1e-9).astype(np.int64)

    def small(self, size) -> np.ndarray:
        """Sets that give single hashes as keys: one class more than those that have no bands, for pairs across the border."""
        return self.of(size) <= self.first


def _bands(threshold: float, keep):
    """Candidate keys: the single hashes of small sets, and K / band_width bands of full registers of sets from the class
    below `first` on. Registers of small sets are mostly empty, so that a band could hold nothing that a pair shares."""
    classes = Classes(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_numpy()
            low = b.column("low")
            many = np.diff(low.offsets.to_numpy())
            if many.sum():
                key = mix(low.flatten().to_numpy().view(U) ^ U(0x2545F4914F6CDD1D))
                ok = keep(key)
                yield pa.RecordBatch.from_arrays([signed(key[ok]), pa.array(np.repeat(ids, many)[ok])], ["key", "id"])
            at = np.flatnonzero(classes.of(b.column("n_shingles").to_numpy()) + 1 >= classes.first)
            x = _matrix(b.column("sketch"))[at].astype(U)
            edges = np.arange(classes.bands + 1) * K // classes.bands
            for k in range(classes.bands):
                part = x[:, edges[k] : edges[k + 1]]
                acc = np.full(len(at), k + 1, dtype=U)
                for j in range(part.shape[1]):
                    acc = mix(acc ^ part[:, j]) + U(j)
                full = part.any(axis=1) & keep(acc)
                yield pa.RecordBatch.from_arrays([signed(acc[full]), pa.array(ids[at[full]])], ["key", "id"])

    return run


def _compared(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """One row per document: key (of id and text), id, n_shingles, component_id, n_links."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(F.xxhash64("id", "text").alias("key"), "id", "text")
    level = docs.sparkSession.sparkContext.broadcast(word_levels(src, SPACED))
    kind = dict(src.dtypes)["id"]
    table = materialize(src.mapInArrow(_sketch(shingle, percent, level), f"key long, id {kind}, n_shingles long, set_a long, set_b long, sketch binary, low array<long>"), "sketch")
    which = ["set_a", "set_b", "n_shingles"]
    sets = materialize(table.where("n_shingles > 0 and id is not null").groupBy(which).agg(F.min("key").alias("rep"), F.min("id").alias("least")), "sets")
    reps = sets.select(F.col("rep").alias("id")).distinct()
    sketches = table.select(F.col("key").alias("id"), "n_shingles", "sketch", "low", (8 * F.col("n_shingles")).alias("bytes"))
    sketches = materialize(sketches.join(reps, "id", "left_semi").dropDuplicates(["id"]), "reps")
    buckets = shared_buckets(sketches, lambda keep: _bands(percent / 100, keep), F.size("low") + Classes(percent / 100).bands, "buckets")
    texts = src.where("id is not null").select(F.col("key").alias("id"), "text")
    payload = lambda ids: likely(texts, ids).join(ids, "id").dropDuplicates(["id"])
    found, links = link_groups(buckets, sketches, payload, Likeness(_matrix, scorer(percent / 100), preparer(shingle), verifier(percent)), "near")
    discard(sketches)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    classes = sets.join(found.withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "component").select(*which, "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    out = table.select("key", "id", *which).join(classes, which, "left")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select("key", "id", "n_shingles", comp.alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links), n_links, kept.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets. n_links counts the verified
    links between different sets that the search needed, not all that exist.
    """
    out = _compared(docs, id_col, text_col, shingle, percent)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", "n_links", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, less those that repeat a kept one; rows with a null id stay."""
    gone = _compared(docs, id_col, text_col, shingle, percent).where("id <> component_id").select(F.col("key").alias("__gone")).distinct()
    return docs.join(gone, F.xxhash64(id_col, text_col) == F.col("__gone"), "left_anti")


def op3_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")
