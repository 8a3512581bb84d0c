"""Target-distribution importance resampling (operator 11): hashed word features, CRCs from length-bucketed matrices.

A document's features are its runs of 1 to `longest` consecutive words, joined by one space, repeats counted. A feature's
bucket is the CRC-32 of its UTF-8 bytes modulo `buckets`. In each piece of a batch the distinct features are grouped by their
length in bytes into two-dimensional byte matrices; the CRCs of all rows of a matrix are updated column by column, and the
buckets are scattered back to all occurrences. (A feature of more than WIDE bytes, of which a matrix would have a row or two
and many columns, goes through zlib.)

Two passes read the texts: one sums the buckets of both tables, so that `buckets` numbers a table reach the driver, and one
averages the buckets' gains over each document's features. Ranks come from a histogram of the scores, which are whole numbers
within some 60,000, and from a range-partitioned numbering of the documents at or above the last score that is drawn. No task
needs more than its own rows; nothing else reaches the driver.

Defined results: null, empty and wordless texts have no features and weight 0; repeated rows count, and are drawn, as rows of
their own; a null id hashes like an empty one and comes before its ties; an empty table gives no rows, an empty target counts
zero features; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kgloom.operators.graph import numbered

from .storage import materialize
from .textops import ALNUM, CHUNK, Words, column, distinct, gathered, word_hashes, words

WIDE = 256
#: The reflected CRC-32 of each byte.
TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    TABLE = np.where(TABLE & 1, TABLE >> 1 ^ np.uint32(0xEDB88320), TABLE >> 1)


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each slice."""
    sizes = ends - starts
    out = np.zeros(len(starts), dtype=np.uint32)
    order = np.argsort(sizes, kind="stable")
    lengths, at = np.unique(sizes[order], return_index=True)
    for n, lo, hi in zip(lengths.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
        if n > WIDE:
            for k in order[lo:hi]:
                out[k] = zlib.crc32(data[starts[k] : ends[k]])
            continue
        step = max(1, CHUNK // max(n, 1))
        for low in range(lo, hi, step):
            rows = order[low : min(low + step, hi)]
            cells = np.ascontiguousarray(data[starts[rows, None] + np.arange(n)].T)
            crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
            for byte in cells:
                crc = TABLE[(crc ^ byte) & np.uint32(0xFF)] ^ crc >> np.uint32(8)
            out[rows] = ~crc
    return out


def features(w: Words, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends, hashes, rows) of all runs of 1 to `longest` words; rows count from the piece's first."""
    rows = np.repeat(np.arange(w.n), np.diff(w.bounds))
    if longest == 1:
        return w.data, w.starts, w.ends, w.h, rows
    sizes = w.ends - w.starts
    ends = np.cumsum(sizes + 1) - 1
    data = np.full(ends[-1] + 1 if len(ends) else 0, 0x20, dtype=np.uint8)
    inside = np.ones(len(data), dtype=bool)
    inside[ends] = False
    data[inside] = gathered(w.data, w.starts, sizes)
    starts = ends - sizes
    found = []
    for k in range(1, longest + 1):
        i = np.arange(max(0, len(rows) - k + 1))
        i = i[rows[i] == rows[i + k - 1]]
        s, e = starts[i], ends[i + k - 1]
        found.append((s, e, word_hashes(data, s, e), rows[i]))
    return data, *(np.concatenate(x) for x in zip(*found))


def feature_buckets(w: Words, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, bucket) of every feature."""
    data, starts, ends, h, rows = features(w, longest)
    first, which = distinct(data, starts, ends, h)
    return rows, (crc32s(data, starts[first], ends[first]) % np.uint32(buckets)).astype(np.int64)[which]


def _sums(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for w in words(column(b, "text"), ALNUM):
                total += np.bincount(feature_buckets(w, longest, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features a bucket over all texts (text)."""
    got = texts.select("text").mapInArrow(_sums(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: floor(1000 ln) of its smoothed share of the target over that of the raw table."""
    s, t, n = raw.astype(float), target.astype(float), len(raw)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weights(longest: int, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n, total = (np.zeros(b.num_rows, dtype=np.int64) for _ in range(3))
            for w in words(column(b, "text"), ALNUM):
                rows, bucket = feature_buckets(w, longest, len(gain))
                here = slice(w.row0, w.row0 + w.n)
                n_words[here], n[here] = np.diff(w.bounds), np.bincount(rows, minlength=w.n)
                np.add.at(total[here], rows, gain[bucket])
            yield pa.RecordBatch.from_arrays([b.column("id"), *map(pa.array, (n_words, n, total // np.maximum(n, 1)))], ["id", "n_words", "n_features", "weight"])

    return run


def weighted(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of each document's features, toward the target's texts."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    gain = gains(bucket_counts(src, longest, buckets), bucket_counts(target.select(F.col(text_col).alias("text")), longest, buckets))
    out = src.mapInArrow(_weights(longest, gain), f"id {dict(src.dtypes)['id']}, n_words long, n_features long, weight long")
    return out.withColumnRenamed("id", id_col)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, seed: str = "2024", longest: int = 1, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's (id, n_words, n_features, weight, score, rank): score is weight plus hashed Gumbel noise, and rank the
    place among the `percent` per cent of the documents of `least` words or more that are drawn, null for the others."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = materialize(weighted(docs, target, longest, buckets, id_col, text_col).withColumn("score", F.col("weight") + noise), "resampling")
    able = F.col("n_words") >= least
    at_score = sorted(((r["score"], r["n"]) for r in scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    drawn, seen, cut = percent * sum(n for _, n in at_score) // 100, 0, None
    for cut, n in at_score:
        seen += n
        if seen >= drawn:
            break
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = numbered(scored.where(able & (F.col("score") >= cut)), [], [-F.col("score"), F.col(id_col)])
    near = near.select(*scored.columns, F.when(F.col("__r") <= drawn, F.col("__r").cast("long")).alias("rank"))
    return near.unionByName(scored.where(~able | (F.col("score") < cut)).withColumn("rank", F.lit(None).cast("long")))


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 by its bitwise rule over each distinct word; DuckDB has no function for it.
ORACLE_SQL = r"""
WITH tab AS (SELECT list(c ORDER BY b) AS tab FROM (SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c FROM (SELECT unnest(range(256)) AS b))),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d), iw AS (SELECT unnest(ws) AS w FROM i),
v AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM iw)),
b AS (SELECT w, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda k: CAST(('0x' || substr(x, 2 * k + 1, 2)) AS BIGINT)), lambda c, y: xor(c >> 8, tab[1 + (xor(c, y) & 255)]), 4294967295), 4294967295) % 10000 AS b FROM v, tab),
s AS (SELECT b, count(*) AS n FROM dw JOIN b USING (w) GROUP BY b), t AS (SELECT b, count(*) AS n FROM iw JOIN b USING (w) GROUP BY b),
g AS (SELECT b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000) / ((s.n + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b)),
w AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM dw JOIN b USING (w) JOIN g USING (b) GROUP BY doc_id),
r AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || d.doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN w ON w.doc_id = d.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (SELECT 10 * count(*) // 100 FROM r WHERE n_features >= 20) THEN place END AS rank FROM k
"""
