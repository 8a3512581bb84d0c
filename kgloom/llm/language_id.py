"""Language ID (operator 1): bit-sliced Bloom filters over byte n-grams.

Each slot of the filter is a bit mask of languages, of as many 64-bit words as they need. A gram's mask, the AND of its K slots, names all languages that contain
it (and a few by chance); the votes of a text are, per language, the count of its grams whose mask has the language's bit.
A language whose bit is set in a share f of the slots gets f**K false votes a gram; votes are corrected for that, and the
language with the largest corrected share of the text's grams is predicted. The share is the score.

Grams are runs of four bytes of the text after lower-casing A-Z and turning everything but letters and bytes beyond ASCII
into spaces, with two letters at least. The filter holds, per language, the most frequent grams, `grams` at most (those that tie at the end stay out), whose
share of the language's grams is at least half of the largest share that the gram has in any language.

Learning reads at most about `sample` labelled documents per language, chosen by a hash of the id (documented bound). Every
language that labelled documents show is learned; the filter has a size fixed by their number.

Defined results: null texts and texts without a letter give `und` and 0; texts whose grams are all unknown give the most
frequent language and 0; ties go to the language first in the alphabet; without labelled documents all is `und`; extra
columns are ignored by `predict` and kept by `keep_recognised`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .storage import materialize
from .textops import CHUNK, U, buffers, column, mix

SLOTS, K = 1 << 20, 3
#: Bytes of texts that are voted on at a time: each gram takes some sixty bytes meanwhile.
VOTED = 1 << 18
#: Letters and bytes beyond ASCII, lower-cased; all else is a space.
LETTERS = np.full(256, 0x20, dtype=np.uint8)
LETTERS[0x61:0x7B] = LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Model:
    langs: list[str]
    usual: str
    slots: np.ndarray
    false_rate: np.ndarray


def _padded(col: pa.Array, size_of_run: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of rows of about so many bytes; each row stands between two spaces."""
    offsets, data = buffers(col)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size_of_run, "right")) - 1)
        size = np.diff(offsets[at : to + 1])
        out = np.full(int(size.sum()) + 2 * (to - at), 0x20, dtype=np.uint8)
        out[np.arange(int(size.sum())) + np.repeat(2 * np.arange(to - at) + 1, size)] = LETTERS[data[offsets[at] : offsets[to]]]
        yield at, np.concatenate([[0], np.cumsum(size + 2)]), out
        at = to


def _grams(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-byte grams of the array and whether each has two letters or more. Grams never span rows with letters on both
    sides of the double space between them unless only one letter is on one side; such grams count for the first row."""
    if len(d) < 4:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=bool)
    x = d.astype(np.uint32)
    g = x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16) | x[3:] << np.uint32(24)
    letter = (d != 0x20).astype(np.int8)
    return g, letter[:-3] + letter[1:-2] + letter[2:-1] + letter[3:] >= 2


def _inside(offsets: np.ndarray, size: int) -> np.ndarray:
    """Gram positions whose four bytes are in one row."""
    ok = np.ones(max(0, size - 3), dtype=bool)
    for back in (1, 2, 3):
        at = offsets[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def _positions(g: np.ndarray) -> Iterator[np.ndarray]:
    h = mix(g.astype(U) + U(0x9E3779B97F4A7C15))
    for j in range(K):
        yield (h >> U(20 * j) & U(SLOTS - 1)).astype(np.int64)


def _count(langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for k, parts in held.items():
                u, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                yield k, u, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

        for b in batches:
            of = np.array([langs.index(x) for x in b.column("lang").to_pylist()], dtype=np.int64)
            for at, offsets, d in _padded(column(b, "text")):
                g, ok = _grams(d)
                ok &= _inside(offsets, len(d))
                lang = np.repeat(of[at : at + len(offsets) - 1], np.diff(offsets))[: len(g)]
                for k in np.unique(lang):
                    u, n = np.unique(g[ok & (lang == k)], return_counts=True)
                    held.setdefault(int(k), []).append((u, n))
                    size += len(u)
                if size > 2_000_000:
                    held = {k: [(u, n)] for k, u, n in merged()}
                    size = sum(len(p[0][0]) for p in held.values())
        for k, u, n in merged():
            yield pa.RecordBatch.from_arrays([pa.array([langs[k]] * len(u), pa.string()), pa.array(u.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 20_000, grams: int = 20_000) -> Model:
    """Learns from labelled (id, text, language) rows; rows without a language are ignored."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    langs = sorted(r[0] for r in counts)
    if not langs:
        return Model([], "und", np.zeros((1, 1), dtype=np.uint8), np.zeros(0))
    share = F.create_map(*(x for r in counts for x in (F.lit(r[0]), F.lit(min(1.0, sample / r[1])))))
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    seen = chosen.select("lang", "text").mapInArrow(_count(langs), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    seen = materialize(seen, "grams")
    totals = {r[0]: r[1] for r in seen.groupBy("lang").agg(F.sum("n")).collect()}
    total = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(totals.get(k, 0)))))
    seen = seen.withColumn("part", F.col("n") / F.element_at(total, F.col("lang")))
    most = seen.groupBy("gram").agg(F.max("part").alias("most"))
    seen = materialize(seen.join(most, "gram").where("part >= 0.5 * most").select("lang", "gram", "n"), "grams")
    # The count at which a language has `grams` grams or more, from how many grams have each count; no language is sorted.
    often = seen.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("kinds")).toArrow().to_pydict()
    least = {}
    for k in langs:
        left = grams
        for n, kinds in sorted(((n, c) for x, n, c in zip(often["lang"], often["n"], often["kinds"]) if x == k), reverse=True):
            if kinds > left:
                break
            left, least[k] = left - kinds, n
    floor = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(least.get(k, 1 << 62)))))
    table = seen.where(F.col("n") >= F.element_at(floor, F.col("lang"))).select("lang", "gram").toArrow()
    width = -(-len(langs) // 64)
    kind = np.uint8 if len(langs) <= 8 else np.uint64
    slots = np.zeros((SLOTS, width), dtype=kind)
    of, g = np.array(table["lang"].to_pylist(), dtype=object), table["gram"].to_numpy()
    for k, name in enumerate(langs):
        for pos in _positions(g[of == name].astype(np.uint32)):
            slots[pos, k // 64] |= kind(1 << k % 64)
    full = np.array([(slots[:, k // 64] >> kind(k % 64) & kind(1)).mean() for k in range(len(langs))])
    return Model(langs, counts[0][0], slots, full**K)


def _votes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        kind = m.slots.dtype.type
        for b in batches:
            text = column(b, "text")
            for at, offsets, d in _padded(text, VOTED):
                n = len(offsets) - 1
                g, ok = _grams(d)
                ok &= _inside(offsets, len(d))
                where = np.flatnonzero(ok)
                bounds = np.searchsorted(where, offsets)
                total = np.diff(bounds)
                pos = list(_positions(g[where]))
                mask = m.slots[pos[0]] & m.slots[pos[1]] & m.slots[pos[2]] if m.langs else np.zeros((0, 1), dtype=kind)
                best, lang = np.full(n, -1.0), np.full(n, -1)
                for k in range(len(m.langs)):
                    upto = np.concatenate([[0], np.cumsum((mask[:, k // 64] >> kind(k % 64) & kind(1)).astype(np.int32), dtype=np.int64)])
                    votes = upto[bounds[1:]] - upto[bounds[:-1]]
                    p = m.false_rate[k]
                    share = np.clip((votes / np.maximum(total, 1) - p) / max(1 - p, 1e-9), 0, 1)
                    better = share > best
                    best[better], lang[better] = share[better], k
                ascii_letters = np.add.reduceat((d >= 0x61) & (d <= 0x7A), offsets[:-1])
                wide = np.add.reduceat(d >= 0x80, offsets[:-1])
                names, scores = [], []
                for r in range(n):
                    letter = ascii_letters[r] > 0 or (wide[r] > 0 and any(c.isalpha() for c in text[at + r].as_py()))
                    if not letter or not m.langs:
                        names.append("und")
                        scores.append(0.0)
                    elif best[r] <= 0:
                        names.append(m.usual)
                        scores.append(0.0)
                    else:
                        names.append(m.langs[lang[r]])
                        scores.append(float(best[r]))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(at, n), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row, from the text alone."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return src.mapInArrow(_votes(shared), f"id {dict(src.dtypes)['id']}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that learning doesn't see: crc32 of the id as text leaves 2 modulo 4. Null ids are learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_recognised(docs: DataFrame, model: Model, least: float = 0.1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, in a recognised language: not `und`, and with a score of `least` or more."""
    row = F.xxhash64(id_col, text_col)
    rows = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    bad = predict(rows, model, "row", "text").where((F.col("lang_pred") == "und") | (F.col("score") < least)).select(F.col("row").alias("__bad")).distinct()
    return docs.join(bad, row == F.col("__bad"), "left_anti")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    out = predict(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
