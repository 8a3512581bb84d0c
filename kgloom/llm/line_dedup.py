"""Line dedup (operator 2): pigeonhole keys of normalised lines, SimHash, edit similarity, one occurrence per group.

A line is a piece of text between newlines. Its normal form is its words (letters in lower case and digits; punctuation
and spacing dropped); lines with fewer than min_words words (none, by default) are left alone, lines without words always.
Distinct forms are linked when 1 - edits / longer length over their words is at least `similarity`; links are followed to
connected groups, and of each group only the first occurrence, by (id, line number), stays.

Candidates are complete: e edits change at most 2e of a form's pairs of neighbouring words, so of the pairs, put into one
order for all forms (rare words first), two forms within e edits have one among their first 2e + 1 in common: pigeonhole
blocks over the words themselves. Blocks of SimHash bits alone lose links, as one changed word in ten flips a tenth of the
bits. The 128-bit SimHash of a form's words ranks the candidates of a form; a parity bit for each of 128 classes of words
rules out those that differ in more than 2e of them. Forms that can only be linked to equal ones give no keys.

Defined results: null texts stay null; empty texts have no line to remove; ids may be of any type that has an order;
repeated rows (id and text alike) keep the same lines, rows that share an id but not the text count as documents of their
own; rows with a null id pass unchanged and neither keep nor remove anything; extra columns pass through; if the input has
an n_chars column it is set to the new length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .linking import Likeness, link_groups, shared_buckets
from .storage import discard, likely, materialize
from .textops import ALNUM, LOWER, U, column, levels_of, mix, signed, word_levels, words

#: Bits of a key's order: level, then hash; above them stands the line's number in its run.
ORDER_BITS, HASH_BITS, LINE_BITS = 6, 40, 18

#: The four bits of a nibble as 16-bit lanes of one word.
LANES = np.array([sum((v >> b & 1) << (16 * b) for b in range(4)) for v in range(16)], dtype=U)


def simhash(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """128-bit SimHash, as (n, 2) words, of the runs of h that begin at cuts; no run is empty."""
    sizes = np.diff(np.append(cuts, len(h))).astype(np.int64)
    out = np.zeros((len(cuts), 2), dtype=U)
    for half in range(2):
        x = mix(h ^ U(0xD6E8FEB86659FD93 * (half + 1) & (1 << 64) - 1))
        for nib in range(16):
            lanes = np.add.reduceat(LANES[(x >> U(4 * nib) & U(15)).astype(np.intp)], cuts)
            for b in range(4):
                ones = (lanes >> U(16 * b) & U(0xFFFF)).astype(np.int64)
                out[:, half] |= (2 * ones > sizes).astype(U) << U(4 * nib + b)
        for k in np.flatnonzero(sizes > 60_000):  # the lanes of so long a line would overflow
            run = x[cuts[k] : cuts[k] + sizes[k]]
            out[k, half] = sum(int(2 * int((run >> U(b) & U(1)).sum()) > sizes[k]) << b for b in range(64))
    return out


def parity(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each of 128 classes of words whether the run has an odd number of them, as (n, 2) words; an edit flips two bits at most."""
    x = mix(h ^ U(0xA0761D6478BD642F))
    bit, high = U(1) << (x & U(63)), (x >> U(6) & U(1)).astype(bool)
    return np.stack([np.bitwise_xor.reduceat(np.where(high == half, bit, U(0)), cuts) for half in (False, True)], axis=1)


def edits_within(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """The most edits between a line of so many words and any line, which may be longer, that it can be linked to."""
    return ((1 - similarity) * np.floor(sizes / similarity + 1e-6) + 1e-9).astype(np.int64)


def line_keys(h: np.ndarray, level: np.ndarray, cuts: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(keys, how many of each run) of runs of word hashes h, each as common as its level says, that begin at cuts.

    The keys are the first k * e + 1 runs of k words, numbered among equal ones. Below a similarity of 0.75 edits may touch
    all pairs of words, so there k is 1.
    """
    k = 2 if similarity >= 0.75 else 1
    n = np.diff(np.append(cuts, len(h)))
    most = edits_within(n, similarity)
    grams = np.where(most > 0, np.maximum(n - k + 1, 0), 0)
    take = np.minimum(k * most + 1, grams)
    out = []
    step = 1 << LINE_BITS
    for lo in range(0, len(cuts), step):
        count = grams[lo : lo + step]
        total = int(count.sum())
        if not total:
            continue
        begin = np.cumsum(count) - count
        line = np.repeat(np.arange(len(count)), count)
        at = np.repeat(cuts[lo : lo + step] - begin, count) + np.arange(total)
        g, common = mix(h[at]), level[at].astype(U)
        if k == 2:
            g, common = mix(g ^ h[at + 1]), common + level[at + 1]
        order = common << U(HASH_BITS) | g >> U(64 - HASH_BITS)
        x = np.sort(line.astype(U) << U(ORDER_BITS + HASH_BITS) | order)
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        nth = np.arange(total) - np.repeat(first, np.diff(np.append(first, total)))
        keep = np.arange(total) - np.repeat(begin, count) < np.repeat(take[lo : lo + step], count)
        body = x[keep] & U((1 << ORDER_BITS + HASH_BITS) - 1)
        out.append(mix(mix(body) + nth[keep].astype(U) * U(0x9E3779B97F4A7C15)))
    return np.concatenate(out) if out else np.zeros(0, dtype=U), take


LINES = "id long, row long, doc {}, line int, s0 long, s1 long, p0 long, p1 long, n int, keys array<long>"


def _lines(min_words: int, similarity: float, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(column(b, "text"), ALNUM, LOWER):
                if not len(w.h):
                    continue
                seen = np.concatenate([[0], np.cumsum(w.raw == 10)])
                row = np.repeat(np.arange(w.n), np.diff(w.bounds))
                line = seen[w.starts] - seen[w.offsets[:-1]][row]
                cuts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(line, prepend=-1) != 0))
                sizes = np.diff(np.append(cuts, len(row)))
                mine = np.repeat(sizes >= min_words, sizes)
                h, cuts, sizes = w.h[mine], cuts[sizes >= min_words], sizes[sizes >= min_words]
                if not len(h):
                    continue
                begin = np.cumsum(sizes) - sizes
                order = np.arange(len(h)) - np.repeat(begin, sizes)
                key = np.add.reduceat(mix(h ^ mix(order.astype(U) + U(1))), begin)
                sim, par = simhash(h, begin), parity(h, begin)
                keys, many = line_keys(h, levels_of(shared.value, h), begin, similarity)
                of = pa.array(w.row0 + row[cuts])
                yield pa.RecordBatch.from_arrays(
                    [signed(mix(key)), b.column("row").take(of), b.column("doc").take(of), pa.array(line[cuts].astype(np.int32))]
                    + [signed(x[:, k].copy()) for x in (sim, par) for k in (0, 1)]
                    + [pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), signed(keys))],
                    ["id", "row", "doc", "line", "s0", "s1", "p0", "p1", "n", "keys"],
                )

    return run


def _keys(keep):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("keys")
            k = keys.flatten().to_numpy()
            at = np.flatnonzero(keep(k.view(U)))
            of = np.repeat(np.arange(b.num_rows), np.diff(keys.offsets.to_numpy()))[at]
            yield pa.RecordBatch.from_arrays([pa.array(k[at]), b.column("id").take(pa.array(of))], ["key", "id"])

    return run


def _fields(col) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U).reshape(-1, 5)


def scorer(similarity: float):
    def score(x: np.ndarray, y: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
        """1 - Hamming distance / 128 of SimHashes; -1 where lengths or parities rule a link out."""
        if cross:
            x, y = x[:, None, :], y[None, :, :]
        m, n = x[..., 4].astype(np.int64), y[..., 4].astype(np.int64)
        most = ((1 - similarity) * np.maximum(m, n) + 1e-9).astype(np.int64)
        flips = sum(np.bitwise_count(x[..., c] ^ y[..., c]).astype(np.int64) for c in (2, 3))
        apart = sum(np.bitwise_count(x[..., c] ^ y[..., c]).astype(np.int64) for c in (0, 1))
        s = np.where((np.abs(m - n) <= most) & (flips <= 2 * most), 1 - apart / 128, -1.0)
        return s, np.zeros_like(s)

    return score


class Lines:
    """Lines of a column: the word hashes h of line i are h[bounds[i] : bounds[i + 1]]; bags holds, in the same places, hashes
    of (word, how often it stood before)."""

    def __init__(self, col):
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        runs = list(words(col, ALNUM, LOWER))
        self.h = np.concatenate([w.h for w in runs]) if runs else np.zeros(0, dtype=U)
        self.sizes = np.concatenate([np.diff(w.bounds) for w in runs]) if runs else np.zeros(0, dtype=np.int64)
        self.bounds = np.append(0, np.cumsum(self.sizes))
        self.bags = mix(self.h + occurrence(np.repeat(np.arange(len(self.sizes)), self.sizes), self.h).astype(U) * U(0x9E3779B97F4A7C15))

    def words(self, i: int) -> np.ndarray:
        return self.h[self.bounds[i] : self.bounds[i + 1]]

    def drawn(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bags of lines i, one after the other, and for each entry its place in i."""
        n = self.sizes[i]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return self.bags[np.repeat(self.bounds[i], n) + at], np.repeat(np.arange(len(i)), n)


def occurrence(group: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How often each entry's (group, hash) stands before, up to the order of equal ones."""
    order = np.lexsort((h, group))
    g, x = group[order], h[order]
    new = np.append(True, (g[1:] != g[:-1]) | (x[1:] != x[:-1]))[: len(x)]
    first = np.flatnonzero(new)
    out = np.empty(len(h), dtype=np.int64)
    out[order] = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    return out


def within(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether at most `most` insertions, deletions and replacements of words turn a into b.

    The columns of the edit table are kept as bits of two integers (steps up and steps down), so a column costs a few
    operations on len(a) bits, after what both ends share is cut off.
    """
    if abs(len(a) - len(b)) > most:
        return False
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    head = int(differs[0]) if len(differs) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differs[0]) if len(differs) else n
    a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    if not a or not b:
        return len(a) + len(b) <= most
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for left, x in zip(range(len(b) - 1, -1, -1), b):
        eq = places.get(x, 0)
        diagonal = ((eq & up) + up ^ up) | eq | down
        rise, fall = down | full & ~(diagonal | up), up & diagonal
        score += 1 if rise & top else -1 if fall & top else 0
        if score - left > most:
            return False
        rise = rise << 1 | 1
        up = (fall << 1 | ~(diagonal | rise)) & full
        down = rise & diagonal & full
    return score <= most


def verifier(similarity: float):
    def some(left: Lines, right: Lines, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        m, n = left.sizes[i], right.sizes[j]
        size = np.maximum(m, n)
        most = ((1 - similarity) * size + 1e-9).astype(np.int64)
        # Words that the lines don't share need an edit each.
        (p, of), (q, also) = left.drawn(i), right.drawn(j)
        pair, bag = np.concatenate([of, also]), np.concatenate([p, q])
        order = np.lexsort((bag, pair))
        pair, bag = pair[order], bag[order]
        twice = (pair[1:] == pair[:-1]) & (bag[1:] == bag[:-1])
        shared = np.bincount(pair[1:][twice], minlength=len(i))
        out = (np.abs(m - n) <= most) & (size - shared <= most)
        for k in np.flatnonzero(out):
            out[k] = within(left.words(i[k]), right.words(j[k]), int(most[k]))
        return out

    def same(left: Lines, right: Lines, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        # So many pairs at a time that their bags have about a million entries.
        step = np.cumsum(left.sizes[i] + right.sizes[j]) >> 20
        cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(i))
        parts = [some(left, right, i[x:y], j[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=bool)

    return same


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, text = [], []
        for t, refs in zip(column(b, "text").to_pylist(), b.column("refs").to_pylist()):
            lines = t.split("\n")
            for r in refs:
                ids.append(r["id"])
                text.append(lines[r["line"]] if r["line"] < len(lines) else "")
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(text, pa.string())], ["id", "text"])


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 1, similarity: float = 0.9) -> DataFrame:
    """(row, doc, removed): for each document that loses lines, the hash of its id and text, the id, and the numbers, from 0,
    of those lines."""
    src = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("doc is not null and text is not null")
    level = docs.sparkSession.sparkContext.broadcast(word_levels(src, ALNUM))
    lines = materialize(src.mapInArrow(_lines(min_words, similarity, level), LINES.format(dict(src.dtypes)["doc"])), "lines")
    firsts = materialize(lines.groupBy("id").agg(F.min(F.struct("doc", "row", "line")).alias("first")), "forms")
    buckets = shared_buckets(lines.select("id", "keys"), _keys, F.size("keys"), "buckets")
    fields = ["s0", "s1", "p0", "p1", "n"]
    some = buckets.select("id").distinct()
    sketches = likely(lines.select("id", *fields), some).join(some, "id", "left_semi").groupBy("id").agg(*(F.first(c).alias(c) for c in fields))
    sketches = materialize(sketches.select("id", F.array(*(F.col(c).cast("long") for c in fields)).alias("sketch"), (16 * F.col("n").cast("long")).alias("bytes")), "lines")

    def payload(ids: DataFrame) -> DataFrame:
        refs = materialize(firsts.join(ids, "id").groupBy("first.row").agg(F.collect_list(F.struct("id", "first.line")).alias("refs")), "lines")
        found = likely(src.select("row", "text"), refs.select(F.col("row").alias("id")), "row").dropDuplicates(["row"])
        return found.join(refs, "row").select("text", "refs").mapInArrow(_pick, "id long, text string")

    groups, _ = link_groups(buckets, sketches, payload, Likeness(_fields, scorer(similarity), Lines, verifier(similarity)), "lines")
    discard(sketches)
    first = firsts.join(groups, "id", "left").groupBy(F.coalesce("component", "id").alias("g")).agg(F.min("first").alias("f"))
    stay = first.groupBy(F.col("f.row").alias("row")).agg(F.collect_list("f.line").alias("stay"))
    every = lines.groupBy("row").agg(F.min("doc").alias("doc"), F.collect_set("line").alias("every"))
    gone = F.array_except("every", F.coalesce("stay", F.array().cast("array<int>")))
    return every.join(stay, "row", "left").select("row", "doc", gone.alias("removed")).where("size(removed) > 0")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 1, similarity: float = 0.9, counts: bool = False) -> DataFrame:
    """docs with repeated lines taken out of the text; with counts, also __n_lines and __n_removed."""
    gone = removed_lines(docs, id_col, text_col, min_words, similarity).select(F.col("row").alias("__row"), F.col("removed").alias("__removed"))
    known = F.when(F.col(id_col).isNotNull() & F.col(text_col).isNotNull(), F.xxhash64(id_col, text_col))
    out = docs.join(gone, known == F.col("__row"), "left").drop("__row")
    out = out.withColumn("__lines", F.split(F.col(text_col), "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__removed"))
    cut = F.array_join(F.transform(left, lambda i: F.element_at("__lines", i + 1)), "\n")
    new = {text_col: F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(cut)}
    if counts:
        size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")
        new |= {"__n_lines": size("__lines"), "__n_removed": size("__removed")}
    out = out.withColumns(new)
    if "n_chars" in docs.columns and text_col != "n_chars":
        out = out.withColumn("n_chars", F.length(text_col).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns, *(["__n_lines", "__n_removed"] if counts else []))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many went, and the SHA-256 of the text that is left (null: empty)."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), counts=True)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
