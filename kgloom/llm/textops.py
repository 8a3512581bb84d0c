"""Word splitting and hashing over Arrow string columns, vectorised with numpy.

Tasks get Arrow batches from Spark; these helpers work on the UTF-8 buffers, about a megabyte at a time, so memory
stays bounded by the longest single text. Null texts count as empty. Words are identified by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

U = np.uint64
BASE = 0x9E3779B97F4A7C55
CHUNK, PIECE = 1 << 20, 1 << 14
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of op3 and op9: anything but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of op4 and the line operator: ASCII letters, digits and all bytes beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


#: Words of the source audit: ASCII letters and all bytes beyond ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers.get("up", ())) < n:
        n = max(n, CHUNK + 4096)
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(n, b, dtype=U)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column without nulls."""
    c = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(c.type):
        c = c.cast(pa.string())
    return pc.fill_null(c, "") if c.null_count else c


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, from 0) and bytes of a string column."""
    n = len(col)
    if not n:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    _, off, data = col.buffers()
    o = np.frombuffer(off, dtype=kind)[col.offset : col.offset + n + 1].astype(np.int64)
    d = np.frombuffer(data, dtype=np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return o - o[0], d


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word data[start:end], by sums of powers over pieces of about PIECE bytes, so that they stay in cache."""
    out = np.empty(len(starts), dtype=U)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), PIECE)), len(starts)))
    for i, j in zip(cuts[:-1], cuts[1:]):
        low, high = starts[i], ends[j - 1]
        up, down = powers(high - low + 1)
        total = np.zeros(high - low + 1, dtype=U)
        np.cumsum((data[low:high].astype(U) + U(1)) * up[: high - low], out=total[1:])
        at, to = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((total[to] - total[at]) * down[at] + (to - at).astype(U))
    return out


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices data[start : start + size], one behind the other."""
    return data[np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)]


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): the index of one of each of the distinct slices, and the place in `first` of each slice.

    Slices of equal hash are compared byte by byte; should two differ, the later one stands for itself, so the result is exact.
    """
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    rep, sizes = first[which], ends - starts
    alike = np.flatnonzero((sizes == sizes[rep]) & (rep != np.arange(len(rep))))
    differ = gathered(data, starts[alike], sizes[alike]) != gathered(data, starts[rep[alike]], sizes[alike])
    odd = np.flatnonzero(sizes != sizes[rep])
    if differ.any():
        odd = np.union1d(odd, alike[np.unique(np.repeat(np.arange(len(alike)), sizes[alike])[differ])])
    which[odd] = len(first) + np.arange(len(odd))
    return np.append(first, odd), which


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices as a string column."""
    sizes = ends - starts
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(gathered(data, starts, sizes)))


class Words:
    """The words of rows row0..row0+n of a batch: starts, ends, hashes h, and bounds (n + 1) of each row's words."""

    __slots__ = ("row0", "n", "raw", "data", "offsets", "starts", "ends", "h", "bounds")

    def __init__(self, row0: int, raw: np.ndarray, offsets: np.ndarray, keep: np.ndarray, lut: np.ndarray):
        self.row0, self.n, self.raw, self.offsets = row0, len(offsets) - 1, raw, offsets
        self.data = data = lut[raw]
        inside = keep[data]
        size = len(data)
        edge = np.zeros(size + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(size, dtype=bool)
        after = np.empty(size, dtype=bool)
        if size:
            before[0] = False
            before[1:] = inside[:-1]
            before &= ~edge[:-1]
            after[-1] = False
            after[:-1] = inside[1:]
            after &= ~edge[1:]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.h = word_hashes(data, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def rows(self) -> np.ndarray:
        """The row, within the batch, of each word."""
        return np.repeat(np.arange(self.row0, self.row0 + self.n), np.diff(self.bounds))


def words(col: pa.Array, keep: np.ndarray, lut: np.ndarray = LOWER) -> Iterator[Words]:
    """All rows of the column in order, in runs of about CHUNK bytes; a longer text is a run of its own."""
    offsets, data = buffers(col)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield Words(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], keep, lut)
        at = to


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n word hashes; n itself is part of the hash."""
    if len(h) < n:
        return np.zeros(0, dtype=U)
    acc = np.full(len(h) - n + 1, n * 0x9E3779B97F4A7C15 & (1 << 64) - 1, dtype=U)
    for j in range(n):
        acc = mix(acc ^ h[j : len(h) - n + 1 + j]) + U(j + 1)
    return acc


def ordered(x: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def shingle_set(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; with fewer words, the whole sequence as one; without words, none."""
    return ordered(ngrams(h, n)) if len(h) >= n else ngrams(h, len(h)) if len(h) else h


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def unsigned(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False).astype(np.int64).view(U)


#: Words are counted by the first bits of their hashes; those that make up less than 2**-RARE of all words are level 0.
LEVEL_BITS, RARE = 18, 16


def _often(keep: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << LEVEL_BITS, dtype=np.int64)
        for b in batches:
            for w in words(column(b, "text"), keep):
                total += np.bincount((w.h >> U(64 - LEVEL_BITS)).astype(np.intp), minlength=1 << LEVEL_BITS)
        at = np.flatnonzero(total > total.sum() >> RARE)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    return run


def word_levels(texts: DataFrame, keep: np.ndarray) -> np.ndarray:
    """How common words are, 0 to 31, by the first bits of their hashes; a table of fixed size, over all texts (text).

    A word's level only puts keys into an order, rarest first; any order gives the same results. Each task reports the slots
    that hold 2**-RARE of its words or more, so fewer than 2**RARE rows.
    """
    rows = texts.select("text").mapInArrow(_often(keep), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    level = np.zeros(1 << LEVEL_BITS, dtype=np.uint8)
    if rows.num_rows:
        slot, n = rows["slot"].to_numpy(), rows["n"].to_numpy()
        level[slot] = np.clip(2 * (RARE + np.log2(n / n.sum())) + 1, 0, 31).astype(np.uint8)
    return level


def levels_of(level: np.ndarray, h: np.ndarray) -> np.ndarray:
    return level[(h >> U(64 - LEVEL_BITS)).astype(np.intp)]
