"""Byte-level BPE encoding and decoding (operator 7): a segment tree over byte positions.

Each match of the public pattern is encoded by itself. A leaf of the tree stands for a byte position and holds the rank of
the pair that starts there with the part behind it, so a node's minimum is the leftmost pair of least rank. A merge takes
the root's pair, joins it with its right neighbour and updates three leaves: the merged one, the one before it and the one
that vanished; each update climbs one path of the tree. A match of n bytes takes O(n log n) steps, however long.

The distinct unseen matches of a batch are encoded together: matches of up to VECTOR bytes have binary trees as rows of one
matrix, and a step merges one pair in each row. Longer ones have a tree of their own, with sixteen children a node.

Rows are independent, so there is no shuffle; each task remembers short pieces in a bounded dictionary.

Defined results: null and empty texts give no ids and empty bytes; repeated rows and extra columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .textops import column
from .units import pieces

FAR = 1 << 62
#: Children of a node of a long match's tree; the longest match whose tree is a row of a matrix, and its bits.
WIDTH, VECTOR, BITS = 16, 64, 6
#: Pieces of up to LONGEST characters are remembered, MOST of them; a full memory starts anew.
LONGEST, MOST = 64, 200_000
_loaded: dict[str, Codec] = {}
Coded = tuple[str, int, bytes]


class Pairs:
    """The rank of the token that two tokens make, for arrays of pairs: an open-addressed table of all pairs that make one."""

    NONE = np.iinfo(np.int32).max

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 2
        made = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    made[a * self.size + b] = rank
        key, rank = np.fromiter(made.keys(), np.int64, len(made)), np.fromiter(made.values(), np.int32, len(made))
        self.bits = max(8, (4 * len(made)).bit_length())
        self.keys, self.ranks = np.full((1 << self.bits) + 1, -1, dtype=np.int64), np.full((1 << self.bits) + 1, self.NONE, dtype=np.int32)
        at = self.slot(key)
        while len(key):
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.ranks[at[put]] = key[put], rank[put]
            rest = np.setdiff1d(np.arange(len(key)), put)
            key, rank, at = key[rest], rank[rest], self.next(at[rest])

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def next(self, at: np.ndarray) -> np.ndarray:
        return at + 1 & (1 << self.bits) - 1

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * np.int64(self.size) + b
        at = self.slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.ranks[at], np.int32(self.NONE))
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = self.next(at[open_])
            found = self.keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.names = {v: str(v) for v in self.tokens}
        self.longest = max(map(len, ranks))
        self.pairs = {k: v << 32 for k, v in ranks.items() if len(k) == 2}
        self.joined = Pairs(ranks)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.find = regex.compile(pattern).findall
        self.matches: dict[str, Coded] = {}
        self.first: dict[str, Coded] = {}
        self.later: dict[str, Coded] = {}

    @classmethod
    def named(cls, name: str) -> Codec:
        """The codec of a file of public_tokenizers; loaded once per Python worker."""
        if name not in _loaded:
            with open(public_tokenizers.path(name), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _loaded[name] = cls(ranks, public_tokenizers.PATTERN)
        return _loaded[name]

    def forget(self) -> None:
        """Drops what was remembered; the worker outlives its task, and other stages run in it."""
        for memory in (self.matches, self.first, self.later):
            memory.clear()

    def encode_match(self, b: bytes) -> list[int]:
        """Ids of one match."""
        whole = self.ranks.get(b)
        if whole is not None:
            return [whole]
        n, get, longest, pairs = len(b), self.ranks.get, self.longest, self.pairs
        leaf = [pairs.get(b[i : i + 2], FAR) | i for i in range(n - 1)]
        leaf.append(FAR)
        after = list(range(1, n + 1))  # start of the next live part
        before = list(range(-1, n - 1))
        levels = [leaf]
        while len(levels[-1]) > WIDTH:
            low = levels[-1]
            levels.append([min(low[k : k + WIDTH]) for k in range(0, len(low), WIDTH)])
        top = levels[-1]
        while (least := min(top)) < FAR:
            i = least & 0xFFFFFFFF
            j = after[i]
            end = after[i] = after[j]
            # Three leaves change: the part that vanished, the merged one, and the one before it.
            leaf[j] = leaf[i] = FAR
            if end < n:
                before[end] = i
                r = get(b[i : after[end]])
                if r is not None:
                    leaf[i] = r << 32 | i
            p = before[i]
            if p >= 0:
                r = get(b[p:end]) if end - p <= longest else None
                leaf[p] = FAR if r is None else r << 32 | p
            if top is not leaf:
                changed = {i, j, p if p >= 0 else i}
                for low, high in zip(levels, levels[1:]):
                    changed = {k // WIDTH for k in changed}
                    for k in changed:
                        high[k] = min(low[k * WIDTH : (k + 1) * WIDTH])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[b[i : after[i]]])
            i = after[i]
        return out

    def encode_rows(self, found: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each match) of matches of up to `width` bytes, a power of two."""
        m, joined, far = len(found), self.joined, np.int32(Pairs.NONE)
        n = np.fromiter(map(len, found), np.int64, m)
        data = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in found]), np.uint8).reshape(m, width)
        place = np.arange(width + 1)
        live = place < n[:, None]
        part = np.full((m, width + 1), joined.size - 1, dtype=np.int64)  # no token has the last number
        part[:, :width] = np.where(live[:, :width], self.bytes[data], joined.size - 1)
        rank = joined(part[:, :-1].ravel(), part[:, 1:].ravel()).reshape(m, width)
        valued = lambda r, i: np.where(r == far, far, r << np.int32(BITS) | i.astype(np.int32))
        tree = np.full((m, 2 * width), far, dtype=np.int32)
        tree[:, width:] = valued(rank, place[:width])
        k = width
        while k > 1:
            tree[:, k // 2 : k] = np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2])
            k //= 2
        after, before = np.tile(np.minimum(place + 1, width), m), np.tile(place - 1, m)
        part, alive, tree = part.ravel(), live.ravel(), tree.ravel()
        children = tree.reshape(-1, 2)
        rows = np.arange(m)
        while len(rows):
            root = tree[rows * 2 * width + 1]
            more = root != far
            if not more.all():
                rows, root = rows[more], root[more]
            i, r = (root & (1 << BITS) - 1).astype(np.int64), (root >> BITS).astype(np.int64)
            at, top = rows * (width + 1), rows * 2 * width
            j = after[at + i]
            end = after[at + j]
            part[at + i], after[at + i], before[at + end], alive[at + j] = r, end, i, False
            # Three leaves change: the part that vanished, the merged one, and the one before it.
            leaf = top + width
            tree[leaf + j] = far
            tree[leaf + i] = valued(joined(r, part[at + end]), i)
            p = before[at + i]
            has = p >= 0
            p = np.where(has, p, i)
            tree[leaf[has] + p[has]] = valued(joined(part[at[has] + p[has]], r[has]), p[has])
            base, k = np.tile(top, 3), width + np.concatenate([i, j, p])
            for _ in range(width.bit_length() - 1):
                k >>= 1
                two = children[(base >> 1) + k]
                tree[base + k] = np.minimum(two[:, 0], two[:, 1])
        alive = alive.reshape(m, width + 1)
        return part.reshape(m, width + 1)[alive], alive.sum(axis=1)

    def encode_matches(self, found: list[bytes]) -> list[list[int]]:
        """Ids of each of the matches."""
        out: list[list[int] | None] = [None] * len(found)
        rows: dict[int, list[int]] = {}
        for k, b in enumerate(found):
            whole = self.ranks.get(b)
            if whole is not None:
                out[k] = [whole]
            elif len(b) > VECTOR:
                out[k] = self.encode_match(b)
            else:
                rows.setdefault(8 if len(b) <= 8 else 16 if len(b) <= 16 else VECTOR, []).append(k)
        for width, which in rows.items():
            for at in range(0, len(which), 16_384):
                some = which[at : at + 16_384]
                ids, many = self.encode_rows([found[k] for k in some], width)
                ids, ends = ids.tolist(), np.cumsum(many).tolist()
                for k, lo, hi in zip(some, [0, *ends], ends):
                    out[k] = ids[lo:hi]
        return out

    def split(self, p: str) -> list[str]:
        """The pattern's matches; most pieces are a word, with or without a mark behind it."""
        word = p[1:] if p[0] == " " else p
        if word.isalpha():
            return [p]
        if len(word) > 1 and word[-1] in ",." and word[:-1].isalpha():
            return [p[:-1], p[-1]]
        return self.find(p)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def learn(self, memory: dict[str, Coded], new: list[str], lead: str) -> None:
        """Puts the pieces, each behind `lead`, into memory: ids as text, their number, and the bytes that they decode to."""
        if not new:
            return
        cut = [self.split(lead + p) for p in new]
        matches, names, tokens = self.matches, self.names, self.tokens
        # A piece that is one match is remembered as a piece only.
        single = [c[0] for c in cut if len(c) == 1]
        parts = {m for c in cut if len(c) > 1 for m in c}
        unseen = [m for m in parts if m not in matches]
        if len(matches) + len(unseen) > MOST:
            matches.clear()
            unseen = list(parts)
        coded = [
            (" ".join([names[i] for i in ids]), len(ids), b"".join([tokens[i] for i in ids])) if len(ids) > 1 else (names[ids[0]], 1, tokens[ids[0]])
            for ids in self.encode_matches([m.encode() for m in single + unseen])
        ]
        matches.update(zip(unseen, coded[len(single) :]))
        ready = iter(coded)
        for p, c in zip(new, cut):
            if len(c) == 1:
                memory[p] = next(ready)
            else:
                got = [matches[m] for m in c]
                memory[p] = (" ".join([g[0] for g in got]), sum([g[1] for g in got]), b"".join([g[2] for g in got]))
        for m in unseen:
            if len(m) > LONGEST:
                del matches[m]

    def texts(self, texts: list[str]) -> list[Coded]:
        """Of each text: its ids as text, their number, and the bytes that they decode to."""
        cut = [pieces(t) if t else [""] for t in texts]
        long = []
        for memory, lead, used in ((self.first, "", {c[0] for c in cut if c[0]}), (self.later, " ", {p for c in cut for p in c[1:]})):
            new = [p for p in used if p not in memory]
            if len(memory) + len(new) > MOST:
                memory.clear()
                new = list(used)
            self.learn(memory, new, lead)
            long.append([p for p in new if len(p) > LONGEST])
        out = []
        for c in cut:
            got = list(map(self.later.__getitem__, c[1:]))
            if c[0]:
                got.insert(0, self.first[c[0]])
            out.append((" ".join([g[0] for g in got]), sum([g[1] for g in got]), b"".join([g[2] for g in got])))
        for memory, gone in zip((self.first, self.later), long):
            for p in gone:
                del memory[p]
        return out


def _codes(name: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.named(name)
        try:
            for b in batches:
                for at in range(0, b.num_rows, 512):
                    part = b.slice(at, 512)
                    got = codec.texts(column(part, "text").to_pylist())
                    n = pa.array([g[1] for g in got], pa.int64())
                    if full:
                        ids = pa.array([[int(x) for x in g[0].split()] for g in got], pa.list_(pa.int32()))
                        yield pa.RecordBatch.from_arrays([part.column("id"), n, ids, pa.array([g[2] for g in got], pa.binary())], ["id", "n_tokens", "ids", "decoded"])
                    else:
                        sha = [[hashlib.sha256(x).hexdigest() for x in (g[0].encode(), g[2])] for g in got]
                        yield pa.RecordBatch.from_arrays([part.column("id"), n, pa.array([s[0] for s in sha], pa.string()), pa.array([s[1] for s in sha], pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            codec.forget()

    return run


def encode_decode(docs: DataFrame, name: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) per row: the token ids and the bytes they decode to."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_codes(name, True), f"id {dict(src.dtypes)['id']}, n_tokens long, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def code_digests(docs: DataFrame, name: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row; the ids themselves don't leave the task."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_codes(name, False), f"id {dict(src.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return code_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
