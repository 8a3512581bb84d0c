"""SentencePiece BPE encoding and decoding (operator 13): vectorised merge rounds over flat symbol arrays.

A text is normalised as the model says (identity, a dummy space in front, spaces as U+2581) and cut into words: a run of spaces
and what follows it. No piece of such a model has a space behind another character, so words are encoded each by itself; the
distinct words of a batch that the task hasn't seen before are encoded together. Their characters stand in one flat array,
cut into segments at word ends and wherever no piece holds the two characters side by side. A round takes each segment's
least pair rank (a segmented minimum), merges its leftmost pair in all segments at once, and compacts the arrays; segments
without a pair leave. Where no pair that a merged symbol can make comes before its own rank, all of a segment's pairs of that
rank merge in the same round, leftmost first, which gives what one merge after the other would.

Pieces of equal score (runs of spaces, as a rule) go strictly by place, one merge a round; a segment of more than TIES symbols
in that state is finished by a heap of pairs, so that a long run of spaces takes no quadratic time.

Characters without a piece become byte pieces. Rows are independent: no shuffle, and a bounded memory of words a task.

Defined results: null and empty texts give the begin and end ids only, and decode to nothing; repeated rows and extra columns
don't matter; a model with user-defined or unused pieces, or without byte pieces, is refused.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .textops import CHUNK, buffers, column, distinct, gathered, word_hashes

SPACE = "▁"
NONE = np.int64(1 << 40)
#: A segment of more symbols with tied pieces goes to the heap. Of so many words, or ids, a task's memory starts anew.
TIES, MOST, MOST_IDS = 256, 400_000, 1 << 22
_loaded: dict[str, Codec] = {}


class Codec:
    """A BPE model's tables. Symbols are piece ids, or `size` plus the code point of a character that is no piece."""

    def __init__(self, sp: sentencepiece.SentencePieceProcessor):
        n = self.size = sp.get_piece_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        pieces = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        typical = sp.encode(f"a  b{SPACE}", out_type=str) and sp.decode(sp.encode(" a  b ")) == " a  b "
        if not typical or not all(sp.is_byte(int(i)) for i in self.byte_ids) or any(sp.is_unused(i) for i in range(n)) or any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("the model isn't a plain BPE model with byte pieces, identity normalisation and pieces that begin with their spaces")
        # The rank of a piece: its score's place, ties alike.
        scores = np.array([sp.get_score(i) for i in range(n)])
        _, rank = np.unique(-scores, return_inverse=True)
        symbol = lambda s: pieces.get(s, n + ord(s) if len(s) == 1 else None)
        made = {}
        for p, i in pieces.items():
            for k in range(1, len(p)):
                a, b = symbol(p[:k]), symbol(p[k:])
                if a is not None and b is not None:
                    made[a << 21 | b] = i
        self.keys = np.sort(np.fromiter(made, np.int64, len(made)))
        self.made = np.fromiter((made[k] for k in self.keys.tolist()), np.int64, len(made))
        # Rank in the high bits, piece in the low ones: pairs compare by rank, and name what they make.
        self.values = rank[self.made].astype(np.int64) << 20 | self.made
        best = np.full(n, NONE)
        for side in (self.keys >> 21, self.keys & (1 << 21) - 1):
            real = side < n
            np.minimum.at(best, side[real], self.values[real] >> 20)
        self.all_at_once = best > rank
        self.of_char = np.arange(0x110000, dtype=np.int32) + n
        for p, i in pieces.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.beside = np.unique(np.fromiter((ord(a) << 21 | ord(b) for p in pieces for a, b in zip(p, p[1:])), np.int64))
        self.bytes = [b"" if sp.is_control(i) else bytes([b]) if (b := self._byte(sp, i)) is not None else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        self.is_byte = np.isin(np.arange(n), self.byte_ids)
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.flat_sizes = np.fromiter(map(len, self.bytes), np.int64, n)
        self.flat_starts = np.cumsum(self.flat_sizes) - self.flat_sizes
        self.unknown = sp.decode([sp.unk_id()]).encode()
        self.unk = sp.unk_id()
        self.forget()

    def forget(self) -> None:
        """The memory of words: the place of each in `ends`, and the ids of all, one word behind the other."""
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    @staticmethod
    def _byte(sp: sentencepiece.SentencePieceProcessor, i: int) -> int | None:
        return int(sp.id_to_piece(i)[3:5], 16) if sp.is_byte(i) else None

    @classmethod
    def named(cls, name: str) -> Codec:
        """The codec of a file of public_tokenizers; loaded once per Python worker."""
        if name not in _loaded:
            _loaded[name] = cls(sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name)))
        return _loaded[name]

    def values_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and piece of each pair, NONE where it makes no piece."""
        key = a << 21 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def one_by_one(self, symbols: list[int]) -> list[int]:
        """A segment's symbols after all merges, by a heap of pairs: least rank first, then leftmost."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, values: np.ndarray | None = None) -> None:
            j = after[i] if i >= 0 else n
            if i >= 0 and j < n:
                v = int(self.values_of(np.array([symbols[i]]), np.array([symbols[j]]))[0]) if values is None else int(values[i])
                if v < NONE:
                    heapq.heappush(heap, (v >> 20, i, v & (1 << 20) - 1, symbols[i], symbols[j]))

        flat = np.array(symbols, dtype=np.int64)
        first = self.values_of(flat[:-1], flat[1:])
        for i in range(n - 1):
            offer(i, first)
        while heap:
            _, i, piece, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = piece, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s >= 0]

    def merge(self, chars: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word of each) of code points, each with the number of its word, ascending."""
        apart = word[1:] != word[:-1]
        key = chars[:-1] << 21 | chars[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        segment = np.append(0, np.cumsum(apart | (self.beside[at] != key)))[: len(chars)]
        word_of = word[np.append(0, 1 + np.flatnonzero(np.diff(segment)))[: len(chars)]]
        symbol = self.of_char[chars].astype(np.int64)
        pair = self._pairs(symbol, segment)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.append(0, 1 + np.flatnonzero(segment[1:] != segment[:-1]))
            sizes = np.diff(np.append(starts, len(symbol)))
            least = np.minimum.reduceat(pair >> 20, starts)
            # Segments without a pair leave, tied ones of many symbols go to the heap.
            over = least >= NONE >> 20
            if over.any():
                gone = np.repeat(over, sizes)
                done.append((segment[gone], symbol[gone]))
                symbol, segment, pair = symbol[~gone], segment[~gone], pair[~gone]
                least, sizes = least[~over], sizes[~over]
                starts = np.cumsum(sizes) - sizes
                if not len(symbol):
                    break
            hit = np.flatnonzero(pair >> 20 == np.repeat(least, sizes))
            leftmost = np.append(True, segment[hit[1:]] != segment[hit[:-1]])
            many = self.all_at_once[pair[hit] & (1 << 20) - 1]
            tied = np.flatnonzero(leftmost & ~many)
            long = tied[sizes[np.searchsorted(starts, hit[tied], "right") - 1] > TIES]
            if len(long):
                which = np.searchsorted(starts, hit[long], "right") - 1
                gone = np.zeros(len(symbol), dtype=bool)
                for k in which.tolist():
                    here = slice(starts[k], starts[k] + sizes[k])
                    out = np.array(self.one_by_one(symbol[here].tolist()), dtype=np.int64)
                    done.append((np.full(len(out), segment[starts[k]]), out))
                    gone[here] = True
                symbol, segment, pair = symbol[~gone], segment[~gone], pair[~gone]
                continue
            # Of pairs that overlap, every other one, from the left.
            begins = np.append(True, np.diff(hit) > 1)
            run = np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))
            hit = hit[np.where(many, (np.arange(len(hit)) - run) % 2 == 0, leftmost)]
            symbol[hit] = pair[hit] & (1 << 20) - 1
            keep = np.ones(len(symbol), dtype=bool)
            keep[hit + 1] = False
            place = np.cumsum(keep)[hit] - 1
            symbol, segment, pair = symbol[keep], segment[keep], pair[keep]
            changed = np.concatenate([place, place[place > 0] - 1])
            pair[changed] = self._pairs(symbol, segment, changed)
        if not done:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        segment, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(segment, kind="stable")
        return symbol[order], word_of[segment[order]]

    def _pairs(self, symbol: np.ndarray, segment: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The value of the pair that begins at each place (of `at`); none at a segment's last symbol."""
        at = np.arange(len(symbol)) if at is None else at
        to = np.minimum(at + 1, len(symbol) - 1)
        inside = (to > at) & (segment[at] == segment[to])
        return np.where(inside, self.values_of(symbol[at], symbol[to]), NONE)

    def encode_words(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word) of words with spaces as they are."""
        texts = [w.decode() for w in found]
        chars = np.frombuffer("".join(texts).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        symbol, word = self.merge(chars, word)
        bad = np.flatnonzero(symbol >= self.size)
        if len(bad):
            raw = [chr(c).encode() for c in (symbol[bad] - self.size).tolist()]
            many = np.ones(len(symbol), dtype=np.int64)
            many[bad] = list(map(len, raw))
            symbol, word, unknown = np.repeat(symbol, many), np.repeat(word, many), np.repeat(symbol >= self.size, many)
            symbol[unknown] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return symbol.astype(np.int32), np.bincount(word, minlength=len(texts))

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids) of normalised texts, without begin and end ids."""
        n, edge = len(data), np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        space = data == 0x20
        starts = np.flatnonzero(edge[:n] | space & ~np.append(False, space[:-1])[:n])
        ends = np.append(starts[1:], n)[: len(starts)]
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        first, which = distinct(data, starts, ends, word_hashes(data, starts, ends))
        raw = data.tobytes()
        found = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        if len(self.known) > MOST or len(self.ids) > MOST_IDS:
            self.forget()
        new = [w for w in dict.fromkeys(found) if w not in self.known]
        if new:
            ids, many = self.encode_words(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.ids, self.ends = np.append(self.ids, ids), np.append(self.ends, self.ends[-1] + np.cumsum(many))
        place = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))[which]
        sizes = self.ends[place + 1] - self.ends[place]
        each = np.append(0, np.cumsum(sizes))
        return gathered(self.ids, self.ends[place], sizes), each[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of ids, as the library's decode gives it."""
        ids = ids.astype(np.int64)
        ends = np.append(0, np.cumsum(self.flat_sizes[ids]))[offsets].tolist()
        raw = gathered(self.flat, self.flat_starts[ids], self.flat_sizes[ids]).tobytes()
        out = [raw[lo:hi] for lo, hi in zip(ends, ends[1:])]
        # Pieces are whole characters, so only byte pieces can break a sequence; a text in which they do isn't valid, unless
        # a begin or end id stands inside it.
        whole = _valid(raw) and not any(0x80 <= x[0] < 0xC0 for x in out if x)
        inner = ids == self.unk
        inner[1:-1] |= self.flat_sizes[ids[1:-1]] == 0
        inner[offsets[1:-1]] &= ids[offsets[1:-1]] == self.unk
        inner[offsets[1:-1] - 1] &= ids[offsets[1:-1] - 1] == self.unk
        careful = np.append(0, np.cumsum(inner))[offsets].tolist()
        for k in range(len(out)):
            if careful[k + 1] > careful[k] or not (whole or _valid(out[k])):
                out[k] = self._decode_bytes(ids[offsets[k] : offsets[k + 1]])
        return [x[1:] if x[:1] == b" " and not lead else x for x, lead in zip(out, self._leads(ids, offsets))]

    def _leads(self, ids: np.ndarray, offsets: np.ndarray) -> list[bool]:
        """Whether a text's first piece isn't one that begins with the dummy space."""
        out = []
        for lo, hi in zip(offsets.tolist(), offsets[1:].tolist()):
            first = next((i for i in ids[lo : min(hi, lo + 8)].tolist() if i not in (self.bos, self.eos)), None)
            out.append(first is None or self.is_byte[first] or first == self.unk)
        return out

    def _decode_bytes(self, ids: np.ndarray) -> bytes:
        """Runs of byte pieces as UTF-8, each byte of a broken sequence as U+FFFD."""
        out, run = [], b""
        for i in [*ids.tolist(), self.bos]:
            if self.is_byte[i]:
                run += self.bytes[i]
                continue
            if run:
                out.append(run if _valid(run) else _repaired(run))
                run = b""
            out.append(self.unknown if i == self.unk else self.bytes[i])
        return b"".join(out)


def _valid(b: bytes) -> bool:
    try:
        b.decode()
    except UnicodeDecodeError:
        return False
    return True


def _repaired(b: bytes) -> bytes:
    out, at = [], 0
    while at < len(b):
        size = next((k for k in range(1, 5) if _valid(b[at : at + k]) and at + k <= len(b)), 0)
        out.append(b[at : at + size] if size else "�".encode())
        at += size or 1
    return b"".join(out)


def normalised(col: pa.Array) -> pa.Array:
    """Texts with U+2581 as a space, since both become the same, and a dummy space before those that aren't empty."""
    col = pc.replace_substring(col.cast(pa.large_string()), SPACE, " ")
    nothing, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    return pc.if_else(pc.equal(pc.binary_length(col), 0), nothing, pc.binary_join_element_wise(nothing, col, space))


def coded(codec: Codec, col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids with begin and end, offsets of each text) in runs of about CHUNK bytes of texts; a longer text is a run of its own."""
    offsets, data = buffers(normalised(col))
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        ids, ends = codec.encode(offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]])
        k = np.arange(to - at + 1)
        out = np.full(len(ids) + 2 * (to - at), codec.eos, dtype=np.int32)
        inside = np.ones(len(out), dtype=bool)
        bounds = ends + 2 * k
        out[bounds[:-1]] = codec.bos
        inside[bounds[:-1]] = inside[bounds[1:] - 1] = False
        out[inside] = ids
        yield out, bounds
        at = to


def _codes(name: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.named(name)
        for b in batches:
            row = 0
            for ids, bounds in coded(codec, column(b, "text")):
                some = b.column("id").slice(row, len(bounds) - 1)
                row += len(bounds) - 1
                texts, n = codec.decode(ids, bounds), pa.array(np.diff(bounds))
                if full:
                    yield pa.RecordBatch.from_arrays([some, n, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)), pa.array([t.decode() for t in texts], pa.string())], ["id", "n_tokens", "ids", "decoded"])
                else:
                    raw, ends = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
                    sha = [hashlib.sha256(raw[lo:hi]).hexdigest() for lo, hi in zip(ends, ends[1:])], [hashlib.sha256(t).hexdigest() for t in texts]
                    yield pa.RecordBatch.from_arrays([some, n, *(pa.array(s, pa.string()) for s in sha)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_decode(docs: DataFrame, name: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) per row: the ids, begin and end included, and the text that they decode to."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_codes(name, True), f"id {dict(src.dtypes)['id']}, n_tokens long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def code_digests(docs: DataFrame, name: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row; the ids themselves don't leave the task."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_codes(name, False), f"id {dict(src.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op13_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return code_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
