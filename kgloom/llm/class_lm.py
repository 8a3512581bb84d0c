"""LM scoring (operator 9): a Brown class bigram model learned by distributed exchange clustering.

Learning counts all words of the training documents. The CLUSTERED most frequent words are assigned to CLASSES classes by
exchange: each round counts, for every word, the classes before and after it (from the table of symbol bigrams, in
parallel), then moves every second word to the class under which the class bigram likelihood of its contexts is largest;
rounds end when the likelihood of the classes no longer rises. Then every other word of the head is moved once, by its own
contexts from a scan over all training texts. The head is all words that are at least as frequent as a count which a
histogram of counts gives, HEAD words at most. Words beyond the head are moved likewise where `tail` says so (op9 does): their
contexts are a table, a word's contexts meet in one task, and their classes come by joins, so the vocabulary has no bound;
without `tail` they form one more class. The end of a text is a class. With G the class bigram counts over all training texts,

    P(w | v) = (G[c(v), c(w)] + a) / (sum of G[c(v)] + a * number of classes) * (n(w) + a) / (n(c(w)) + a * (words in c(w) + 1))

and a = 0.1; an unseen word has n = 0 in the class of other words; a text starts after an end and ends with one.

Words are known by a 64-bit hash. The head with its classes is broadcast to the tasks, HEAD being its bound; the counts and
classes of all other words come by a join, so the vocabulary may grow with the corpus.

Defined results: null and empty texts are scored as their end alone; rows with a null id are training rows; repeated rows
count as often as they stand; without training rows all counts are 0; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .storage import discard, materialize
from .textops import SPACED, U, column, signed, unsigned, words

CLUSTERED, CLASSES, HEAD, ROUNDS, A = 1024, 32, 1 << 18, 12, 0.1
REST, END = CLUSTERED, CLUSTERED + 1  # symbols; as classes CLASSES and CLASSES + 1
WIDE = CLUSTERED + 2


@dataclass
class Model:
    head: np.ndarray  # sorted hashes
    head_n: np.ndarray
    head_class: np.ndarray
    step: np.ndarray  # log10 of class transitions
    emit: np.ndarray  # per class: log10 of the emission's denominator
    tokens: int
    distinct: int
    ends: int

    @property
    def base_den(self) -> float:
        return float(np.log10(self.tokens + A * (self.distinct + 1)))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        u, inverse = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate([x[1] for x in held])).astype(np.int64)
        return pa.RecordBatch.from_arrays([signed(u), pa.array(n)], ["h", "n"])

    for b in batches:
        for w in words(column(b, "text"), SPACED):
            held.append(np.unique(w.h, return_counts=True))
            if sum(len(x[0]) for x in held) > 1_500_000:
                yield flush()
                held.clear()
    if held:
        yield flush()


def _lookup(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index in the sorted table, or -1."""
    if not len(table):
        return np.full(len(h), -1)
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    return np.where(table[at] == h, at, -1)


def _chain(of_word: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, current, first position of each row) over words and one end per row."""
    n = len(bounds) - 1
    starts = bounds[:-1] + np.arange(n)
    cur = np.empty(len(of_word) + n, dtype=np.int64)
    ends = bounds[1:] + np.arange(n)
    inner = np.ones(len(cur), dtype=bool)
    inner[ends] = False
    cur[inner], cur[ends] = of_word, end
    prev = np.empty_like(cur)
    if len(cur):
        prev[0] = end
        prev[1:] = cur[:-1]
    return prev, cur, starts


def _count_bigrams(top: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(top)
        table = top[order]
        total = np.zeros(WIDE * WIDE, dtype=np.int64)
        for b in batches:
            for w in words(column(b, "text"), SPACED):
                at = _lookup(table, w.h)
                sym = np.where(at >= 0, order[at] if len(order) else REST, REST)
                prev, cur, _ = _chain(sym, w.bounds, END)
                total += np.bincount(prev * WIDE + cur, minlength=WIDE * WIDE)
        code = np.flatnonzero(total)
        for at in range(0, len(code), 200_000):
            c = code[at : at + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(total[c])], ["pair", "n"])

    return run


def _contexts(classes: np.ndarray):
    """Per symbol, how often each class stands after it (side 0) and before it (side 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = CLASSES + 2
        total = np.zeros((2, WIDE * wide))
        for b in batches:
            pair, n = b.column("pair").to_numpy(), b.column("n").to_numpy()
            x, y = pair // WIDE, pair % WIDE
            total[0] += np.bincount(x * wide + classes[y], weights=n, minlength=WIDE * wide)
            total[1] += np.bincount(y * wide + classes[x], weights=n, minlength=WIDE * wide)
        flat = total.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at].astype(np.int64))], ["cell", "n"])

    return run


def _context_counts(pairs: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols x classes) after and before; of a size that CLUSTERED and CLASSES fix."""
    out = np.zeros(2 * WIDE * (CLASSES + 2))
    t = pairs.mapInArrow(_contexts(classes), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[t["cell"].to_numpy()] = t["n"].to_numpy()
    after, before = out.reshape(2, WIDE, CLASSES + 2)
    return after, before


def exchange(classes: np.ndarray, after: np.ndarray, before: np.ndarray, parity: int) -> np.ndarray:
    """One round: every second word moves to the class that explains its contexts best."""
    wide = CLASSES + 2
    g = np.zeros((wide, wide))
    np.add.at(g, classes, after)
    out = classes.copy()
    n = after.sum(axis=1)
    for w in range(parity, CLUSTERED, 2):
        if not n[w]:
            continue
        c, left = classes[w], g.copy()
        left[c, :] -= after[w]
        left[:, c] -= before[w]
        left = np.maximum(left, 0) + A
        size = left.sum(axis=1)
        gain = np.log(left) @ after[w] - n[w] * np.log(size)
        gain += before[w] @ (np.log(left) - np.log(size)[:, None])
        gain -= n[w] * np.log(size + n[w])
        out[w] = int(np.argmax(gain[:CLASSES]))
    return out


def likelihood(g: np.ndarray, size: np.ndarray) -> float:
    """What of the class bigram log-likelihood depends on the classes: transition counts g, words in each class."""
    ent = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    return ent(g) - ent(g.sum(axis=1)) - ent(size)


def _transitions(classes: np.ndarray, after: np.ndarray) -> np.ndarray:
    g = np.zeros((CLASSES + 2, CLASSES + 2))
    np.add.at(g, classes, after)
    return g


def _around(shared):
    """How often each class stands after (side 0) or before (side 1) each word of the head that has no class yet."""
    wide = CLASSES + 2

    def merged(held) -> tuple[np.ndarray, np.ndarray]:
        u, inverse = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        return u, np.bincount(inverse, weights=np.concatenate([x[1] for x in held])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cls, named = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            for w in words(column(b, "text"), SPACED):
                at = _lookup(table, w.h)
                own = np.where(at >= 0, cls[at] if len(cls) else CLASSES, CLASSES)
                free = np.where((at >= 0) & ~(named[at] if len(named) else False), at, -1)
                before, now, _ = _chain(own, w.bounds, CLASSES + 1)
                prev, cur, _ = _chain(free, w.bounds, -1)
                x, y = np.flatnonzero(prev >= 0), np.flatnonzero(cur >= 0)
                held.append(np.unique(np.concatenate([prev[x] * 2 * wide + now[x], (cur[y] * 2 + 1) * wide + before[y]]), return_counts=True))
                if sum(len(k[0]) for k in held) > 2_000_000:
                    held = [merged(held)]
                    if len(held[0][0]) > 1_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["cell", "n"])
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], ["cell", "n"])

    return run


def _move(g: np.ndarray):
    """The best class of each word by its contexts (cells), given the transitions g between the classes."""
    wide = CLASSES + 2
    left = g + A
    log, size = np.log(left), left.sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = b.column("cells")
            flat, row = cells.flatten(), np.repeat(np.arange(b.num_rows), np.diff(cells.offsets.to_numpy()))
            seen = np.zeros((b.num_rows, 2, wide))
            cell = flat.field("cell").to_numpy()
            np.add.at(seen, (row, cell // wide % 2, cell % wide), flat.field("n").to_numpy())
            after, before = seen[:, 0], seen[:, 1]
            n = after.sum(axis=1)[:, None]
            gain = after @ log.T - n * np.log(size) + before @ (log - np.log(size)[:, None]) - n * np.log(size + n)
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(gain[:, :CLASSES].argmax(axis=1))], ["word", "class"])

    return run


def _count_classes(shared):
    wide = CLASSES + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cls, _ = shared.value
        total = np.zeros(wide * wide, dtype=np.int64)
        for b in batches:
            for w in words(column(b, "text"), SPACED):
                at = _lookup(table, w.h)
                prev, cur, _ = _chain(np.where(at >= 0, cls[at] if len(cls) else CLASSES, CLASSES), w.bounds, CLASSES + 1)
                total += np.bincount(prev * wide + cur, minlength=wide * wide)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    return run


#: What the scan for words beyond the head writes: for cell >= 0 a word and its neighbour's class and side, for BOTH two
#: neighbours beyond the head (word, other), for COUNTS a cell of the transitions (word) and its count (other).
TAIL, BOTH, COUNTS = "word long, cell int, other long", -1, -2


def _tail_contexts(shared):
    wide = CLASSES + 2

    def batch(word: np.ndarray, cell: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(cell.astype(np.int32)), pa.array(other, pa.int64())], ["word", "cell", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cls, _ = shared.value
        total = np.zeros(wide * wide, dtype=np.int64)
        for b in batches:
            for w in words(column(b, "text"), SPACED):
                at = _lookup(table, w.h)
                prev, cur, _ = _chain(np.where(at >= 0, cls[at] if len(cls) else CLASSES, CLASSES), w.bounds, CLASSES + 1)
                left, right, _ = _chain(w.h.view(np.int64), w.bounds, 0)
                total += np.bincount(prev * wide + cur, minlength=wide * wide)
                # All words of the head have a class: what is in CLASSES is beyond it.
                x, y = np.flatnonzero(prev == CLASSES), np.flatnonzero(cur == CLASSES)
                both = x[cur[x] == CLASSES]
                word = np.concatenate([left[x], right[y], left[both]])
                other = np.concatenate([np.zeros(len(x) + len(y), dtype=np.int64), right[both]])
                yield batch(word, np.concatenate([cur[x], wide + prev[y], np.full(len(both), BOTH)]), other)
        at = np.flatnonzero(total)
        yield batch(at, np.full(len(at), COUNTS), total[at])

    return run


def _move_tail(g: np.ndarray):
    """The best class and the count of each word by the list of its cells; at the end of a task, as rows without a class, the
    transitions (word) between these words and words of the head, with their counts (n)."""
    wide = CLASSES + 2
    left = g + A
    log, size = np.log(left), left.sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide), dtype=np.int64)
        for full in batches:
            for start in range(0, full.num_rows, 4096):
                b = full.slice(start, 4096)
                cells = b.column("cells")
                row = np.repeat(np.arange(b.num_rows), np.diff(cells.offsets.to_numpy()))
                seen = np.bincount(row * 2 * wide + cells.flatten().to_numpy(), minlength=b.num_rows * 2 * wide).reshape(-1, 2, wide)
                after, before = seen[:, 0], seen[:, 1]
                n = after.sum(axis=1)
                many = n[:, None]
                gain = after @ log.T - many * np.log(size) + before @ (log - np.log(size)[:, None]) - many * np.log(size + many)
                best = gain[:, :CLASSES].argmax(axis=1)
                np.add.at(total, best, after)
                np.add.at(total.T, best, before)
                yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(best, pa.int64()), pa.array(n, pa.int64())], ["word", "class", "n"])
        # Pairs of two such words are counted once both have a class.
        total[CLASSES], total[:, CLASSES] = 0, 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.nulls(len(at), pa.int64()), pa.array(total.ravel()[at])], ["word", "class", "n"])

    return run


def _with_tail(src: DataFrame, shared) -> tuple[np.ndarray, DataFrame]:
    """The transitions, all training words having a class, and the table (h, n, class) of those beyond the head."""
    wide = CLASSES + 2

    def square(rows: pa.Table) -> np.ndarray:
        out = np.zeros(wide * wide)
        out[rows["word"].to_numpy()] = rows["n"].to_numpy()
        return out.reshape(wide, wide)

    seen = materialize(src.mapInArrow(_tail_contexts(shared), TAIL), "tail")
    g = square(seen.where(F.col("cell") == COUNTS).groupBy("word").agg(F.sum("other").alias("n")).toArrow())
    lists = seen.where("cell >= 0").groupBy("word").agg(F.collect_list("cell").alias("cells"))
    moved = materialize(lists.mapInArrow(_move_tail(g), "word long, class long, n long"), "tail")
    tail = moved.where("class is not null").select(F.col("word").alias("h"), "n", "class")
    g[CLASSES], g[:, CLASSES] = 0, 0
    g += square(moved.where("class is null").groupBy("word").agg(F.sum("n").alias("n")).toArrow())
    pairs = seen.where(F.col("cell") == BOTH).groupBy("word", "other").agg(F.count(F.lit(1)).alias("k"))
    for c in ("word", "other"):
        pairs = pairs.join(tail.select(F.col("h").alias(c), F.col("class").alias(f"c_{c}")), c)
    cell = F.col("c_word") * wide + F.col("c_other")
    g += square(pairs.groupBy(cell.alias("word")).agg(F.sum("k").alias("n")).toArrow())
    discard(seen)
    return g, tail


def head_of(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts), most frequent first, of the words with at least the count that leaves HEAD words or fewer."""
    kinds = vocabulary.groupBy("n").agg(F.count(F.lit(1)).alias("kinds")).toArrow()
    order = np.argsort(-kinds["n"].to_numpy())
    n, upto = kinds["n"].to_numpy()[order], np.cumsum(kinds["kinds"].to_numpy()[order])
    fits = int((upto <= HEAD).sum())
    if not fits:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    head = vocabulary.where(F.col("n") >= int(n[fits - 1])).toArrow()
    h, n = unsigned(head["h"]), head["n"].to_numpy().astype(np.int64)
    rank = np.lexsort((h.view(np.int64), -n))
    return h[rank], n[rank]


def fit(train: DataFrame, text_col: str = "text", tail: bool = False) -> tuple[Model, DataFrame]:
    """The model and the table (h, n, class) of the words of the training texts that are not in its head: with tail each has
    a class by its own contexts, otherwise they are one class."""
    src = train.select(F.col(text_col).alias("text"))
    vocabulary = materialize(src.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "vocabulary")
    distinct, total = vocabulary.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = src.count()
    tokens, distinct_all = int(total) + ends, int(distinct) + (ends > 0)
    h, n = head_of(vocabulary)
    top = h[:CLUSTERED]
    pairs = materialize(src.mapInArrow(_count_bigrams(top), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "bigrams")
    classes = np.append(np.arange(CLUSTERED) % CLASSES, [CLASSES, CLASSES + 1])
    after, before = _context_counts(pairs, classes)
    words_in = lambda c: np.bincount(c, weights=after.sum(axis=1), minlength=CLASSES + 2)
    reached = likelihood(_transitions(classes, after), words_in(classes))
    for k in range(ROUNDS):
        moved = exchange(classes, after, before, k % 2)
        new = _context_counts(pairs, moved)
        now = likelihood(_transitions(moved, new[0]), words_in(moved))
        if now <= reached:
            break
        classes, reached, (after, before) = moved, now, new
    g = _transitions(classes, after)
    order = np.argsort(h)
    own, named = np.full(len(h), CLASSES), np.zeros(len(h), dtype=bool)
    own[: len(top)], named[: len(top)] = classes[: len(top)], True
    table, own, named = h[order], own[order], named[order]
    spark = train.sparkSession
    cells = src.mapInArrow(_around(spark.sparkContext.broadcast((table, own, named))), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # Two counts a class at most stand in one word's list.
    lists = cells.groupBy(F.floor(F.col("cell") / (2 * (CLASSES + 2))).alias("word")).agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
    got = lists.mapInArrow(_move(g), "word long, class long").toArrow()
    own[got["word"].to_numpy()] = got["class"].to_numpy()
    shared = spark.sparkContext.broadcast((table, own, named))
    many = n[order]
    size, kinds = np.bincount(own, weights=many, minlength=CLASSES + 1), np.bincount(own, minlength=CLASSES + 1).astype(float)
    if tail and len(h) < int(distinct):
        g, rest = _with_tail(src, shared)
        sums = rest.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).toArrow()
        size[sums["class"].to_numpy()] += sums["n"].to_numpy()
        kinds[sums["class"].to_numpy()] += sums["kinds"].to_numpy()
    else:
        counted = src.mapInArrow(_count_classes(shared), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        g = np.zeros((CLASSES + 2) ** 2)
        g[counted["cell"].to_numpy()] = counted["n"].to_numpy()
        g = g.reshape(CLASSES + 2, CLASSES + 2)
        rest = vocabulary.withColumn("class", F.lit(CLASSES).cast("long"))
    step = np.log10(g + A) - np.log10(g.sum(axis=1) + A * (CLASSES + 2))[:, None]
    size[CLASSES], kinds[CLASSES] = int(total) - size[:CLASSES].sum(), int(distinct) - kinds[:CLASSES].sum()
    return Model(table, many, own, step, np.log10(size + A * (kinds + 1)), tokens, distinct_all, ends), rest


#: Per row: its distinct words that are not in the head with how often they stand, and the transitions from or to such words;
#: `open` says which ends are hashes (1 the first, 2 the second), the others are classes.
OPEN = "tail array<struct<h: long, times: long>>, steps array<struct<x: long, y: long, open: int>>"


def _lists(cuts: np.ndarray, **fields: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        gain = np.log10(m.head_n + A)
        base_end = np.log10(m.ends + A) - m.base_den
        for b in batches:
            for w in words(column(b, "text"), SPACED):
                rows = np.repeat(np.arange(w.n), np.diff(w.bounds))
                at = _lookup(m.head, w.h)
                known = at >= 0
                cls = np.where(known, m.head_class[at] if len(m.head) else CLASSES, CLASSES)
                lift = np.where(known, gain[at] if len(m.head) else 0.0, 0.0)
                prev, cur, starts = _chain(cls, w.bounds, CLASSES + 1)
                size = np.diff(w.bounds)
                ends = (prev == CLASSES) + 2 * (cur == CLASSES)
                steps = np.add.reduceat(np.where(ends == 0, m.step[prev, cur], 0.0), starts) if w.n else np.zeros(0)
                per_row = lambda x: np.bincount(rows, weights=x, minlength=w.n)
                lifts = per_row(lift)
                base = lifts - size * m.base_den + base_end
                score = steps + lifts - per_row(np.where(known, m.emit[cls], 0.0))
                n_known = per_row(known).astype(np.int64) + (m.ends > 0)
                out = np.flatnonzero(~known)
                out = out[np.lexsort((w.h[out], rows[out]))]
                first = np.flatnonzero(np.append(True, (np.diff(rows[out]) != 0) | (w.h[out][1:] != w.h[out][:-1]))[: len(out)])
                tail = _lists(np.searchsorted(rows[out][first], np.arange(w.n + 1)), h=signed(w.h[out][first]), times=pa.array(np.diff(np.append(first, len(out))), pa.int64()))
                left, right, _ = _chain(w.h.view(np.int64), w.bounds, 0)
                some = np.flatnonzero(ends)
                x, y = np.where(prev == CLASSES, left, prev)[some], np.where(cur == CLASSES, right, cur)[some]
                moves = _lists(np.searchsorted(some, np.append(starts, len(prev))), x=pa.array(x), y=pa.array(y), open=pa.array(ends[some].astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(w.row0, w.n) for c in ("row", "id", "held_out")] + [pa.array(size + 1, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base), pa.array(score), tail, moves],
                    ["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "tail", "steps"],
                )

    return run


def _resolved(shared):
    """Adds what words outside the head give; found has the row's words (h, times) with count and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for b in batches:
            found, steps = b.column("found"), b.column("steps")
            of = lambda c: np.repeat(np.arange(b.num_rows), np.diff(c.offsets.to_numpy()))
            per_row = lambda r, x: np.bincount(r, weights=x, minlength=b.num_rows)
            row, flat = of(found), found.flatten()
            h, times, n, cls = (flat.field(c).to_numpy() for c in ("h", "times", "n", "class"))
            lift = per_row(row, times * np.log10(n + A))
            # A word's class is the same in all rows.
            table, first = np.unique(h, return_index=True)
            row_of, flat = of(steps), steps.flatten()
            ends, move = flat.field("open").to_numpy(), []
            for bit, c in ((1, "x"), (2, "y")):
                x = flat.field(c).to_numpy().copy()
                hashed = np.flatnonzero(ends & bit)
                x[hashed] = cls[first[np.searchsorted(table, x[hashed])]]
                move.append(x)
            base = b.column("base").to_numpy() + lift
            score = b.column("score").to_numpy() + lift - per_row(row, times * m.emit[cls]) + per_row(row_of, m.step[move[0], move[1]])
            n_known = b.column("n_known").to_numpy() + per_row(row, times * (n > 0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "held_out", "n_tokens")] + [pa.array(n_known), pa.array(base), pa.array(score)], ["id", "held_out", "n_tokens", "n_known", "base", "score"])

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that learning doesn't see: crc32 of the id as text is divisible by 10."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: bool = False) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity; learned from rows not held out.

    With tail each training word has a class by its contexts, however rare; otherwise those beyond the head share one.
    """
    model, rest = fit(docs.where(~held_out(id_col)), text_col, tail)
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    fields = f"id {dict(src.dtypes)['id']}, held_out boolean, n_tokens long, n_known long, base double, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Written once: row numbers are settled by the write.
    table = materialize(src.mapInArrow(_score(shared), f"row long, {fields}, {OPEN}"), "scores")
    rare = table.select("row", F.explode("tail").alias("t")).select("row", "t.h", "t.times").join(rest, "h", "left")
    found = F.struct("h", "times", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("class", F.lit(CLASSES)).cast("long").alias("class"))
    more = rare.groupBy("row").agg(F.collect_list(found).alias("found"))
    out = table.drop("tail").join(more, "row", "left").withColumn("found", F.coalesce("found", F.array().cast(dict(more.dtypes)["found"])))
    out = out.mapInArrow(_resolved(shared), fields)
    out = out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op9_class_lm(spark, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), tail=True)
