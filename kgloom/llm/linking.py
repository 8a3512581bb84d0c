"""Connected groups of similar items from shared bucket keys, without listing all pairs of a bucket.

1. Star: each item of a bucket is paired with the bucket's smallest id only; a bucket of more than FAN items is dealt into
   parts, each with a head of its own, and the heads are paired with the smallest. Pairs whose sketches rule a link out go.
   For each item the pair with the best sketch score is verified in full, and the links give components.
2. A bucket whose items are all in one component is done. In every other one, items of different components are compared by
   their sketches, inside tasks: small buckets many at a time, large ones in blocks of at most BLOCK by BLOCK items, where
   only items outside the bucket's largest component meet the others. What passes is verified in full; a large block gives
   the BEST pairs of each item, which join most.
3. What large blocks of buckets in which an item had more pairs still have to compare is compared to the end: the items that may be linked get their contents, and the
   links that join components are found inside the block, so a block returns no more links than it has items.

Items that share several large buckets are compared in the one of the least key only: a block's rows bring the keys of their
large buckets. A key that drops out between 2 and 3 holds one component, so pairs that still differ never count on it.

Every pair that shares a bucket thus ends in one component or has been tested; no bucket is capped. Only components of
verified links matter, so unrelated items that share buckets never grow into one family. Blocks are bounded in items and in
bytes of contents; contents are joined to items that a sketch lets pass alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .storage import bloom, discard, materialize, passes

FAN, SMALL, BLOCK, BEST, BLOCK_BYTES = 1024, 64, 1536, 1, 32 << 20


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """(id, component) for every id in edges (a, b): the smallest id reachable.

    Each round maps every vertex to the smallest of itself and its neighbours, follows that map four steps, so that a chain
    shrinks to a quarter and a star to a point, and contracts the edges. Rounds are cut by written tables. No edges give no
    rows; self loops and repeats are harmless.
    """
    edges = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), tag)
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = to = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p")), tag)
        for _ in range(2):
            to = to.join(to.select(F.col("v").alias("p"), F.col("p").alias("q")), "p").select("v", F.col("q").alias("p"))
        to = materialize(to, tag)
        discard(near)
        maps.append(to)
        a, b = to.select(F.col("v").alias("a"), F.col("p").alias("pa")), to.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        last, edges = edges, materialize(edges.join(a, "a").join(b, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), tag)
        discard(last)
    if not maps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    out = maps[0].select(F.col("v").alias("id"), F.col("p").alias("component"))
    for m in maps[1:]:
        out = out.join(m, out.component == m.v, "left").select("id", F.coalesce("p", "component").alias("component"))
    out = materialize(out, tag)
    discard(edges, *maps)
    return out


@dataclass(frozen=True)
class Likeness:
    """How items are compared.

    fields turns a column of sketches into a matrix with a row each; score gives, for two such matrices row by row or
    (cross) for all pairs, the score and the least score worth verifying. prepare turns a column of contents into items;
    same(items, items, i, j) verifies pairs of them.
    """

    fields: Callable[[pa.Array], np.ndarray]
    score: Callable[[np.ndarray, np.ndarray, bool], tuple[np.ndarray, np.ndarray]]
    prepare: Callable[[pa.Array], list]
    same: Callable[[list, list, np.ndarray, np.ndarray], np.ndarray]


def _passing(like: Likeness):
    """The pairs (a, b) whose sketches (sa, sb) allow a link, with their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, least = like.score(like.fields(b.column("sa")), like.fields(b.column("sb")), False)
            ok = np.flatnonzero(s >= least)
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(ok)), b.column("b").take(pa.array(ok)), pa.array(s[ok], pa.float64())], ["a", "b", "score"])

    return run


def _verified(like: Likeness):
    """The pairs (a, b) whose contents (ta, tb) are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                left, right = like.prepare(part.column("ta")), like.prepare(part.column("tb"))
                ok = like.same(left, right, np.arange(part.num_rows), np.arange(part.num_rows))
                yield part.select(["a", "b"]).filter(pa.array(ok))

    return run


#: key: the large bucket of the pair.
FOUND = "a long, b long, more boolean, key long"


def _found(ids: np.ndarray, x: np.ndarray, y: np.ndarray, more: np.ndarray, key: int | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[x], ids[y])), pa.array(np.maximum(ids[x], ids[y])), pa.array(more), pa.array([key] * len(x), pa.int64())], ["a", "b", "more", "key"])


def _within_small(like: Likeness):
    """Pairs of different components in small buckets; rows (key, id, comp, sketch) come sorted by key."""

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, ids, comp = (t[c].to_numpy() for c in ("key", "id", "comp"))
        x = like.fields(t["sketch"].combine_chunks())
        for far in range(1, min(SMALL, len(key))):
            shared = key[far:] == key[:-far]
            if not shared.any():
                break
            i = np.flatnonzero(shared & (comp[far:] != comp[:-far]))
            for at in range(0, len(i), 4096):
                p = i[at : at + 4096]
                s, least = like.score(x[p], x[p + far], False)
                p = p[s >= least]
                if len(p):
                    yield _found(ids, p, p + far, np.zeros(len(p), dtype=bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b] if rest is None else [*rest.to_batches(), b])
            key = t["key"].to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            yield from pairs(t.slice(0, cut))
            rest = t.slice(cut)
        if rest is not None:
            yield from pairs(rest)

    return run


def _met_before(t: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs (left x right) of a block's rows share a large bucket of a key less than the block's."""
    keys = t["keys"].combine_chunks()
    flat, row = keys.flatten().to_numpy(), np.repeat(np.arange(len(keys)), np.diff(keys.offsets.to_numpy()))
    less = flat < t["key"][0].as_py()
    _, which, many = np.unique(flat[less], return_inverse=True, return_counts=True)
    row, which = row[less][many[which] > 1], which[many[which] > 1]
    met = np.zeros((len(left), len(right)), dtype=bool)
    # So many keys at a time that their matrix stays small.
    for at in range(0, len(many), 512):
        some = (which >= at) & (which < at + 512)
        if some.any():
            held = np.zeros((t.num_rows, min(512, len(many) - at)), dtype=np.float32)
            held[row[some], which[some] - at] = 1
            met |= held[left] @ held[right].T > 0
    return met


def _survivors(like: Likeness, t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, score) of pairs of different components in one block, row numbers of t, that sketches let pass and that
    no block of a lesser key compares."""
    comp = t["comp"].to_numpy()
    left, right = (np.flatnonzero(t[c].to_numpy()) for c in ("l", "r"))
    mine = (comp[left][:, None] != comp[right][None, :]) & ~_met_before(t, left, right)
    li, ri = np.nonzero(mine)
    x = like.fields(t["sketch"].combine_chunks())
    if 4 * len(li) > mine.size:
        s, least = like.score(x[left], x[right], True)
        ok = (s >= least)[li, ri]
        li, ri = li[ok], ri[ok]
        return left[li], right[ri], s[li, ri]
    parts = [(np.zeros(0, dtype=np.int64), np.zeros(0))]
    for at in range(0, len(li), 4096):
        s, least = like.score(x[left[li[at : at + 4096]]], x[right[ri[at : at + 4096]]], False)
        ok = np.flatnonzero(s >= least)
        parts.append((at + ok, s[ok]))
    ok = np.concatenate([p for p, _ in parts])
    return left[li[ok]], right[ri[ok]], np.concatenate([s for _, s in parts])


def _best(like: Likeness, best: int):
    """Of one block the best pairs of each item on the left."""

    def run(t: pa.Table) -> pa.Table:
        x, y, score = _survivors(like, t)
        order = np.lexsort((-score, x))
        x, y = x[order], y[order]
        rank = np.arange(len(x)) - np.searchsorted(x, x)
        more = np.append(rank[1:] == best, False)[: len(x)]
        keep = rank < best
        return pa.Table.from_batches([_found(t["id"].to_numpy(), x[keep], y[keep], more[keep], t["key"][0].as_py())])

    return run


def _open(like: Likeness):
    """The rows of a block that stand in a pair its sketches let pass."""

    def run(t: pa.Table) -> pa.Table:
        x, y, _ = _survivors(like, t)
        return t.take(pa.array(np.unique(np.concatenate([x, y])))).select(["blk", "key", "id", "comp", "l", "r"])

    return run


def _links(like: Likeness):
    """Links of one block that join components, the likeliest pairs first; rows: key, id, comp, l, r, sketch, keys, text."""

    def run(t: pa.Table) -> pa.Table:
        ids, comp = t["id"].to_numpy(), t["comp"].to_numpy()
        x, y, score = _survivors(like, t)
        order = np.lexsort((-score, x))
        x, y = x[order], y[order]
        items = like.prepare(t["text"].combine_chunks())
        root = {int(c): int(c) for c in comp}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        links = []
        while len(x):
            now = np.arange(len(x)) - np.searchsorted(x, x) < 8
            ok = like.same(items, items, x[now], y[now])
            for i, j in zip(x[now][ok], y[now][ok]):
                a, b = find(int(comp[i])), find(int(comp[j]))
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((int(ids[i]), int(ids[j])))
            at = np.array([find(int(c)) for c in comp])
            keep = ~now & (at[x] != at[y])
            x, y = x[keep], y[keep]
        return pa.table({"a": pa.array([min(p) for p in links], pa.int64()), "b": pa.array([max(p) for p in links], pa.int64())})

    return run


def _salted(of: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(of), parts.cast("long"))


def _star(rows: DataFrame, tag: str) -> DataFrame:
    """Distinct pairs (a, b) of each item with its bucket's head; rows: key, id, head, n."""
    plain = rows.where(F.col("n") <= FAN).select(F.col("head").alias("a"), F.col("id").alias("b"))
    hot = rows.where(F.col("n") > FAN).withColumn("part", _salted(F.col("id"), F.ceil(F.col("n") / FAN)))
    tops = hot.groupBy("key", "part").agg(F.min("id").alias("a"), F.first("head").alias("head"))
    dealt = hot.join(tops.select("key", "part", "a"), ["key", "part"]).select("a", F.col("id").alias("b"))
    return plain.unionAll(dealt).unionAll(tops.select(F.col("head").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()


def _apart(rows: DataFrame, comp: DataFrame, tag: str) -> DataFrame:
    """The rows, with their components, of buckets that hold more than one component."""
    named = rows.join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    mixed = named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    return materialize(named.join(mixed, "key"), tag)


def _small_pairs(apart: DataFrame, sketches: DataFrame, like: Likeness) -> DataFrame:
    """(a, b, more, key): pairs of different components in a small bucket that sketches let pass."""
    small = apart.where(F.col("n") <= SMALL).select("key", "id", "comp").join(sketches, "id").select("key", "id", "comp", "sketch")
    return small.repartition("key").sortWithinPartitions("key").mapInArrow(_within_small(like), FOUND)


def _blocks(large: DataFrame) -> DataFrame:
    """(blk, key, id, comp, l, r): the large buckets (key, id, comp, bytes) cut into blocks, in which items on the left meet
    those on the right."""
    sizes = large.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    mains = sizes.groupBy("key").agg(F.max(F.struct("n", (-F.col("comp")).alias("c"), "bytes")).alias("x"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    chunks = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")
    mains = mains.select("key", (-F.col("x.c")).alias("main"), chunks(F.col("n") - F.col("x.n"), F.col("bytes") - F.col("x.bytes")).alias("oc"), chunks(F.col("x.n"), F.col("x.bytes")).alias("mc"))
    rows = large.select("key", "id", "comp").join(mains, "key").withColumn("out", F.col("comp") != F.col("main"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1)).alias("j")
    block = lambda i, j, kind: [F.xxhash64("key", i.cast("long"), j.cast("long"), F.lit(kind)).alias("blk"), "key"]
    outs = rows.where("out").withColumn("c", _salted(F.col("id"), F.col("oc")))
    # An outsider's chunk i meets the outsiders' chunks j >= i (as left side), j < i (as right side) and all main chunks.
    meets = outs.select("key", "id", "comp", "c", every(F.col("oc"))).select(*block(F.least("c", "j"), F.greatest("c", "j"), 0), "id", "comp", (F.col("c") <= F.col("j")).alias("l"), (F.col("c") >= F.col("j")).alias("r"))
    ahead = outs.select("key", "id", "comp", "c", every(F.col("mc"))).select(*block(F.col("c"), F.col("j"), 1), "id", "comp", F.lit(True).alias("l"), F.lit(False).alias("r"))
    core = rows.where("not out").withColumn("c", _salted(F.col("id"), F.col("mc")))
    core = core.select("key", "id", "comp", "c", every(F.col("oc"))).select(*block(F.col("j"), F.col("c"), 1), "id", "comp", F.lit(False).alias("l"), F.lit(True).alias("r"))
    return meets.unionAll(ahead).unionAll(core)


#: Keys that a task packs at a time, and that a group of packed keys holds on average.
FLUSH, PACK = 1 << 21, 1 << 18


def _packed(emit: Callable[[Callable], Callable], bits: int):
    """(part, keys): each task's keys, none more than twice a flush, sorted and packed by their first bits."""
    every = emit(lambda keys: np.ones(len(keys), dtype=bool))

    def flush(found: list[np.ndarray]) -> pa.RecordBatch:
        x = np.sort(np.concatenate(found))
        third = np.append(np.zeros(2, dtype=bool), x[2:] == x[:-2])[: len(x)]
        x = x[~third]
        part = (x >> np.uint64(64 - bits)).astype(np.int64)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        ends = (8 * np.append(first, len(x))).astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(x)])
        return pa.RecordBatch.from_arrays([pa.array(part[first]), blobs], ["part", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for b in every(batches):
            found.append(b.column("key").to_numpy().view(np.uint64))
            n += b.num_rows
            if n >= FLUSH:
                yield flush(found)
                found, n = [], 0
        if n:
            yield flush(found)

    return run


def _repeated(t: pa.Table) -> pa.Table:
    """The distinct keys that the packed keys of a part hold more than once."""
    x = np.sort(np.frombuffer(b"".join(t["keys"].to_pylist()), dtype=np.uint64))
    return pa.table({"key": np.unique(x[1:][x[1:] == x[:-1]]).view(np.int64)})


def shared_buckets(table: DataFrame, emit: Callable[[Callable], Callable], many: Column, tag: str) -> DataFrame:
    """The distinct (key, id) whose key stands in several rows. emit(keep) makes a function for mapInArrow that gives the keys
    (key, id) of the table's rows for which keep(keys) holds; many is a bound on a row's number of keys.

    Most keys stand in one row only: keys are counted by themselves, in parts of about PACK keys, and a filter of fixed size
    drops most of the others where they are made; it loses none that is shared. A task sends a key twice a flush at most, so
    a part stays small however common its keys are.
    """
    total = table.agg(F.sum(many.cast("long"))).first()[0] or 0
    bits = max(1, int(np.ceil(np.log2(max(total, 1) / PACK))))
    packed = table.mapInArrow(_packed(emit, bits), "part long, keys binary")
    again = materialize(packed.groupBy("part").applyInArrow(_repeated, "key long"), tag)
    filled = table.sparkSession.sparkContext.broadcast(bloom(again, "key"))
    rows = table.mapInArrow(emit(lambda keys: passes(keys, filled.value)), "key long, id long")
    out = materialize(rows.join(again, "key", "left_semi").distinct(), tag)
    discard(again)
    return out


def link_groups(buckets: DataFrame, sketches: DataFrame, payload: Callable[[DataFrame], DataFrame], like: Likeness, tag: str) -> tuple[DataFrame, DataFrame]:
    """Components of similar items, and the links found; items without a link are in neither.

    buckets: (key, id), without repeats, such as shared_buckets gives, discarded at the end; sketches: (id, sketch, bytes), bytes the size of an item's contents; payload(ids)
    gives (id, text) of a table of ids.
    """
    # A bucket's least id and size come from a map-side combined aggregate; joining back splits hot keys at run time.
    heads = buckets.groupBy("key").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = materialize(buckets.join(heads, "key").select("key", "id", "head", "n"), tag)
    done = [buckets, rows]
    drawn = sketches.select("id", "sketch")
    ends = [drawn.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}")) for c in "ab"]
    star = _star(rows, tag).join(ends[0], "a").join(ends[1], "b").select("a", "b", "sa", "sb")
    star = materialize(star.mapInArrow(_passing(like), "a long, b long, score double"), tag)

    def contents(ids: DataFrame) -> DataFrame:
        wanted = materialize(ids.distinct(), tag)
        texts = materialize(payload(wanted).select("id", "text"), tag)
        discard(wanted)
        return texts

    def verified(pairs: DataFrame) -> DataFrame:
        texts = contents(pairs.select(F.explode(F.array("a", "b")).alias("id")))
        ta, tb = (texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
        # The side that may repeat is joined while rows are thin.
        out = materialize(pairs.select("a", "b").join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(_verified(like), "a long, b long"), tag)
        discard(texts)
        return out

    best = materialize(star.groupBy("b").agg(F.max(F.struct("score", (-F.col("a")).alias("m"))).alias("x")).select((-F.col("x.m")).alias("a"), "b"), tag)
    links = verified(best)
    comp = components(links, tag)

    # The star has compared the buckets of two.
    apart = _apart(rows.where("n > 2").select("key", "id", "n"), comp, tag)
    large = apart.where(F.col("n") > SMALL).select("key", "id", "comp")
    met = materialize(large.groupBy("id").agg(F.collect_list("key").alias("keys")).join(sketches, "id").select("id", "sketch", "keys", "bytes"), tag)
    # Written once: blocks are cut by sizes of the same rows.
    large = materialize(large.join(met.select("id", "bytes"), "id"), tag)
    shown = met.select("id", "sketch", "keys")
    blocks = _blocks(large).join(shown, "id").select("blk", "key", "id", "comp", "l", "r", "sketch", "keys")
    found = _small_pairs(apart, drawn, like).unionAll(blocks.groupBy("blk").applyInArrow(_best(like, BEST), FOUND))
    a, b = (comp.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    other = star.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
    raw = materialize(found.unionAll(other.select("a", "b", F.lit(False), F.lit(None).cast("long"))), tag)
    found = raw
    tested = best.select("a", "b", F.lit(True).alias("tested"))
    found = materialize(found.groupBy("a", "b").agg(F.max("more").alias("more")).join(tested, ["a", "b"], "left"), tag)
    discard(star, best, apart)
    done += [found, met, large, raw]
    fresh = found.where("tested is null")
    # A pair that the star has tested may still say that its block has more.
    if found.where("more or tested is null").isEmpty():
        discard(*done)
        return comp, links
    links = links.unionAll(verified(fresh))
    done.append(comp)
    comp = components(links, tag)
    if found.where("more").isEmpty():
        discard(*done)
        return comp, links

    unfinished = large.drop("comp").join(raw.where("more").select("key").distinct(), "key", "left_semi")
    apart = _apart(unfinished, comp, tag)
    blocks = _blocks(apart).join(shown, "id").select("blk", "key", "id", "comp", "l", "r", "sketch", "keys")
    still = materialize(blocks.groupBy("blk").applyInArrow(_open(like), "blk long, key long, id long, comp long, l boolean, r boolean"), tag)
    done += [apart, still]
    if not still.isEmpty():
        texts = contents(still.select("id"))
        full = still.join(shown.join(texts, "id"), "id").select("blk", "key", "id", "comp", "l", "r", "sketch", "keys", "text")
        links = links.unionAll(materialize(full.groupBy("blk").applyInArrow(_links(like), "a long, b long"), tag))
        done += [texts, comp]
        comp = components(links, tag)
    discard(*done)
    return comp, links
