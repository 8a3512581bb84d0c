"""Source divergence audit (operator 12): how the vocabularies of a language's sources differ, in exact arithmetic.

Single-pass in-memory indexing: a task reads its texts once and keeps the postings of a block, (language, source, term) with
the term's occurrences and documents, in memory until BLOCK of them are there; then it spills them as a term-sorted run. Runs
are dealt to hash shards of (language, term). Spark's external sort merges a shard's runs, a heap over sorted spills, and the
task folds equal neighbours of that stream into frequencies: one row a kept term with its count in each source.

Pairs of sources are compared without writing a row for every term of every pair. Of a pair's sum of f over all kept terms, most
terms are absent from one side or both; that part follows from the number of terms at each count. The terms that both sources
hold add a correction each. The rows of a language are dealt over salts of about SHARE terms; each salt streams through its
corrections into one matrix of sources by sources, and hands on one partial sum a pair, in two halves, so that no sum can
overflow. The same pass keeps each source's best terms of the salt.

Defined results: null text, lang and source are empty strings, and these are a language and a source like others; a source
without terms, or of a language that keeps none, has its pairs with value 0 or by its smoothed shares; repeated rows count as
documents of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from .storage import discard, materialize
from .textops import LETTERS, column, distinct, strings, words

#: Postings of a block; kept terms of a salt.
BLOCK, SHARE = 1 << 19, 1 << 16
RUN = "lang string, source string, term string, n long, docs long"
LOW = np.int64(0xFFFFFFFF)


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Where another key begins, in rows sorted by the keys."""
    if not t.num_rows:
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(t.num_rows - 1, dtype=bool)
    for k in keys:
        new |= pc.not_equal(t[k].slice(1), t[k].slice(0, t.num_rows - 1)).to_numpy()
    return np.append(0, 1 + np.flatnonzero(new))


def _added(t: pa.Table, keys: list[str]) -> pa.Table:
    """Rows sorted by the keys, those of equal keys added up."""
    at = _starts(t, keys)
    sums = {c: pa.array(np.add.reduceat(t[c].to_numpy(), at) if len(at) else np.zeros(0, dtype=np.int64)) for c in ("n", "docs")}
    return pa.table({k: t[k].take(pa.array(at)) for k in keys} | sums)


def _runs(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        parts: list[pa.Table] = []
        held = 0

        def spill() -> Iterator[pa.RecordBatch]:
            t = _added(pa.concat_tables(parts).sort_by([("term", "ascending"), ("group", "ascending")]), ["term", "group"])
            lang, source = (pa.array([g[k] for g in groups], pa.string()).take(t["group"]) for k in (0, 1))
            out = pa.table([lang, source, t["term"].cast(pa.string()), t["n"], t["docs"]], names=["lang", "source", "term", "n", "docs"])
            yield from out.combine_chunks().to_batches(max_chunksize=1 << 14)

        for b in batches:
            names = zip(b.column("lang").to_pylist(), b.column("source").to_pylist())
            gid = np.fromiter((groups.setdefault(g, len(groups)) for g in names), np.int64, b.num_rows)
            for w in words(column(b, "text"), LETTERS):
                if not len(w.h):
                    continue
                first, which = distinct(w.data, w.starts, w.ends, w.h)
                d = len(first)
                # A posting: a document and term, with its occurrences.
                key, n = np.unique(w.rows() * d + which, return_counts=True)
                term = strings(w.data, w.starts[first], w.ends[first]).take(pa.array(key % d))
                parts.append(pa.table([pa.array(gid[key // d]), term, pa.array(n), pa.array(np.ones(len(n), dtype=np.int64))], names=["group", "term", "n", "docs"]))
                held += len(key)
                if held >= block:
                    yield from spill()
                    parts, held = [], 0
        if parts:
            yield from spill()

    return run


def _merge(least: int):
    """Folds a shard's stream of postings, sorted by (term, language, source), into a row a kept term."""
    keys = ["term", "lang", "source"]

    def rows(t: pa.Table) -> pa.RecordBatch:
        starts = _starts(t, keys[:2])
        total, docs = (np.add.reduceat(t[c].to_numpy(), starts) for c in ("n", "docs"))
        offsets, at = pa.array(np.append(starts, t.num_rows).astype(np.int32)), pa.array(starts)
        cell = lambda c: t[c].combine_chunks()
        out = pa.table([t["lang"].take(at), t["term"].take(at), pa.array(total), pa.ListArray.from_arrays(offsets, cell("source")), pa.ListArray.from_arrays(offsets, cell("n"))], names=["lang", "term", "total", "sources", "counts"])
        return out.filter(pa.array(docs >= least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for b in batches:
            t = pa.Table.from_batches([b]).select([*keys, "n", "docs"])
            t = _added(t if open_ is None else pa.concat_tables([open_, t]), keys)
            # The last term may go on in the next batch.
            ends = _starts(t, keys[:2])
            cut = int(ends[-1]) if len(ends) else 0
            open_ = t.slice(cut)
            if cut:
                yield from rows(t.slice(0, cut)).combine_chunks().to_batches()
        if open_ is not None and open_.num_rows:
            yield from rows(open_).combine_chunks().to_batches()

    return run


def frequencies(docs: DataFrame, least: int = 3, block: int = BLOCK, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, term, total, sources, counts): the terms in at least `least` documents of their language."""
    src = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    runs = src.mapInArrow(_runs(block), RUN).repartition("lang", "term").sortWithinPartitions("term", "lang", "source")
    return runs.mapInArrow(_merge(least), "lang string, term string, total long, sources array<string>, counts array<long>")


def shares(count: np.ndarray, total: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (total + kept)), by long division in steps of 1,000, so that 64 bits hold all terms."""
    whole, rest, out = total + kept, count + 1, np.int64(0)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Sums:
    """Sums of 64-bit numbers a cell, each in two halves: cell = high * 2^32 + low."""

    def __init__(self, n: int):
        self.high, self.low = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)

    def add(self, cells: np.ndarray, values: np.ndarray, times: np.ndarray | int = 1) -> None:
        np.add.at(self.high, cells, (values >> 32) * times)
        np.add.at(self.low, cells, (values & LOW) * times)


def pair_sums(k: int, terms: int, t: np.ndarray, s: np.ndarray, n: np.ndarray, total: np.ndarray, kept: int) -> Sums:
    """Cell a * k + b: the sum of f over `terms` terms, p from source a and q from source b.

    t, s, n: the postings' terms (ascending), sources and counts, all above 0; total: each source's count of kept terms.
    """
    out, every = Sums(k * k), np.arange(k)
    p, p0 = shares(n, total[s], kept), shares(np.zeros(k, dtype=np.int64), total, kept)
    neither = gap(p0[:, None], p0[None, :])
    out.add(np.arange(k * k), neither.ravel(), terms)
    # Terms of one source against a source without them: by count, of which a source has few different ones.
    at, many = np.unique(np.stack([s, p]), axis=1, return_counts=True) if len(s) else (np.zeros((2, 0), dtype=np.int64), np.zeros(0, dtype=np.int64))
    step = max(1, (1 << 20) // max(k, 1))
    for low in range(0, len(many), step):
        a, pa_, m = at[0, low : low + step, None], at[1, low : low + step, None], many[low : low + step, None]
        out.add((a * k + every).ravel(), (gap(pa_, p0) - neither[a[:, 0]]).ravel(), np.repeat(m.ravel(), k))
        out.add((every * k + a).ravel(), (gap(p0, pa_) - neither[:, a[:, 0]].T).ravel(), np.repeat(m.ravel(), k))
    # Terms of both: what the two one-sided values got wrong. Postings of a term stand together, d places apart.
    i, d = np.arange(max(0, len(t) - 1)), 1
    while len(i := i[: np.searchsorted(i, len(t) - d)]) and len(i := i[t[i] == t[i + d]]):
        for x, y in ((i, i + d), (i + d, i)):
            a, b = s[x], s[y]
            out.add(a * k + b, gap(p[x], p[y]) - gap(p[x], p0[b]) - gap(p0[a], p[y]) + neither[a, b])
        d += 1
    return out


def _compared(top: int):
    def run(rows: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.combine_chunks()
        k, lang, source = groups.num_rows, groups["lang"][0].as_py(), groups["source"].combine_chunks()
        total, kept, whole = groups["total"].to_numpy(), groups["kept"][0].as_py(), groups["lang_total"][0].as_py()
        sizes = pc.list_value_length(rows["sources"]).to_numpy().astype(np.int64)
        t = np.repeat(np.arange(rows.num_rows), sizes)
        s = pc.index_in(pc.list_flatten(rows["sources"]), value_set=source).to_numpy().astype(np.int64)
        n = pc.list_flatten(rows["counts"]).to_numpy()
        a, b = np.divmod(np.arange(k * k), k)
        apart = a != b
        sums = pair_sums(k, rows.num_rows, t, s, n, total, kept) if rows.num_rows else Sums(k * k)
        take = lambda x: source.take(pa.array(x))
        pairs = pa.table([take(a[apart]), pa.array(["pair"] * int(apart.sum()), pa.string()), take(b[apart]), pa.array(sums.high[apart]), pa.array(sums.low[apart])], names=["source", "part", "item", "high", "low"])
        p, q = shares(n, total[s], kept), shares(rows["total"].to_numpy()[t], np.int64(whole), kept)
        up = np.flatnonzero(p > q)
        value = gap(p[up], q[up])
        best = pa.table([take(s[up]), pa.array(["term"] * len(up), pa.string()), rows["term"].take(pa.array(t[up])), pa.array(value >> 32), pa.array(value & LOW)], names=["source", "part", "item", "high", "low"])
        if best.num_rows:
            best = best.append_column("value", pa.array(value)).sort_by([("source", "ascending"), ("value", "descending"), ("item", "ascending")])
            begins = np.flatnonzero(np.append(True, pc.not_equal(best["source"].slice(1), best["source"].slice(0, best.num_rows - 1)).to_numpy()))
            place = np.arange(best.num_rows) - np.repeat(begins, np.diff(np.append(begins, best.num_rows)))
            best = best.filter(pa.array(place < top)).drop_columns(["value"])
        out = pa.concat_tables([pairs, best.cast(pairs.schema)])
        return out.add_column(0, "lang", pa.array([lang] * out.num_rows, pa.string()))

    return run


def audit(docs: DataFrame, least: int = 3, top: int = 200, block: int = BLOCK, share: int = SHARE, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` compares each source with each other one of its language over all kept
    terms, `term` gives the `top` terms by which a source exceeds its language."""
    kept = materialize(frequencies(docs, least, block, lang_col, source_col, text_col), "frequencies")
    salts = kept.count() // share + 1
    name = lambda c, n: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
    occurring = docs.select(name(lang_col, "lang"), name(source_col, "source")).distinct()
    held = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = occurring.join(held, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", zero("total"), zero("kept"), zero("lang_total"))
    groups = materialize(groups, "groups")
    dealt = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(salts)).cast("long"))
    each = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    found = dealt.groupBy("lang", "salt").cogroup(each.groupBy("lang", "salt")).applyInArrow(_compared(top), "lang string, source string, part string, item string, high long, low long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    value = (exact("high") * F.lit(1 << 32).cast("decimal(10,0)") + exact("low")).cast("long")
    # A term is in one salt, a pair in all.
    rows = found.groupBy("lang", "source", "part", "item").agg(value.alias("value"))
    place = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    out = materialize(rows.withColumn("rank", place.cast("int")).where((F.col("part") == "pair") | (F.col("rank") <= top)), "divergence")
    discard(kept, groups)
    return out.select("lang", "source", "part", "item", "value", "rank")


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM k GROUP BY lang),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (t.total + l.v) AS p, 1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS q
  FROM t JOIN l ON l.lang = t.lang JOIN k ON k.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM a)
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 200
"""
