"""Operators 1 to 10 and the pipeline against brute-force versions, with edge cases: nulls, empty and very long texts, ties,
repeated rows, empty tables, clashing extra columns."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from kgloom.llm import byte_bpe, class_lm, code_search, decontamination, language_id, license_scan, line_dedup, linking, near_dedup, secret_scan, storage, textops, token_counts, units

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASH = ["id", "key", "component", "h", "blob", "hits"]


class Shared:
    """Stands for a broadcast value."""

    def __init__(self, value):
        self.value = value


def clash():
    return {c: F.lit(c) for c in CLASH}



def docs(spark, texts, lang="en", start=0):
    return spark.createDataFrame([(start + i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


def awkward(spark):
    """Null ids, null, blank and very long texts, repeated rows, extra columns."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a row without an id but with words"), (4, "word " * 30_000), (5, "same text of five words here"), (5, "same text of five words here"), (6, "ß é 日本 🎉 \x00 x"), (7, "x" * 50_000)]
    return spark.createDataFrame([(i, t, None if i == 7 else "en", None, None) for i, t in rows], DOCS).withColumns(clash())


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- shared -----------------------------------------------------------------


def test_components_match_union_find(spark):
    random.seed(4)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 ------------------------------------------------------------------------


def grams(text):
    d = bytes(language_id.LETTERS[b] for b in b" " + text.encode() + b" ")
    return [d[i : i + 4] for i in range(len(d) - 3) if sum(x != 0x20 for x in d[i : i + 4]) >= 2]


def test_language_votes_match_sets(spark):
    rng = random.Random(2)
    vocab = {"en": "the thing and whether".split(), "de": "und nicht über eine".split(), "fr": "les être avec où".split()}
    rows = [(i, " ".join(rng.choices(vocab[k], k=12)), k, "s", 0) for i, k in enumerate(rng.choices(list(vocab), k=90))]
    df = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(df)
    sets = {k: {g for r in rows if r[2] == k for g in grams(r[1])} for k in vocab}
    counts = {k: collections.Counter(g for r in rows if r[2] == k for g in grams(r[1])) for k in vocab}
    share = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in counts.items()}
    kept = {k: {g for g in s if share[k][g] >= 0.5 * max(share[x].get(g, 0) for x in vocab)} for k, s in sets.items()}
    texts = ["the thing", "nicht über", "avec où les", "the und the", "zzzz"]
    got = language_id.predict(docs(spark, texts), model).orderBy("doc_id").collect()
    for t, r in zip(texts, got):
        g = grams(t)
        votes = {k: sum(x in kept[k] for x in g) / len(g) for k in vocab}
        assert r.score == pytest.approx(max(votes.values()), abs=0.02)
        if max(votes.values()) > 0:
            assert votes[r.lang_pred] == max(votes.values())


def test_more_languages_than_a_word_has_bits(spark):
    """Each of 80 languages has words of its own and must be learned."""
    rows = [(10 * k + i, " ".join(f"{chr(97 + k // 26) * 3}{chr(97 + k % 26) * 3}{c}" for c in "abcd"), f"l{k}", "s", 0) for k in range(80) for i in range(3)]
    df = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(df)
    assert len(model.langs) == 80 and model.slots.shape[1] == 2
    assert {r.doc_id: r.lang_pred for r in language_id.predict(df, model).collect()} == {r[0]: r[2] for r in rows}


def test_language_edges(spark):
    model = language_id.fit(docs(spark, ["the house is there", "the tree"]))
    got = {r.doc_id: r for r in language_id.predict(awkward(spark), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[7].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language_id.fit(empty(spark))
    assert {r.lang_pred for r in language_id.predict(awkward(spark), nothing).collect()} == {"und"}
    assert language_id.predict(empty(spark), model).count() == 0
    kept = language_id.keep_recognised(awkward(spark), model)
    assert kept.columns == awkward(spark).columns and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


# --- 2 ------------------------------------------------------------------------


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_within_matches_edit_distance():
    rng = random.Random(5)
    for _ in range(3000):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [x for x in a if rng.random() < 0.8] if rng.random() < 0.7 else [rng.randrange(4) for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(3)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(5))
        most = rng.randrange(5)
        assert line_dedup.within(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), most) == (edit(a, b) <= most)


def test_simhash_counts_bits():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    cuts = np.array([0, 7, 8, 30])
    got = line_dedup.simhash(h, cuts)
    for k, (lo, hi) in enumerate(zip(cuts, [7, 8, 30, 40])):
        for half in range(2):
            x = line_dedup.mix(h[lo:hi] ^ np.uint64(0xD6E8FEB86659FD93 * (half + 1) & (1 << 64) - 1))
            want = sum(int(2 * int(((x >> np.uint64(b)) & np.uint64(1)).sum()) > hi - lo) << b for b in range(64))
            assert int(got[k, half]) == want


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"word{i}" for i in range(300)]
    base = [" ".join(rng.choices(vocab, k=rng.randrange(4, 40))) for _ in range(60)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(base).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = rng.choice(vocab)
            lines.append((" ".join(w)).title() + rng.choice(["", ".", " !"]))
        rows.append((i, "\n".join(lines)))
    gone = {(r.doc, k) for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() for k in r.removed}
    assert gone == every_link(rows, 0.9)


def every_link(rows, similarity, min_words=1):
    """Removed lines when all pairs of forms are compared by edit similarity alone."""
    forms = {}
    for i, t in rows:
        for k, line in enumerate(t.split("\n")):
            w = tuple(re.findall(rb"[0-9a-z\x80-\xff]+", line.encode().lower()))
            if len(w) >= min_words:
                forms.setdefault(w, []).append((i, k))
    keys = list(forms)
    root = {w: w for w in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in enumerate(keys):
        for y in keys[:a]:
            most = int((1 - similarity) * max(len(x), len(y)) + 1e-9)
            if abs(len(x) - len(y)) <= most and sum((collections.Counter(x) & collections.Counter(y)).values()) >= max(len(x), len(y)) - most and edit(x, y) <= most:
                root[find(x)] = find(y)
    groups = collections.defaultdict(list)
    for w in keys:
        groups[find(w)] += forms[w]
    return {p for g in groups.values() for p in g if p != min(g)}


@pytest.mark.parametrize("similarity", [0.9, 0.8, 0.6])
def test_line_dedup_finds_every_similar_pair(spark, similarity):
    rng = random.Random(17)
    vocab = [f"w{i}" for i in range(40)] + [f"longerword{i}" for i in range(200)] + ["a"] * 20
    rows = []
    for i in range(120):
        w = rng.choices(vocab, k=rng.randrange(5, 70))
        other = list(w)
        for _ in range(max(1, int((1 - similarity) * len(w)) + rng.choice([-1, 0, 0, 1]))):
            at, kind = rng.randrange(len(other)), rng.randrange(3)
            other[at : at + (kind != 0)] = [rng.choice(vocab)] if kind != 2 else []
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
    gone = {(r.doc, k) for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string"), similarity=similarity).collect() for k in r.removed}
    want = every_link(rows, similarity)
    assert gone == want and len(want) > 40


def test_line_dedup_edges(spark):
    df = awkward(spark)
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.count() == df.count()
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text is None and got[2].text == "" and got[None].text.startswith("a row") and got[7].text == "x" * 50_000
    two = docs(spark, ["One two three four five 6.\nshort line", "other words stand in this line\none TWO three, four five 6\nshort line"])
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(two).collect()}
    assert got[1] == "other words stand in this line" and got[0].endswith("short line")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(two, min_words=5).collect()}
    assert got[1].text == "other words stand in this line\nshort line" and got[1].n_chars == len(got[1].text) and got[0].text.count("\n") == 1
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


# --- 3 ------------------------------------------------------------------------


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute_near(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, n, percent):
    rng = random.Random(n)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for size in (1, 2, 3, 5, 8, 13, 20, 34, 60, 150, 400):
        for _ in range(3):
            base = rng.choices(vocab, k=size)
            for _ in range(6):
                w = list(base)
                for _ in range(rng.randrange(0, max(1, size // 15) + 2)):
                    w[rng.randrange(len(w))] = rng.choice(vocab)
                rows.append((len(rows), " ".join(w)))
    rows += [(len(rows), ""), (len(rows) + 1, " "), (len(rows) + 2, rows[5][1].upper())]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=n, percent=percent).collect()}
    assert got == brute_near(rows, n, percent)


def test_outsiders_of_a_large_family_meet(spark, monkeypatch):
    """A chain of near copies in which most pairs are too different: blocks of bounded size must still find each link."""
    for name, n in (("BLOCK", 8), ("SMALL", 4), ("FAN", 6), ("BEST", 1)):
        monkeypatch.setattr(linking, name, n)
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(500)]
    now, rows = rng.choices(vocab, k=120), []
    for i in range(60):
        rows.append((i, " ".join(now)))
        now = list(now)
        for _ in range(2 if i % 10 else 9):
            now[rng.randrange(120)] = rng.choice(vocab)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()}
    assert got == {i: c for i, (_, c) in brute_near(rows, 3, 85).items()}


def test_near_edges(spark):
    df = awkward(spark)
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == df.count() and all(r.kept for r in got)
    out = near_dedup.keep_one(df.unionAll(docs(spark, ["SAME text of five  words here"], start=90).withColumns(clash())))
    assert out.columns == df.columns and 90 not in {r.doc_id for r in out.collect()}
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_near_duplicates_of_any_id(spark):
    """String ids; one id with two texts, of which one repeats another document."""
    one, two = "alpha beta gamma delta epsilon zeta", "some other words that stand alone here"
    df = spark.createDataFrame([("b", one), ("a", one + " "), ("c", one), ("c", two), ("c", two), (None, one)], "doc_id string, text string")
    got = sorted((r.doc_id or "", r.component_id or "", r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == [("", "", True), ("a", "a", True), ("b", "a", False), ("c", "a", False), ("c", "c", True), ("c", "c", True)]
    assert sorted((r.doc_id or "", r.text) for r in near_dedup.keep_one(df).collect()) == sorted([("", one), ("a", one + " "), ("c", two), ("c", two)])
    lines = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()}
    assert lines == {("b", ""), ("a", one + " "), ("c", ""), ("c", two), (None, one)}


def test_unrelated_items_of_a_chain_of_buckets_stay_out_of_blocks(spark):
    """10,000 items in a chain of shared buckets without one link: each is compared within its own buckets only."""
    n = 10_000
    seen = spark.sparkContext.accumulator(0)

    def score(x, y, cross):
        seen.add(len(x) * (len(y) if cross else 1))
        return (np.full((len(x), len(y)), -1.0), np.zeros((len(x), len(y)))) if cross else (np.full(len(x), -1.0), np.zeros(len(x)))

    like = linking.Likeness(lambda col: np.array(col.to_pylist()).reshape(-1, 1), score, None, None)
    buckets = spark.range(n).selectExpr("explode(array(id, id + 1, id + 2)) as key", "id")
    groups, links = linking.link_groups(buckets, spark.range(n).selectExpr("id", "id as sketch", "8L as bytes"), lambda ids: ids.selectExpr("id", "'' as text"), like, "chain")
    assert groups.count() == links.count() == 0 and seen.value < 6 * n


def test_items_that_share_many_large_buckets_are_compared_in_one(spark):
    """300 items, all in the same buckets: pairs are scored in one bucket, and none is lost, also beyond the best of each."""
    n = 300
    seen = spark.sparkContext.accumulator(0)

    def score(x, y, cross):
        seen.add(len(x) * (len(y) if cross else 1))
        d = (x[:, None, 0] if cross else x[:, 0]) - (y[None, :, 0] if cross else y[:, 0])
        return np.where(d % 10 == 0, 1.0, -1.0), np.zeros(d.shape)

    # Sketches let ten times as many pairs pass as are linked.
    same = lambda left, right, i, j: np.array([abs(left[p] - right[q]) == 100 for p, q in zip(i, j)], dtype=bool)
    like = linking.Likeness(lambda col: np.array(col.to_pylist()).reshape(-1, 1), score, lambda col: [int(v) for v in col.to_pylist()], same)
    buckets = spark.range(n).selectExpr("explode(sequence(1L, 20L)) as key", "id").where("id % 7 > 0 or key > 1")
    groups, _ = linking.link_groups(buckets, spark.range(n).selectExpr("id", "id as sketch", "8L as bytes"), lambda ids: ids.selectExpr("id", "cast(id as string) as text"), like, "bands")
    assert {r.id: r.component for r in groups.collect()} == {i: i % 100 for i in range(n)}
    # Two buckets hold all pairs; their blocks are scored for the best, the open and the linked pairs.
    assert seen.value < 6 * n * n + 20 * n


@pytest.mark.parametrize("percent", [80, 85])
def test_small_linked_sets_share_a_key(spark, percent):
    import pyarrow as pa

    rng = random.Random(percent)
    texts = []
    for _ in range(6000):
        w = [f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(5, 43))]
        texts += [" ".join(w), " ".join([*w, *(f"x{rng.randrange(10**9)}" for _ in range(max(1, len(w) * (100 - percent) // 200)))])]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], ["key", "id", "text"])
    keys = collections.defaultdict(set)
    sketches = [b.rename_columns(["id", "doc", *b.schema.names[2:]]) for b in near_dedup._sketch(3, percent, Shared(textops.word_levels(spark.createDataFrame([(t,) for t in texts[:500]], "text string"), textops.SPACED)))([batch])]
    for b in near_dedup._bands(percent / 100, lambda keys: np.ones(len(keys), dtype=bool))(sketches):
        for k, i in zip(b["key"].to_pylist(), b["id"].to_pylist()):
            keys[i].add(k)
    linked = 0
    for i in range(0, len(texts), 2):
        x, y = shingles(texts[i], 3), shingles(texts[i + 1], 3)
        if 100 * len(x & y) >= percent * len(x | y):
            linked += 1
            assert keys[i] & keys[i + 1]
    assert linked > 1000


def test_estimate_corrects_collisions():
    assert near_dedup.estimate(np.array([252.0]), np.array([252.0]))[0] == 1
    assert near_dedup.estimate(np.array([0.0]), np.array([252.0]))[0] == 0


# --- 4 ------------------------------------------------------------------------


def test_contamination_of_repeated_ids(spark):
    """Rows that share an id but not the text are judged each by itself."""
    item = " ".join(f"b{i}" for i in range(20))
    df = spark.createDataFrame([("a", item), ("a", "clean text"), ("a", "clean text"), (None, item)], "doc_id string, text string")
    bench = spark.createDataFrame([("x", item)], "item_id string, text string")
    got = sorted((r.doc_id or "", r.n_hit, r.contaminated) for r in decontamination.contamination(df, bench).collect())
    assert got == [("", 20, True), ("a", 0, False), ("a", 0, False), ("a", 20, True)]
    assert [tuple(r) for r in decontamination.decontaminate(df, bench).collect()] == [("a", "clean text")] * 2


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(20))), (2, "tiny item"), (3, None), (4, "!!!"), (5, "tiny item")], "item_id long, text string")
    hit = " ".join(f"B{i}," for i in range(3, 16))
    df = awkward(spark).unionAll(docs(spark, [hit, "a tiny-item here", "tiny x item", hit + " pad" * 300, " ".join(f"b{i}" for i in range(12))], start=50).withColumns(clash()))
    got = {r.doc_id: r for r in decontamination.contamination(df, bench).collect()}
    assert (got[50].n_hit, got[50].items, got[50].contaminated) == (13, ["1"], True)
    assert (got[51].n_hit, got[51].items, got[51].n_words) == (2, ["2", "5"], 4)
    assert got[52].n_hit == 0 and got[54].n_hit == 0 and not got[53].contaminated and got[53].n_hit == 13
    assert got[1].n_words == 0 and not got[1].contaminated and got[4].n_words == 30_000
    assert decontamination.decontaminate(df, bench).count() == df.count() - 2
    assert decontamination.contamination(df, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.contamination(empty(spark), bench).count() == 0


# --- 5 ------------------------------------------------------------------------


def brute_secrets(text):
    out = []
    for k, (kind, pat, group, least) in enumerate([
        ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16),
    ]):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pat, text) if len(m.group(group)) >= least]
    return ",".join(s for _, _, s in sorted(out))


def test_secrets_match_brute_force(spark, tmp_path):
    rng = random.Random(9)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", '"', "'", " ", "abcdef0123456789abcd", "AKIA", "ABCDEFGH12345678", "deadbeef", "é🎉", "\n", "x", "=="]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(400)]
    df = docs(spark, texts).withColumns(clash()).unionByName(awkward(spark)).withColumn("spans", F.lit("clash"))
    ledger = "file://" + str(tmp_path / "ledger")
    nothing = secret_scan.scan_history(df.limit(0), ledger)
    assert nothing.count() == 0 and nothing.columns.count("spans") == 1
    names = [r[0] for r in secret_scan.RULES]
    for r in secret_scan.scan_history(df, ledger).collect():
        assert ",".join(f"{names[s.kind]}:{s.start}:{s.end}" for s in r.spans) == brute_secrets(r.text or "")


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    ledger = "file://" + str(tmp_path / "ledger")
    old = docs(spark, ["password = abcdefghijklmnop", "clean", "clean"])
    secret_scan.scan_history(old, ledger)
    assert spark.read.parquet(ledger).count() == 2
    out = secret_scan.scan_history(old.unionAll(docs(spark, ["new text"], start=9)), ledger)
    assert spark.read.parquet(ledger).count() == 3 and out.count() == 4 and out.where("size(spans) = 1").count() == 1
    secret_scan.scan_history(old, ledger, rule_version="other")
    assert spark.read.parquet(ledger).groupBy("rule_version").count().count() == 2


# --- 6 and 7 --------------------------------------------------------------------


@pytest.fixture(scope="module")
def public():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\r\n", " \n", "\xa0", "　", "é", "ß", "日本", "1", "12", "!", "...", "'s", "don't", "<|endoftext|>", "\x1c", "\x85", "the ", " and", "x" * 70, "🎉"]
    return ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(n)]


def test_bpe_matches_the_public_library(public):
    codec = byte_bpe.Codec.named("byte_bpe_50k.tiktoken")
    for t in [*fuzz(1, 4000), "ab" * 5000, "é" * 999, "aaaaaaaab" * 300]:
        ids = public.encode_ordinary(t)
        assert codec.texts([t])[0] == (" ".join(map(str, ids)), len(ids), t.encode())


def test_bpe_rows(spark, public):
    for r in byte_bpe.encode_decode(awkward(spark)).collect():
        assert bytes(r.decoded).decode() == public.decode(r.ids)
    for r in byte_bpe.code_digests(awkward(spark)).collect():
        assert len(r.ids_sha256) == 64
    assert byte_bpe.code_digests(empty(spark)).count() == 0


def test_pieces_rejoin():
    for t in fuzz(2, 3000):
        assert " ".join(units.pieces(t)) == t


def test_token_counts_and_cache(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*fuzz(3, 1500), "", None]
    cache = "file://" + str(tmp_path / "cache")
    df = docs(spark, texts)
    for r in token_counts.token_counts(df, "byte_bpe_50k.json", cache).collect():
        s = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(s.encode()), len(t.encode(s, add_special_tokens=False).ids))
    n = spark.read.parquet(cache).count()
    assert n == len({x or "" for x in texts})
    assert token_counts.token_counts(df, "byte_bpe_50k.json", cache).count() == len(texts) and spark.read.parquet(cache).count() == n
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(awkward(spark), "piece_bpe_32k.model", "file://" + str(tmp_path / "other")).collect()}
    assert got[1] == got[2] == 0 and got[4] > 0


# --- 8 ------------------------------------------------------------------------


def test_search_is_exact(spark):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(300, 40))
    vecs[250:] = vecs[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)] + [(900, None), (901, []), (None, [1.0]), (7, [float(x) for x in vecs[7]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in code_search.top_k(df, df.where("vec_id % 50 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.distance, r.vec_id))
    bits = vecs.astype(np.float32) > 0
    assert sorted(got) == [0, 50, 100, 150, 200, 250]
    for q, found in got.items():
        assert found == sorted((int((bits[q] != bits[v]).sum()), v) for v in range(300) if v != q)[:5]
    few = df.where("vec_id in (0, 50)")
    assert code_search.top_k(few, few, 5).count() == 2
    assert code_search.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_search_of_short_vectors_and_null_elements(spark):
    rows = [(0, [1.0, None, 1.0]), (50, [1.0]), (3, [1.0, -1.0, 2.0, 1.0]), (4, [None]), (50, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in code_search.top_k(df, df.where("vec_id % 50 = 0"), 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3, 1), (0, 2, 50, 1), (0, 3, 4, 2), (50, 1, 0, 1), (50, 2, 4, 1), (50, 3, 3, 2)]


# --- 9 ------------------------------------------------------------------------


def test_lm_counts_and_probabilities(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "HEAD", 8)
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["the", "cat", "dog", "Runs", "sat", *(f"r{i}" for i in range(40))], k=rng.randrange(0, 30))) for _ in range(80)]
    df = docs(spark, [*texts, None, ""])
    words = lambda t: (t or "").encode().lower().split()
    c = collections.Counter()
    for i, t in enumerate([*texts, None, ""]):
        if zlib.crc32(str(i).encode()) % 10:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    rows = class_lm.lm_scores(df.withColumns(clash())).collect()
    assert len(rows) == 82
    for r in rows:
        t = [*words(None if r.doc_id == 80 else "" if r.doc_id == 81 else texts[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(c[x] > 0 for x in t), n, zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t), rel=1e-9)
        assert r.score < 0


def test_lm_scores_match_brute_force(spark, monkeypatch):
    """Scores from transitions and emissions counted anew, given only each word's class."""
    monkeypatch.setattr(class_lm, "HEAD", 30)
    monkeypatch.setattr(class_lm, "CLUSTERED", 8)
    monkeypatch.setattr(class_lm, "REST", 8)
    monkeypatch.setattr(class_lm, "END", 9)
    monkeypatch.setattr(class_lm, "WIDE", 10)
    rng = random.Random(16)
    vocab = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocab, weights=[1 / (i + 1) for i in range(60)], k=rng.randrange(0, 25))) for _ in range(120)]
    df = docs(spark, texts)
    model, _ = class_lm.fit(df.where(~class_lm.held_out()))
    assert len(model.head) <= 30 and (model.head_class < class_lm.CLASSES).all()  # every word of the head has a class
    hashed = {w: int(x.h[0]) for w in vocab for x in textops.words(__import__("pyarrow").array([w]), textops.SPACED)}
    cls = dict(zip(model.head.tolist(), model.head_class.tolist()))
    of = lambda w: cls.get(hashed[w], class_lm.CLASSES)
    g, c, kinds, size = (collections.Counter() for _ in range(4))
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 10:
            chain = [class_lm.CLASSES + 1, *map(of, t.split()), class_lm.CLASSES + 1]
            g.update(zip(chain, chain[1:]))
            c.update(t.split())
    for w, n in c.items():
        size[of(w)] += n
        kinds[of(w)] += 1
    total = collections.Counter()
    for (a, _), n in g.items():
        total[a] += n
    wide = class_lm.CLASSES + 2
    step = lambda a, b: math.log10((g[a, b] + 0.1) / (total[a] + 0.1 * wide))
    for r in class_lm.lm_scores(df).collect():
        chain = [class_lm.CLASSES + 1, *map(of, texts[r.doc_id].split()), class_lm.CLASSES + 1]
        want = sum(step(a, b) for a, b in zip(chain, chain[1:]))
        want += sum(math.log10((c[w] + 0.1) / (size[of(w)] + 0.1 * (kinds[of(w)] + 1))) for w in texts[r.doc_id].split())
        assert r.score == pytest.approx(want, rel=1e-9)


def test_lm_words_beyond_the_head_have_classes(spark, monkeypatch):
    """With tail no word is left in the class of other words; scores are those of a plain count over these classes."""
    for name, n in {"HEAD": 12, "CLUSTERED": 8, "REST": 8, "END": 9, "WIDE": 10}.items():
        monkeypatch.setattr(class_lm, name, n)
    rng = random.Random(26)
    vocab = [f"w{i}" for i in range(60)]
    texts = [*(" ".join(rng.choices(vocab, weights=[1 / (i + 1) for i in range(60)], k=rng.randrange(0, 25))) for _ in range(120)), "new w1 new newer", ""]
    df = docs(spark, texts)
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    c = collections.Counter(w for t in train for w in t.split())
    model, rest = class_lm.fit(df.where(~class_lm.held_out()), tail=True)
    beyond = {r["h"] % 2**64: (r["n"], r["class"]) for r in rest.collect()}
    hashed = {w: int(x.h[0]) for w in [*vocab, "new", "newer"] for x in textops.words(__import__("pyarrow").array([w]), textops.SPACED)}
    cls = dict(zip(model.head.tolist(), model.head_class.tolist())) | {h: k for h, (_, k) in beyond.items()}
    assert len(model.head) <= 12 and beyond.keys() == {hashed[w] for w in c} - set(model.head.tolist())
    assert all(n == c[w] for w in c for n, _ in [beyond.get(hashed[w], (c[w], 0))])
    assert all(k < class_lm.CLASSES for k in cls.values()) and len({k for _, k in beyond.values()}) > 1
    of = lambda w: cls.get(hashed[w], class_lm.CLASSES)
    chained = lambda t: [class_lm.CLASSES + 1, *map(of, t.split()), class_lm.CLASSES + 1]
    g, total, kinds, size = (collections.Counter() for _ in range(4))
    for t in train:
        g.update(zip(chained(t), chained(t)[1:]))
    for (a, _), n in g.items():
        total[a] += n
    for w, n in c.items():
        size[of(w)] += n
        kinds[of(w)] += 1
    for r in class_lm.lm_scores(df, tail=True).collect():
        chain = chained(texts[r.doc_id])
        want = sum(math.log10((g[a, b] + 0.1) / (total[a] + 0.1 * (class_lm.CLASSES + 2))) for a, b in zip(chain, chain[1:]))
        want += sum(math.log10((c[w] + 0.1) / (size[of(w)] + 0.1 * (kinds[of(w)] + 1))) for w in texts[r.doc_id].split())
        assert r.score == pytest.approx(want, rel=1e-9)


def test_lm_probabilities_sum_to_one(spark):
    model, _ = class_lm.fit(docs(spark, ["a b a c", "b a d", "c c a"]))
    assert np.power(10, model.step).sum(axis=1) == pytest.approx(np.ones(class_lm.CLASSES + 2))
    assert class_lm.lm_scores(empty(spark)).count() == 0
    assert class_lm.lm_scores(awkward(spark)).count() == 9


def test_class_model_beats_unigrams_on_ordered_text(spark):
    rng = random.Random(8)
    subj, verb, obj = ([f"{k}{i}" for i in range(30)] for k in "svo")
    df = docs(spark, [" ".join(w for _ in range(20) for w in (rng.choice(subj), rng.choice(verb), rng.choice(obj))) for _ in range(200)])
    r = class_lm.lm_scores(df).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1] * 0.85


# --- 10 -----------------------------------------------------------------------


def test_license_forms(spark):
    text = "Copyright (c) 2020 Someone\n(c) Other\nPERMISSION to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + dict(license_scan.TEXTS)["0BSD"].split("granted.")[1].strip().replace("SOFTWARE", "software")
    df = docs(spark, ["Released under the M.I.T Licence", "released under the MIT LICENCE!", "first line\nAll rights reserved\nAll Rights Reserved.", text, None, "", "..."])
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    assert got[0].license_id is None and got[1].license_id == "MIT" and got[1].notices == "MIT"
    assert (got[2].license_id, got[2].n_notices, got[2].notices) == (None, 2, "LicenseRef-all-rights-reserved")
    assert got[3].license_id == "0BSD"
    assert all(got[i].digest is None and got[i].n_notices == 0 for i in (4, 5, 6))
    assert license_scan.scan_licenses(awkward(spark)).count() == 9 and license_scan.scan_licenses(empty(spark)).count() == 0


def test_wrapped_license_files_and_a_table_of_texts(spark, tmp_path):
    """Real files: title, copyright line, wrapped text; texts of a folder; one id with two texts; null ids."""
    import textwrap

    bodies = dict(license_scan.TEXTS)
    file = lambda title, i: f"{title}\n\nCopyright (c) 2021, A. N. Other\n\n" + textwrap.fill(bodies[i], 78)
    df = docs(spark, [file("BSD 3-Clause License", "BSD-3-Clause"), file("", "BSD-2-Clause"), file("MIT No Attribution", "MIT-0"), file("", "Unlicense"), file("zlib License", "Zlib")])
    assert [r.license_id for r in license_scan.scan_licenses(df).orderBy("doc_id").collect()] == ["BSD-3-Clause", "BSD-2-Clause", "MIT-0", "Unlicense", "Zlib"]
    (tmp_path / "Own-1.0.txt").write_text("You may do\nas you like.")
    known = license_scan.license_files(spark, str(tmp_path))
    rows = [(None, "x\nYou may do as you like!"), ("a", "YOU MAY DO AS YOU LIKE"), ("a", "other"), ("a", "other")]
    got = sorted((r.doc_id or "", r.license_id or "", r.n_notices) for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string"), known=known).collect())
    assert got == [("", "", 1), ("a", "", 0), ("a", "", 0), ("a", "Own-1.0", 1)]


def test_sql_of_the_operators(spark):
    """The registered SQL gives the registered queries' rows on the smallest tables."""
    import duckdb

    from kgloom.llm import queries

    d = "/root/testdata/sf0.001"
    for name, sql in queries.ORACLE_SQL.items():
        con = duckdb.connect()
        for t in ("documents", "benchmark", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        rows = queries.QUERIES[name](spark, d)
        assert sorted(rows.columns) == sorted(columns)
        assert sorted(map(repr, (tuple(r) for r in rows.select(*columns).collect()))) == sorted(map(repr, want.fetchall())), name


# --- pipeline -------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(11)
    vocab = [f"token{i}" for i in range(500)]
    sentence = lambda k: " ".join(rng.choices(vocab, k=k))
    clean = ["\n".join(sentence(15) for _ in range(4)) for _ in range(12)]
    item = sentence(30)
    w = clean[0].replace("\n", " ").split()
    w[7] = "changed"
    texts = [*clean, "12 34 !!", " ".join(w), clean[1].split("\n")[0] + "\n" + sentence(40), item + " " + sentence(20)]
    df = docs(spark, texts)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, seen = df, {}
    for name, stage in P.STAGES[:-1]:
        now = storage.materialize(stage(spark, now, str(tmp_path)), name)
        assert now.columns == df.columns
        seen[name] = {r.doc_id: r.text for r in now.collect()}
    assert set(seen["language_id"]) == set(range(16)) - {12}
    assert seen["line_dedup"][14].count("\n") == 0 and set(seen["line_dedup"]) == set(seen["language_id"])
    assert set(seen["near_dedup"]) == set(seen["line_dedup"]) - {13}
    assert set(seen["decontamination"]) == set(seen["near_dedup"]) - {15}
    out = {r.doc_id: r for r in P.run(spark, str(tmp_path)).collect()}
    assert set(out) == set(seen["decontamination"])
    assert all(out[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in seen["decontamination"].items())


def test_pipeline_workers_stay_small(spark, tmp_path):
    """Batches of texts are bounded in bytes, voting works on short runs, and the codec keeps nothing from task to task."""
    import corpus_pipeline as P

    df = docs(spark, [f"some words of text number {i} " * 4_000 for i in range(200)]).coalesce(1)
    P.STAGES[0][1](spark, df, str(tmp_path))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    seen = [r.n for r in df.select("text").mapInArrow(sizes, "n long").collect()]
    assert sum(seen) == 200 and max(seen) * 4_000 * 30 < 16 << 20
    texts = pa.array(["some words"] * 100_000)
    runs = [len(d) for _, _, d in language_id._padded(texts, language_id.VOTED)]
    assert max(runs) <= 2 * language_id.VOTED <= textops.CHUNK and sum(runs) == 12 * 100_000
    name = "byte_bpe_50k.tiktoken"
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["unheardofwordone anotherunheardofword, andmore"])], ["id", "text"])
    (out,) = byte_bpe._codes(name, False)(iter([batch]))
    codec = byte_bpe.Codec.named(name)
    assert out.num_rows == 1 and not (codec.first or codec.later or codec.matches)
