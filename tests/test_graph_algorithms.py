"""Iterative, sampled and similarity operators, exports and rank metrics against plain versions."""

import hashlib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from kgloom.operators import graph as G, metrics as M, splits as S
from kgloom.sources import export

XY = "x_id string, y_id string"


def shortest(edges):
    """(ancestor, descendant) -> depth by breadth-first search."""
    up, out = {}, {}
    for x, y in edges:
        if x is not None and y is not None and x != y:
            up.setdefault(x, set()).add(y)
    for start in up:
        now, depth, seen = {start}, 0, {start}
        while now:
            now, depth = {t for n in now for t in up.get(n, ())} - seen, depth + 1
            seen |= now
            out |= {(t, start): depth for t in now}
    return out


def test_closure_of_long_chains_cycles_and_random_graphs(spark):
    rng = random.Random(1)
    chain = [(f"n{i}", f"n{i + 1}") for i in range(200)]
    ring = [(f"c{i}", f"c{(i + 1) % 7}") for i in range(7)] + [("c1", "c1"), ("in", "c3"), ("c5", "out")]
    some = [(f"r{rng.randrange(30)}", f"r{rng.randrange(30)}") for _ in range(45)]
    e = spark.createDataFrame(chain + ring + some + [(None, "n1"), ("n1", None), ("n0", "n1")], XY)
    got = G.closure(e)
    assert {(r.ancestor, r.descendant): r.depth for r in got.collect()} == shortest(chain + ring + some)
    assert G.closure(e.limit(0)).count() == 0
    # Eight rounds reach 256 steps, seven don't tell that 200 are all.
    assert G.closure(spark.createDataFrame(chain, XY), most=8).count() == 200 * 201 // 2
    with pytest.raises(ValueError, match="rounds"):
        G.closure(spark.createDataFrame(chain, XY), most=7)


def test_codes_stand_for_nodes_below_and_their_groups(spark):
    below = spark.createDataFrame([("top", "mid", 1), ("top", "low", 2), ("mid", "low", 1)], "ancestor string, descendant string, depth int")
    xrefs = spark.createDataFrame([("low", "M:1"), ("mid", "M:2"), ("lone", "M:3"), ("low", "gone")], "code string, entity string")
    groups = spark.createDataFrame([("M:1", "G:1"), ("M:2", "G:none")], "entity string, group_id string")
    nodes = spark.createDataFrame([("M:1",), ("M:3",), ("G:1",), ("M:1",)], "id string")
    got = {(r.code, r.id) for r in G.code_nodes(below, xrefs, nodes, groups).collect()}
    assert got == {("low", "M:1"), ("low", "G:1"), ("mid", "M:1"), ("mid", "G:1"), ("top", "M:1"), ("top", "G:1"), ("lone", "M:3")}


@pytest.mark.parametrize("least", [0.5, 0.6, 0.8, 1.0])
def test_similar_neighbours_match_all_pairs(spark, least):
    rng = random.Random(int(10 * least))
    base = [rng.sample(range(60), 12) for _ in range(12)]
    sets = {}
    for i in range(150):
        s = set(rng.choice(base))
        for _ in range(rng.randrange(6)):
            s ^= {rng.randrange(60)}
        sets[f"a{i}"] = s or {1}
    sets |= {f"h{i}": {0, 1000 + i} for i in range(40)} | {"e1": {5}, "e2": {5}, "f": {0}}
    rows = [(a, f"y{y}") for a, s in sets.items() for y in s]
    e = spark.createDataFrame(rows + rows[:20] + [(None, "y1"), ("a0", None)], XY).where("x_id is null or y_id is not null")
    classes, pairs = G.similar_neighbours(e, least)
    of = {r.a: (r.class_id, r.d) for r in classes.collect()}
    assert of == {a: (min(b for b, t in sets.items() if t == s), len(s)) for a, s in sets.items()}
    want = {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sorted({c for c, _ in of.values()}), 2) if len(sets[a] & sets[b]) >= least * math.sqrt(len(sets[a]) * len(sets[b])) - 1e-9}
    assert {(r.a, r.b): r.shared for r in pairs.collect()} == want


def test_shared_neighbours_list_every_pair(spark):
    """No threshold, and no pair lost or counted twice where a hub's sources are dealt into blocks."""
    rng = random.Random(5)
    sets = {f"a{i}": set(rng.sample(range(40), rng.randrange(1, 9))) | ({99} if i % 3 else set()) for i in range(90)}
    rows = [(a, f"y{y}") for a, s in sets.items() for y in s]
    e = spark.createDataFrame(rows + rows[:30] + [(None, "y1"), ("a0", None)], XY)
    want = {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] & sets[b]}
    for block in (7, 1024):
        got = G.shared_neighbours(e, block).collect()
        assert len(got) == len(want) and {(r.a, r.b): r.shared for r in got} == want
        assert all(math.isclose(r.cosine, r.shared / math.sqrt(len(sets[r.a]) * len(sets[r.b]))) for r in got)
    assert min(r.cosine for r in got) < 0.2


def test_neighbour_similarity_is_whole(spark):
    """The registered query lists pairs below any threshold, over the supply relation."""
    from kgloom.plans.catalog import QUERIES

    assert QUERIES["o105_neighbour_similarity"](spark, "/root/testdata/sf0.01").where("cosine < 0.5 and a like 'supplier:%'").count() > 0


def test_a_hub_is_in_no_prefix(spark):
    """3,000 sources share a hub: none of their prefixes holds it, so no pair meets there."""
    rows = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("x_id"), F.explode(F.array(F.lit("hub"), F.concat(F.lit("own"), "id"), F.concat(F.lit("pair"), F.floor(F.col("id") / 2)))).alias("y_id"))
    classes, pairs = G.similar_neighbours(rows, 0.65)
    assert pairs.count() == 1500 and classes.count() == 3000
    often = rows.groupBy("y_id").agg(F.count(F.lit(1)).alias("often"))
    ranked = G.numbered(rows.join(often, "y_id"), ["x_id"], [F.col("often"), F.col("y_id")]).select("x_id", "y_id", F.col("__r").alias("place"), F.col("__n").alias("d"))
    assert G.prefixes(ranked, 0.65).where("y_id = 'hub'").count() == 0


def number(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("dead_ends", ["keep", "drop"])
def test_walks_match_their_draws(spark, dead_ends):
    rng = random.Random(4)
    edges = sorted({("likes", f"a{rng.randrange(5)}", f"b{rng.randrange(9)}") for _ in range(25)} | {("has", f"b{rng.randrange(6)}", f"c{rng.randrange(8)}") for _ in range(20)})
    hops = ["likes", "has", "rev_has", "any"]
    near = {}
    for r, x, y in edges:
        for kind, s, t in ((r, x, y), (f"rev_{r}", y, x), ("any", x, y), ("any", y, x)):
            near.setdefault((kind, s), set()).add(t)
    visits = {}
    for a in [f"a{i}" for i in range(6)]:
        for w in range(7):
            at, path = a, []
            for s, hop in enumerate(hops):
                options = sorted(near.get((hop, at), ()))
                if not options:
                    break
                at = options[number(11, a, w, s) % len(options)]
                path.append(at)
            if dead_ends == "keep" or len(path) == len(hops):
                for p in path:
                    visits[a, p] = visits.get((a, p), 0) + 1
    e = spark.createDataFrame(edges, "relation string, x_id string, y_id string")
    anchors = spark.createDataFrame([(f"a{i}",) for i in range(6)] + [("a1",)], "id string")
    got = G.walk_profile(e, anchors, hops, 7, 11, dead_ends).collect()
    assert {(r.anchor, r.id): r.visits for r in got} == visits
    total = {a: sum(n for (x, _), n in visits.items() if x == a) for a, _ in visits}
    assert all(r.prob == pytest.approx(r.visits / total[r.anchor]) and r.bit == 1 for r in got)


def test_places_of_a_hub_are_dealt_over_blocks(spark):
    e = spark.range(500).select(F.lit("r").alias("relation"), F.lit("hub").alias("at"), F.concat(F.lit("n"), "id").alias("to"))
    got = G.placed(e, block=16)
    assert sorted(r.place for r in got.collect()) == list(range(500)) and {r.degree for r in got.select("degree").distinct().collect()} == {500}


TYPED = "relation string, x_id string, x_type string, y_id string, y_type string"


def typed(pairs, x_type="a", y_type="b"):
    return [("r", x, x_type, y, y_type) for x, y in pairs]


def node_index(spark, **sizes):
    return spark.createDataFrame([(t, f"{t}{i}", i) for t, n in sizes.items() for i in range(n)], "node_type string, id string, index long")


@pytest.mark.parametrize("side", ["x", "y", "both"])
def test_negatives_are_never_the_positive(spark, side):
    ix = node_index(spark, a=2, b=2)
    p = spark.createDataFrame(typed(itertools.product(("a0", "a1"), ("b0", "b1"))), TYPED)
    got = S.negatives(p, ix, 5, k=12, side=side).collect()
    assert len(got) == 48 and all((r.x_id, r.y_id) != (r.x_pos, r.y_pos) for r in got)
    assert side == "both" or all((r.y_id == r.y_pos) if side == "x" else (r.x_id == r.x_pos) for r in got)
    assert S.negatives(p, node_index(spark, a=1, b=1), 5, side="y").count() == 0


@pytest.mark.parametrize("side", ["x", "y", "both"])
def test_filtered_negatives_are_refilled(spark, side):
    rng = random.Random(9)
    pairs = sorted({(f"a{rng.randrange(30)}", f"b{rng.randrange(40)}") for _ in range(200)})
    p = spark.createDataFrame(typed(pairs), TYPED)
    ix = node_index(spark, a=30, b=40)
    got = S.filtered_negatives(p, p, ix, 3, k=2, side=side, attempts=60).collect()
    found = [(r.x_id, r.y_id) for r in got]
    assert len(got) == 2 * len(pairs) and None not in [r.attempt for r in got] and not set(found) & set(pairs) and len(set(found)) == len(found)
    assert {(r.x_pos, r.y_pos, r.k) for r in got} == {(x, y, k) for x, y in pairs for k in (1, 2)} and max(r.attempt for r in got) > 1
    if side == "y":
        again = S.filtered_negatives(p.repartition(7), p, ix, 3, k=2, side=side, attempts=60).collect()
        assert sorted(map(str, again)) == sorted(map(str, got))


def test_a_shortfall_has_a_reason(spark):
    full = spark.createDataFrame(typed(itertools.product([f"a{i}" for i in range(3)], [f"b{i}" for i in range(3)])), TYPED)
    got = S.filtered_negatives(full, full, node_index(spark, a=3, b=3), 1, attempts=3).collect()
    assert len(got) == 9 and {(r.x_id, r.reason) for r in got} == {(None, "attempts_exhausted")}
    lone = S.filtered_negatives(spark.createDataFrame(typed([("a0", "b0")]), TYPED), full, node_index(spark, a=1, b=1), 1, attempts=2).collect()
    assert [(r.reason, r.k) for r in lone] == [("too_few_nodes", 1)]
    assert S.filtered_negatives(full.limit(0), full, node_index(spark, a=3, b=3), 1).count() == 0


def test_weighted_negatives_follow_their_weights(spark):
    degrees = spark.createDataFrame([("b0", 900), ("b1", 100), ("b2", 0)], "id string, degree long")
    p = spark.range(4000).select(F.concat(F.lit("a"), "id").alias("x_id"), F.lit("b9").alias("y_id"))
    share = {r.y_id: r["count"] / 4000 for r in S.weighted_negatives(p, degrees, 1, 1.0).groupBy("y_id").count().collect()}
    assert set(share) == {"b0", "b1"} and share["b0"] == pytest.approx(0.9, abs=0.03)


def test_ranking_of_one_group_with_all_rows(spark):
    """All cut-offs, lists, an entity without positives; no window runs over the group alone."""
    rng = random.Random(2)
    rows = [("big", i, round(rng.random(), 2), int(rng.random() < 0.2)) for i in range(700)] + [("none", i, float(i), 0) for i in range(5)] + [(None, 1, 0.5, 1)]
    df = spark.createDataFrame(rows, "e string, item int, score double, label int").repartition(6)
    got = {(r.e, r.cut): r for r in M.ranking(df, "e", "item", listed=3).collect()}
    assert len(got) == 18 and got[None, "10"].hits == 1
    for e in ("big", "none"):
        mine = sorted((-s, i, y) for g, i, s, y in rows if g == e)
        pos = [k for k, (_, _, y) in enumerate(mine, 1) if y]
        for cut, c in M.CUTS:
            k = int(len(mine) * c) if isinstance(c, float) else c
            r, hits = got[e, cut], [p for p in pos if p <= k]
            assert (r.k, r.candidates, r.positives, r.hits) == (k, len(mine), len(pos), len(hits))
            assert r.hits_list == [mine[p - 1][1] for p in hits[:3]] and r.missed_list == [mine[p - 1][1] for p in pos if p > k][:3]
            if not pos:
                assert r.recall == r.mrr == r.ap == -1
                continue
            chance = min(1, k / len(mine))
            assert r.recall == pytest.approx(len(hits) / len(pos), abs=1e-6) and r.mrr == pytest.approx(1 / hits[0] if hits else 0, abs=1e-6)
            assert r.enrichment == pytest.approx(len(hits) / len(pos) / chance if chance else 0, abs=1e-5)
            assert r.ap == pytest.approx(sum((j + 1) / p for j, p in enumerate(hits)) / min(len(pos), k) if min(len(pos), k) else 0, abs=1e-6)
    curve = {r.e: r for r in M.auroc_ap(df, "e").collect()}
    wins = sum((a > b) + (a == b) / 2 for g, _, a, x in rows for h, _, b, y in rows if g == h == "big" and x and not y)
    assert curve["big"].auroc == pytest.approx(wins / (curve["big"].positives * curve["big"].negatives), abs=1e-6)
    assert curve["none"].auroc is None and curve["macro"].auroc == curve["big"].auroc and curve["micro"].positives == curve["big"].positives + 1


def test_digests_see_every_change(spark):
    rows = [(i, f"id{i}", None if i % 3 else 0.5 * i) for i in range(50)]
    df = lambda r: spark.createDataFrame(r, "n int, id string, v double")
    first = lambda d: tuple(export.content_digest(d).first())
    base = first(df(rows))
    assert first(df(rows[::-1]).repartition(7)) == base
    changed = [(rows[0][0], "id0x", rows[0][2]), *rows[1:]]
    swapped = [(0, "id1", rows[0][2]), (1, "id0", rows[1][2]), *rows[2:]]
    assert len({base, first(df(changed)), first(df(swapped)), first(df(rows + rows[:1])), first(df(rows + rows)), first(df(rows[1:])), first(df([]))}) == 7
    pair = lambda *r: first(spark.createDataFrame(r, "a string, b string"))
    assert len({pair(("ab", "c")), pair(("a", "bc")), pair((None, "abc")), pair(("", "abc")), pair(("-", "abc"))}) == 5
    order = lambda ids: export.sequence_digests(spark.createDataFrame([("t", x, i) for i, x in enumerate(ids)], "g string, id string, p long").repartition(5), "g", "id", "p").first()
    ids = [f"n{i:05d}" for i in range(9000)]
    want = order(ids)
    assert want.n == 9000 and order(ids).digest == want.digest
    assert len({want.digest, order([ids[1], ids[0], *ids[2:]]).digest, order([*ids, ids[-1]]).digest, order(ids[:-1]).digest, order([None, *ids[1:]]).digest}) == 5


def test_an_export_tells_what_changed(spark, tmp_path):
    nodes = spark.createDataFrame([("t", "n1"), ("t", "n2"), ("t", "n2"), ("u", "m1"), ("paper", "p1"), ("u", None)], "node_type string, id string")
    edges = spark.createDataFrame([("n1", "t", "m1", "u", "r"), ("n2", "t", "gone", "u", "r"), ("n1", "t", "p1", "paper", "cites")], "x_id string, x_type string, y_id string, y_type string, relation string")
    out = str(tmp_path / "graph")
    report = {(r.part, r.name): r for r in export.indexed_export(nodes, edges, out).collect()}
    assert set(report) == {("nodes", "t"), ("nodes", "u"), ("edges", "r"), ("edges", "rev_r")}
    assert (report["nodes", "t"].n_rows, report["nodes", "t"].issue) == (2, "duplicate_ids:1") and report["nodes", "u"].issue == "null_ids:1"
    assert (report["edges", "rev_r"].n_rows, report["edges", "rev_r"].issue) == (1, "dangling_edges:1")
    assert export.verify_export(spark, out).count() == 0
    spark.createDataFrame([("n1", "m1", 0, 0)], "x_id string, y_id string, src long, dst long").write.mode("append").parquet(f"{out}/graph/part=edges/relation=r")
    assert [(r.part, r.name) for r in export.verify_export(spark, out).collect()] == [("edges", "r")]


def test_batches_rewrite_their_buckets_and_anchors_read_theirs(spark, tmp_path):
    import os

    from kgloom.streaming import append

    schema = "x_id string, y_id string, relation string, source string, credibility long, seq long"
    rows = lambda lo, hi: [(f"x{i % 97}", f"y{i % 53}", "r", "s", 1, i) for i in range(lo, hi)] + [("hub", f"y{i}", "r", "s", 1, 10**6 + i) for i in range(lo, hi)]
    store, n = str(tmp_path / "store"), 0

    def add(new):
        nonlocal n
        spark.createDataFrame(new, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{n}"))
        n += 1
        append.append_edges(spark, str(tmp_path / "in" / "*"), schema, store, str(tmp_path / "ck"), buckets=32, rows_per_bucket=10**6)

    add(rows(0, 600))
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{store}/v0/edges") for f in fs if f.endswith(".parquet")}
    before = files()
    add([("x5", "new1", "r", "s", 1, 1), ("x6", "new2", "r", "t", 2, 2)])
    after = files()
    folders = lambda fs: {os.path.dirname(f) for f in fs}
    # Two edges rewrite two buckets of about 32 at most.
    assert 1 <= len(folders(set(after) - set(before))) <= 2 < len(folders(before)) / 8
    hub = folders(f for f in after)
    assert len(hub) > 20 and append.latest(spark, store).where("x_id = 'hub'").count() == 600
    got = append.edges_of(spark, store, "r", "x5")
    assert {r.y_id for r in got.collect()} >= {"new1"} and got.count() == append.latest(spark, store).where("x_id = 'x5'").count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0] and "EqualTo(x_id,x5)" in plan
    every = sorted(map(str, append.latest(spark, store).collect()))
    assert append.compact(spark, store, rows_per_bucket=8) and append.layout(spark, store) == (1, 256) and not append.compact(spark, store, rows_per_bucket=8)
    assert sorted(map(str, append.latest(spark, store).collect())) == every and append.edges_of(spark, store, "r", "x5").count() == got.count()
    add([("x5", "new3", "r", "s", 1, 1)])
    assert append.latest(spark, store).count() == len(every) + 1
