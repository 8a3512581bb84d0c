"""Operators on hand-made rows: edge cases, conservation, idempotence, determinism."""

from pyspark.sql import functions as F

from kgloom.functions import normalize as N
from kgloom.operators import audit, compose as C, credibility, evidence as ev, features, graph as G, intervals, lookup, mapping, migrate, splits as S
from kgloom.sources import readers, sinks


def one(spark, expr, **cols):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items())).select(expr.alias("x")).first()[0]


def test_curie(spark):
    for given, want in [(" EFO_1 ", "EFO:1"), ("nan", None), ("", None), ("XX_1", "XX_1"), ("Orphanet_9", "Orphanet:9")]:
        assert one(spark, N.curie(F.col("c")), c=given) == want


def test_windows_end_at_length(spark):
    w = one(spark, N.windows(F.col("c"), 4, 3), c="abcdefghi")
    assert [(x.start, x.end, x.part) for x in w] == [(0, 4, "abcd"), (3, 7, "defg"), (5, 9, "fghi")]
    assert one(spark, N.windows(F.col("c"), 4, 3), c="ab")[0].part == "ab"


def test_credibility_branches(spark):
    schema = "x_id string, y_id string, relation string, source string, credibility long, seq long"
    same = spark.createDataFrame([("a", "b", "r", "s", 1, 2), ("a", "b", "r", "s", 3, 1)], schema)
    assert [r.credibility for r in credibility.dedup_edges(same).collect()] == [3]
    many = spark.createDataFrame([("a", "b", "r", "s", 1, 1), ("a", "b", "r", "t", 3, 2), ("a", "b", "r", "s", 2, 3)], schema)
    r = credibility.dedup_edges(many).first()
    assert (r.source, r.credibility) == ("s,t", 3)
    e = spark.createDataFrame([("a", "b", "r", "s", 1, 1, "p1", "", 0.5, "x"), ("a", "b", "r", "s", 1, 2, "p1", "", 0.6, "known_drug"), ("c", "d", "r", "reactome", 1, 3, None, None, None, None)], schema + ", paper_id string, author_group_key string, raw_score double, datatype string")
    got = {r.x_id: r.credibility for r in credibility.dedup_edges(e).collect()}
    assert got == {"a": 1, "c": 3}
    again = credibility.dedup_edges(credibility.dedup_edges(many).withColumn("seq", F.lit(0)))
    assert again.first().source == "s,t"


def test_remap_conserves_rows(spark):
    e = spark.createDataFrame([(f"x{i % 3}", f"y{i}", "r", "s", "d", 1, i) for i in range(12)], "x_id string, y_id string, relation string, source string, display_relation string, credibility int, seq int")
    m = spark.createDataFrame([("y1", "y0", "accepted"), ("y2", None, "ambiguous"), ("y4", "y1b", "accepted"), ("x0", "x1", "accepted")], "old_id string, new_id string, status string")
    kept, bad, coll = mapping.remap(e, m)
    assert kept.count() + bad.count() + coll.count() == 12
    assert {r.reason for r in bad.collect()} == {"y_ambiguous"}


def test_dense_index_is_partition_free(spark):
    n = spark.createDataFrame([("t", f"id{i:03d}") for i in range(100)] + [("u", "a"), ("u", None)], "node_type string, id string")
    want = {("t", f"id{i:03d}"): i for i in range(100)} | {("u", "a"): 0}
    for parts in ("1", "3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert {(r[0], r[1]): r[2] for r in G.dense_index(n).collect()} == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_closure_handles_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "x_id string, y_id string")
    got = {(r.ancestor, r.descendant) for r in G.closure(e).collect()}
    assert got == {(p, q) for p in "abc" for q in "abcd" if p != q}


def test_interval_join_bounds(spark):
    p = spark.createDataFrame([("1", 10), ("1", 64), ("1", 200), ("2", 10)], "c string, p long")
    i = spark.createDataFrame([("1", 10, 64, "i"), ("1", 65, 199, "j"), ("1", 9, 5, "bad")], "c string, s long, e long, n string")
    assert {(r.p, r.n) for r in intervals.contains(p, i, "c", "p", "s", "e").collect()} == {(10, "i"), (64, "i")}
    assert {(r.p, r.n) for r in intervals.contains(p, i, "c", "p", "s", "e", padding=1).collect()} == {(10, "i"), (64, "i"), (64, "j"), (200, "j")}


def test_intervals_of_any_length(spark):
    """Lengths 1 to 10^8 match all pairs, and no interval stands in more than two bins of its level."""
    import random

    rng = random.Random(5)
    points = [(rng.choice("ab"), rng.choice([rng.randrange(-50, 300), rng.randrange(3 * 10**8)])) for _ in range(400)] + [("a", None), (None, 5), ("a", 7), ("a", 7)]
    spans = [(rng.choice("ab"), (s := rng.choice([rng.randrange(-60, 300), rng.randrange(2 * 10**8)])), s + 10 ** rng.randrange(9) - 1, k) for k in range(200)]
    spans += [("a", None, 5, 900), ("a", 9, 3, 901), (None, 1, 9, 902), ("b", 0, 2**40, 903), ("a", 63, 64, 904)]
    p, i = spark.createDataFrame(points, "c string, p long"), spark.createDataFrame(spans, "c string, s long, e long, k long")
    for padding in (0, 3):
        want = sorted((x, k) for c, x in points for d, s, e, k in spans if None not in (c, x, s) and c == d and s <= e and s - padding <= x <= e + padding)
        assert sorted((r.p, r.k) for r in intervals.contains(p, i, "c", "p", "s", "e", padding).collect()) == want
    one = spark.createDataFrame([("a", 999_999, 1_999_998, 1)], "c string, s long, e long, k long")
    assert intervals.contains(p, i.limit(0), "c", "p", "s", "e").count() == 0
    joined = intervals.contains(p, one, "c", "p", "s", "e", wide=60)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 15" not in joined and joined.count("explode") <= 3


def test_containment_reasons(spark):
    pairs = [("v1", "g1", "chr1", 15), ("v2", "g1", "1", 99), ("v3", "g2", "1", 5), ("v4", "g1", None, 5), ("v5", "g1", "1", None), ("v6", "g1", "2", 15), ("v1", "g1", "1", 15)]
    genes = [("g1", "1", 10, 20, "+"), ("g1", "chr1", 12, 30, "-"), ("g3", "1", 1, 2, "+")]
    got = intervals.containment(spark.createDataFrame(pairs, "id string, entity string, chrom string, pos int"), spark.createDataFrame(genes, "entity string, chrom string, start int, end int, strand string")).collect()
    assert {r.id: (r.contained, r.reason) for r in got} == {"v1": (True, "contained"), "v2": (False, "outside_gene_interval"), "v3": (False, "missing_gene_interval"), "v4": (False, "missing_variant_coordinate"), "v5": (False, "missing_variant_coordinate"), "v6": (False, "outside_gene_interval")}
    assert len(got) == 6 and [tuple(r.proof) for r in got if r.proof] == [(10, 20, "+")]


def rule_edges(spark, seed=3, n=400):
    """Random edges with every field, and hubs."""
    import random

    rng = random.Random(seed)
    word = lambda *w: rng.choice(w)
    rows = {}
    for _ in range(n):
        r, x, y = word(("r1", "a", "b"), ("r2", "b", "c"), ("r3", "c", "d"), ("close", "a", "c"))
        key = (f"{x}{rng.randrange(12) * rng.randrange(2)}", f"{y}{rng.randrange(12) * rng.randrange(2)}", r)
        rows[key] = (*key, word("s1", "s2", "s1,s2", ""), word("increase", "inhibitor", "increase,inhibitor", "unknown"), word("liver", "brain", "liver,brain", ""), word("pathogenic", "benign", "unknown"), word("i1", "i2", ""), word(key[1], ""))
    return spark.createDataFrame(list(rows.values()), "x_id string, y_id string, relation string, source string, direction string, tissue string, pathogenicity string, isoform_id string, protein_isoform string")


def test_counted_ledgers_equal_ledgers_of_paths(spark):
    e = rule_edges(spark)
    two, three = (("r1", "a", "b"), ("r2", "b", "c")), (("r1", "a", "b"), ("r2", "b", "c"), ("r3", "c", "d"))
    for t in (
        C.Template("context", three, ("a", "d"), "r", context=("tissue",), independent=True), C.Template("signed", two, ("a", "c"), "r", context=("tissue",), signed=-1),
        C.Template("gates", three, ("a", "d"), "r", mapping=("isoform_id",), gates=(C.pathogenic(1), C.names(0, 0))), C.Template("closed", two, ("a", "c"), "r", context=("tissue",), independent=True, triangle="close"),
        C.Template("turned", (("r2", "b", "c"), ("r1", "a", "b")), ("a", "c"), "r", triangle="close"),
    ):
        paths = C.derive(e, t)
        want = {r.reason: r.paths for r in C.ledger(paths).collect()}
        assert {r.reason: r.paths for r in C.counted(e, t).collect()} == want, t.name
        assert C.path_count(e, t) == sum(want.values())
        some = {r.reason: r.paths for r in C.counted(e, t, max_paths=3).collect()}
        full = want.get("accepted", 0)
        assert some == {k: v for k, v in (want | {"accepted": min(3, full), "max_paths_bound": max(0, full - 3)}).items() if v}
        kept = sorted((r.x_id, r.y_id, r.path) for r in paths.where("reason is null").collect())
        assert sorted((r.x_id, r.y_id, r.path) for r in C.accepted(e, t).collect()) == kept
        assert sorted((r.x_id, r.y_id, r.path) for r in C.accepted(e, t, 3).collect()) == kept[:3]
        if t.triangle:
            assert sorted((r.path, r.reason or "") for r in C.closed(e, t).collect()) == sorted((r.path, r.reason or "") for r in paths.collect() if r.reason != "no_closing_edge" and (r.reason or True) and (r.x_id, r.y_id) in {(c.x_id, c.y_id) for c in e.where("relation = 'close'").collect()})
    import pytest

    assert C.bounded(e, t, 10**6).count() == C.path_count(e, t)
    with pytest.raises(ValueError, match="joins"):
        C.bounded(e, t, 2)


def test_join_order_starts_with_the_small_part(spark):
    rows = [(f"a{i}", "b0", "r1") for i in range(50)] + [("b0", f"c{i}", "r2") for i in range(50)] + [("c1", "d1", "r3")]
    e = spark.createDataFrame(rows, "x_id string, y_id string, relation string")
    t = C.Template("chain", (("r1", "a", "b"), ("r2", "b", "c"), ("r3", "c", "d")), ("a", "d"), "r")
    assert C.join_order(e, t)[-1] == 0 and C.path_count(e, t) == 50 and C.path_count(e, t, [0, 1]) == 2500
    hub = C.Template("hub", (("r1", "a", "b"), ("r2", "b", "c")), ("a", "c"), "r", triangle="close")
    closing = spark.createDataFrame([("a1", "c2", "close"), ("a3", "c999", "close")], "x_id string, y_id string, relation string")
    assert [(r.x_id, r.y_id) for r in C.closed(e.unionByName(closing), hub).collect()] == [("a1", "c2")]
    assert {r.reason: r.paths for r in C.counted(e.unionByName(closing), hub).collect()} == {"accepted": 1, "no_closing_edge": 2499}


def test_signs_and_context(spark):
    assert one(spark, C.sign(F.col("c")), c="agonist, Increase") == 1
    assert one(spark, C.sign(F.col("c")), c="agonist,inhibitor") == 0
    assert one(spark, C.sign(F.col("c")), c="unknown") is None
    assert one(spark, C.agree(F.col("a"), F.col("b")), a="liver", b="unknown") is True
    assert one(spark, C.shared(F.col("a"), F.col("b")), a="liver", b="unknown") is False
    assert one(spark, C.independent(F.col("a"), F.col("b")), a="s1", b="s2,s1") is False


def test_split_is_disjoint_and_stable(spark):
    e = spark.range(500).select(F.lit("r").alias("relation"), F.concat(F.lit("a"), F.col("id").cast("string")).alias("x_id"), F.concat(F.lit("b"), (F.col("id") % 37).cast("string")).alias("y_id"))
    a = S.stratified(e, 1, 0.1, 0.2)
    b = S.stratified(e.repartition(7), 1, 0.1, 0.2)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {r.split: r["count"] for r in a.groupBy("split").count().collect()} == {"test": 50, "valid": 100, "train": 350}
    assert all(r.n == 0 for r in S.leaks(a).collect())


def test_negatives_avoid_positives(spark):
    n = spark.createDataFrame([("p", f"p{i}") for i in range(20)] + [("s", "s1")], "node_type string, id string")
    pos = spark.createDataFrame([("s1", "s", f"p{i}", "p", "r") for i in range(10)], "x_id string, x_type string, y_id string, y_type string, relation string")
    neg = S.filtered(S.negatives(pos, G.dense_index(n), 5, k=4), pos)
    assert neg.count() > 0 and neg.join(pos, ["x_id", "y_id"]).count() == 0


def test_migrate_flips_and_reports(spark):
    e = spark.createDataFrame([("g", "gene", "d", "disease", "old"), ("d", "disease", "g", "gene", "old"), ("a", "x", "b", "y", "gone")], "x_id string, x_type string, y_id string, y_type string, relation string")
    rules = spark.createDataFrame([("old", "new", "gene", "disease")], "old string, relation string, source_type string, target_type string")
    ok, bad = migrate.migrate(e, rules)
    assert {(r.x_id, r.y_id, r.relation) for r in ok.collect()} == {("g", "d", "new")} and bad.first().n == 1


def test_evidence_contract(spark):
    reg = spark.createDataFrame([("r", "a", "b")], "relation string, source_type string, target_type string")
    e = spark.createDataFrame([("r", "1", "a", "2", "b", "s", 1), ("r", "1", "a", "2", "b", "s", 2), ("r", "1", "b", "2", "a", "s", 3), ("q", "1", "a", "2", "b", "s", 4)], "relation string, x_id string, x_type string, y_id string, y_type string, source string, seq int")
    got = ev.coerce_evidence(e, reg).collect()
    assert len(got) == 1 and got[0].seq == 2 and got[0].edge_key == "r|1|2" and got[0].paper_id == ""


def test_text_readers(spark, tmp_path):
    (tmp_path / "a.obo").write_text("format-version: 1\n\n[Term]\nid: X:1\nname: one\nis_a: X:0 ! zero\nis_a: X:9\n\n[Typedef]\nid: part_of\n\n[Term]\nid: X:2\nname: two: too\n")
    got = {r.id: r.fields for r in readers.stanzas(spark, str(tmp_path / "a.obo")).collect()}
    assert got == {"X:1": {"id": ["X:1"], "name": ["one"], "is_a": ["X:0 ! zero", "X:9"]}, "X:2": {"id": ["X:2"], "name": ["two: too"]}}
    (tmp_path / "b.obo").write_bytes(b"[Term]\r\nid: Y:1\r\nname: one\r\n\r\n[Term]\r\nid: Y:2\r\n")
    assert {r.id: r.fields for r in readers.stanzas(spark, str(tmp_path / "b.obo")).collect()} == {"Y:1": {"id": ["Y:1"], "name": ["one"]}, "Y:2": {"id": ["Y:2"]}}
    (tmp_path / "b.fa").write_text(">s1 a > b\nAC\n>s2\nT\n")
    assert {(r.id, r.description, r.sequence) for r in readers.fasta(spark, str(tmp_path / "b.fa")).collect()} == {("s1", "a > b", "AC"), ("s2", "", "T")}
    (tmp_path / "a.fa").write_text(">s1 first\nAC\nGT\n>s2\nTT\n")
    assert {(r.id, r.description, r.sequence) for r in readers.fasta(spark, str(tmp_path / "a.fa")).collect()} == {("s1", "first", "ACGT"), ("s2", "", "TT")}
    g = spark.createDataFrame([('gene_id "G1"; gene_name "N";',)], "a string")
    assert readers.attributes(g, "a").first().attrs == {"gene_id": "G1", "gene_name": "N"}


def test_nodes_keep_last(spark):
    old = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, name string")
    new = spark.createDataFrame([("a", "n1", 1), ("a", "n2", 2), ("c", "n", 1), (None, "x", 1)], "id string, name string, seq long")
    stored = old.withColumn("seq", F.lit(0).cast("long"))
    assert {(r.id, r.name) for r in sinks.merged_nodes(stored, new).collect()} == {("a", "n2"), ("b", "old"), ("c", "n")}


def test_incremental_append_equals_one_shot(spark, tmp_path):
    from kgloom.streaming import append

    plain = "x_id string, y_id string, relation string, source string, credibility long, seq long"
    evidence = ", paper_id string, author_group_key string, raw_score double, datatype string"
    rows = [(f"x{i % 5}", f"y{i % 3}", "r", ["drugbank", "go", "text", "other"][i % 7 % 4], i % 3 + 1, i, f"p{i % 6}" if i % 4 else None, f"g{i % 2}" if i % 5 else "", i / 40, "known_drug") for i in range(40)]
    for name, schema, width in (("plain", plain, 6), ("evidence", plain + evidence, 10)):
        at = tmp_path / name
        mine = [r[:width] for r in rows]
        for k in range(4):
            spark.createDataFrame(mine[k * 10 : k * 10 + 10], schema).coalesce(1).write.mode("append").parquet(str(at / "in"))
        append.append_edges(spark, str(at / "in"), spark.read.parquet(str(at / "in")).schema, str(at / "out"), str(at / "ck"), buckets=4)
        cols = [c for c in spark.read.parquet(str(at / "in")).columns if c != "seq"]
        got = sorted(map(repr, append.latest(spark, str(at / "out")).select(cols).collect()))
        assert got == sorted(map(repr, credibility.dedup_edges(spark.createDataFrame(mine, schema)).select(cols).collect()))


def test_merged_edges_take_stored_sources_apart(spark):
    schema = "x_id string, y_id string, relation string, source string, credibility long, seq long"
    stored = spark.createDataFrame([("x", "y", "r", "drugbank,go", 3)], schema.removesuffix(", seq long"))
    for source, want in (("drugbank", "drugbank,go"), ("text", "drugbank,go,text")):
        for extra in ({}, {"paper_id": F.lit("p")}):
            got = sinks.merged_edges(stored, spark.createDataFrame([("x", "y", "r", source, 1, 0)], schema).withColumns(extra)).first()
            assert (got.source, got.credibility) == (want, 3)


def test_numbered_rows_and_sums(spark):
    from kgloom.operators.graph import numbered

    rows = [(i % 3, (i * 37) % 101, i) for i in range(100)]
    got = {r.i: (r["__r"], r["__n"], r["__w"], r["__all"]) for r in numbered(spark.createDataFrame(rows, "g int, o int, i int"), ["g"], [F.col("o")], F.col("i")).collect()}
    for g in range(3):
        mine = sorted((o, i) for k, o, i in rows if k == g)
        for at, (_, i) in enumerate(mine):
            assert got[i] == (at + 1, len(mine), sum(x[1] for x in mine[: at + 1]), sum(x[1] for x in mine))


def test_reasons_and_features(spark):
    df = spark.createDataFrame([(1, 2), (5, 9), (7, 1)], "a int, b int")
    got = [tuple(r) for r in df.select(audit.first_reason(low=F.col("a") < 3, odd=F.col("b") % 2 == 1), audit.all_reasons(low=F.col("a") < 3, odd=F.col("b") % 2 == 1)).collect()]
    assert got == [("low", "low"), ("odd", "odd"), ("odd", "odd")]
    v = features.hashed_text(spark.createDataFrame([(1, "One two one"), (2, None), (3, "a")], "id int, text string"), "text", 16)
    norms = {r.id: round(sum(x * x for x in r.vector), 6) for r in v.collect()}
    assert norms == {1: 1.0, 2: 0.0, 3: 0.0}


def test_nearest_takes_every_query_and_breaks_ties_by_id(spark):
    rows = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(60)] + [(60, [0.0, 0.0, 0.0]), (61, None), (None, [1.0, 1.0, 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = sorted(tuple(r) for r in lookup.nearest(v, v.where("vec_id % 10 = 0"), 4, block=3).collect())

    def cosine(x, y):
        norm = (sum(a * a for a in x) * sum(a * a for a in y)) ** 0.5
        return round(sum(a * b for a, b in zip(x, y)) / norm, 9) if norm else 0.0

    good = [r for r in rows if None not in r]
    want = [(q, i, s) for q, x in good if q % 10 == 0 for s, i in sorted(((cosine(x, y), i) for i, y in good if i != q), key=lambda p: (-p[0], p[1]))[:4]]
    assert [r[:2] for r in got] == sorted(r[:2] for r in want) and len(got) == 28
    assert all(abs(a[2] - b[2]) < 1e-8 for a, b in zip(got, sorted(want)))
    assert lookup.nearest(v, v.where("false"), 4).count() == 0


def test_search_prunes_clustered_vectors(spark):
    """Rows equal a comparison of all pairs, while a small share of them is compared; equal vectors and a bad seed chunk included."""
    import random

    import numpy as np

    rng = random.Random(6)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.02) for c in centres[i % 12]]) for i in range(1200)] + [(1200 + i, centres[0]) for i in range(5)] + [(1250, [0.0] * 8), (1251, [-c for c in centres[3]])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    asked = v.where("vec_id % 10 = 0 or vec_id >= 1250")
    got, report = lookup.search(v, asked, 6, block=7, chunk=16)
    x = np.array([r[1] for r in rows])
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    sim = np.round(np.divide(x, norm, out=np.zeros_like(x), where=norm > 0) @ np.divide(x, norm, out=np.zeros_like(x), where=norm > 0).T, 9)
    ids = np.array([r[0] for r in rows])
    want = {}
    for k, (i, _) in enumerate(rows):
        if i % 10 == 0 or i >= 1250:
            others = np.flatnonzero(ids != i)
            order = others[np.lexsort((ids[others], -sim[k][others]))][:6]
            want[i] = [(int(ids[o]), float(sim[k][o])) for o in order]
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.similarity))
    near = lambda a, b: [x for x, _ in a] == [x for x, _ in b] and all(abs(x - y) < 1e-8 for (_, x), (_, y) in zip(a, b))
    assert found.keys() == want.keys() and all(near(sorted(found[i], key=lambda r: (-r[1], r[0])), want[i]) for i in want)
    share = report.first()
    assert 0 < share.compared < 0.3 * share.all_pairs


def test_label_matrix_counts_what_it_does_not_list(spark):
    split = spark.createDataFrame([("a", "y", "test"), ("a", "y", "train"), ("b", "y", "valid"), ("c", "z", "train")], "x_id string, y_id string, split string")
    asked = spark.createDataFrame([("y",), ("w",), (None,), ("y",)], "y_id string")
    got = sorted((tuple(r) for r in S.label_matrix(asked, split, split).collect()), key=str)
    assert got == [("w", None, None, 3), ("y", "a", 1, 1), ("y", "b", -1, 1)]


def test_group_consensus_matches_all_pairs_of_members(spark):
    """Several, shared, nested, equal, unknown and more than 63 sources; native support; large groups."""
    import itertools
    import random

    rng = random.Random(8)
    names = [f"s{i}" for i in range(6)]
    pick = lambda k: ",".join(rng.sample(names, k))
    members = [(f"g{g}", f"m{m}", rng.choice(["own", "own", "", "s1,own"])) for g in range(25) for m in rng.sample(range(12), rng.randrange(1, 7))]
    members += [("big", f"m{m}", "own") for m in range(8)] + [("wide", "w1", "own"), ("wide", "w2", "own"), ("nest", "w3", "own"), ("nest", "w4", "own")]
    targets = [(f"m{m}", f"y{y}", pick(rng.randrange(4)), rng.choice(["no", "no", "no", None, " TRUE ,x"])) for m in range(12) for y in range(4) if rng.random() < 0.7]
    many = [f"t{i}" for i in range(140)]
    targets += [("w1", "y0", ",".join(many[:70]), None), ("w2", "y0", ",".join(many[70:]), None), ("w1", "y1", ",".join(many[:71]), None), ("w2", "y1", ",".join(many[70:]), None), ("w3", "y0", "b", None), ("w4", "y0", "a,b", None)]
    known = lambda t: {x.strip().lower() for x in (t or "").split(",")} - {"", "unknown"}
    want = {}
    for g, y in {(g, t[1]) for g, m, _ in members for t in targets if t[0] == m}:
        paths = [(m, known(s), known(t[2]), known(t[3]) & {"true", "1", "yes"}) for g2, m, s in members for t in targets if g2 == g and t[0] == m and t[1] == y]
        size = sum(x[0] == g for x in members)
        own = {}
        for m, a, b, _ in paths:
            if a and b and not a & b:
                own.setdefault(m, set()).update(b)
        native = any(p[3] for p in paths)
        apart = any(not own[a] & own[b] for a, b in itertools.combinations(own, 2))
        reason = "pathway_fanout" if size > 7 else None if native else "insufficient_independent_members" if len(own) < 2 else None if apart else "source_commonality_or_circularity"
        want[g, y] = (reason, None if reason else len({p[0] for p in paths}) if native else len(own))
    got = C.group_consensus(spark.createDataFrame(members, "x_id string, y_id string, source string"), spark.createDataFrame(targets, "x_id string, y_id string, source string, native_support string"), 7).collect()
    assert {(r.g, r.y): (r.reason, r.members) for r in got} == want and len(got) == len(want)
    assert {w[0] for w in want.values()} == {None, "pathway_fanout", "insufficient_independent_members", "source_commonality_or_circularity"}
    # The two cases of one source everywhere and of equal pairs of sources: refused.
    edges = "x_id string, y_id string, source string"
    nested = C.group_consensus(spark.createDataFrame([("g", "m1", "o"), ("g", "m2", "o"), ("h", "m3", "o"), ("h", "m4", "o")], edges), spark.createDataFrame([("m1", "y", "a,b"), ("m2", "y", "b"), ("m3", "y", "a,b"), ("m4", "y", "b,a")], edges)).collect()
    assert {r.reason for r in nested} == {"source_commonality_or_circularity"}
    empty = spark.createDataFrame([], edges)
    assert C.group_consensus(empty, empty).count() == 0
