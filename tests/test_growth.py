"""Work that must not grow with the square of a group: rows that joins make, by the metrics of the plan that ran."""

import random
from collections import Counter

from pyspark.sql import functions as F

from kgloom.jobs import tabular
from kgloom.operators import compose as C, graph as G, intervals, splits as S
from kgloom.plans.catalog import QUERIES


def join_rows(df):
    """The rows of df, and how many rows each join of its plan made."""
    rows, made = df.collect(), []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if "Join" in kind or kind == "CartesianProductExec":
            made.append(node.metrics().apply("numOutputRows").value())
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        children = node.children()
        for child in inner + [children.apply(i) for i in range(children.size())]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return rows, made


def test_localisations_of_an_accession_join_its_proteins_once(spark):
    rows = spark.range(600).select(F.lit("a").alias("accession"), F.when(F.col("id") == 77, "Enhanced").otherwise("Uncertain").alias("reliability"), F.when(F.col("id") % 2 == 0, "Mode O; ").otherwise("site 1").alias("labels"))
    proteins = spark.range(200).select(F.lit("a").alias("accession"), F.col("id").alias("protein")).unionAll(spark.range(3).select(F.lit("b"), F.col("id")))
    mapping = spark.createDataFrame([("Mode O", "GO:1")], "label string, component string")
    found, made = join_rows(tabular.localisations(rows, proteins, mapping))
    assert Counter((r.component, r.credibility) for r in found) == {("GO:1", 1): 200, ("local:site_1", 3): 200}
    assert max(made) <= 1200  # 900 labels are mapped; the rows of an accession times its proteins are 120,000


def test_pairs_of_points_and_intervals_are_added_up_without_building_them(spark):
    """Against all pairs: lengths 1 to 10^8, equal rows, nulls, padding, large values, and bins that are cut again."""
    rng = random.Random(6)
    near = lambda: rng.choice([rng.randrange(-50, 300), rng.randrange(3 * 10**8), 5_000 + rng.randrange(40)])
    points = [(rng.choice("ab"), near(), rng.choice([None, 3, -(2**62), 2**62 - 1])) for _ in range(3000)] + [("a", None, 1), (None, 5, 1), ("c", 1, None), ("c", 2, 8)]
    spans = [(rng.choice("ab"), (s := near()), s + 10 ** rng.randrange(9) - 1, k) for k in range(150)] + [("a", None, 5, 900), ("a", 9, 3, 901), ("c", 0, 1, 902), ("c", 0, 2, 903), ("c", 0, 2, 903), ("d", 0, 9, 904)]
    p, i = spark.createDataFrame(points, "c string, p long, v long"), spark.createDataFrame(spans, "c string, s long, e long, k long")
    for padding in (0, 3):
        want = {}
        for c, x, v in points:
            for d, s, e, k in spans:
                if None not in (c, x, s) and c == d and s <= e and s - padding <= x <= e + padding:
                    want.setdefault(k, []).append(v)
        held = {k: vs for k, vs in want.items() if -(2**63) <= sum(v or 0 for v in vs) < 2**63}
        assert len(held) > 20 and held[903].count(8) == 2
        got = intervals.summed(p, i.join(spark.createDataFrame([(k,) for k in held], "k long"), "k", "left_semi"), "c", "p", "s", "e", ["k"], {"v": F.col("v")}, padding).collect()
        assert {r.k: (r["__pairs"], r.v) for r in got} == {k: (len(vs), sum(v for v in vs if v is not None) if any(v is not None for v in vs) else None) for k, vs in held.items()}
    assert intervals.summed(p.limit(0), i.limit(0), "c", "p", "s", "e", ["k"], {"v": F.col("v")}).count() == 0


def test_interval_queries_make_no_row_a_pair(spark, tmp_path):
    """400 points lie in each of 300 intervals: 120,000 pairs."""
    day = F.lit("1995-01-10").cast("timestamp")
    spark.range(300).select((F.col("id") * 7 + 3).alias("o_orderkey"), F.lit(0).cast("long").alias("o_custkey"), day.alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(400).select((F.col("id") * 7 + 3).alias("l_orderkey"), F.lit(0).cast("long").alias("l_suppkey"), F.lit(2700).cast("long").alias("l_partkey"), day.alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    found, made = join_rows(QUERIES["o55_interval_join"](spark, str(tmp_path)))
    assert found[0].pairs == 120_000 and max(made) <= 1_400
    found, made = join_rows(QUERIES["o55_wide_intervals"](spark, str(tmp_path)))
    assert sum(r.points for r in found) > 20_000 and max(made) <= 1_400


def test_sets_that_must_share_two_members_do_not_meet_on_one(spark):
    """400 sets of four members; any two share one at most, and 3,800 of them share one that is in their prefixes."""
    rows = [(f"s{i}-{j}", y) for i in range(20) for j in range(20) for y in (f"r{i}", f"c{j}", f"own{i}-{j}", f"too{i}-{j}")]
    rows += [("one", "r1"), ("five", "r1"), *(("five", f"f{k}") for k in range(4))]
    found, made = join_rows(G.similar_neighbours(spark.createDataFrame(rows, "x_id string, y_id string"), 0.5)[1])
    assert {(r.a, r.b, r.shared) for r in found} == {("one", f"s1-{j}", 1) for j in range(20)}
    assert max(made) <= 20


def test_split_by_hash_equals_the_full_order_and_leaks_read_it_once(spark):
    rows = [(r, f"x{i % 97}", f"y{i % 89}") for r, n in (("a", 4000), ("b", 7), ("c", 1), (None, 30)) for i in range(n)] + [("a", None, "y1"), ("d", "x", "x"), ("d", "y", "x"), ("d", "x", "y")]
    e = spark.createDataFrame(rows, "relation string, x_id string, y_id string")
    order = [F.xxhash64(F.lit(1), "x_id", "y_id"), F.col("x_id"), F.col("y_id")]
    key = lambda df: Counter(map(tuple, df.select("relation", "x_id", "y_id", "split").collect()))
    for test, valid in ((0.05, 0.11875), (0.0, 0.3), (0.5, 0.5)):
        assert key(S.stratified(e, 1, test, valid)) == key(S.stratified(e, 1, test, valid, order))
    split = spark.createDataFrame([("r", "a", "b", "train"), ("r", "b", "a", "test"), ("r", "b", "a", "valid"), ("r", "a", "b", "valid"), ("r", "c", "c", "train"), ("r", "c", "c", "test"), ("s", "b", "a", "train"), ("r", "c", "c", "test"), ("r", None, "a", "train"), ("r", None, "a", "test")], "relation string, x_id string, y_id string, split string")
    found, made = join_rows(S.leaks(split))
    assert {r.check: r.n for r in found} == {"train_valid": 1, "train_test": 1, "valid_test": 1, "reversed": 3}
    assert made == []


def test_rewiring_all_edges_orders_none(spark):
    e = spark.createDataFrame([(f"x{i % 5}", "x", f"y{i}", "y", r) for i in range(40) for r in "pq"], "x_id string, x_type string, y_id string, y_type string, relation string")
    nodes = spark.createDataFrame([(f"{t}{i}", t) for t in "xy" for i in range(40)], "id string, node_type string")
    found, made = join_rows(G.rewired(e, G.dense_index(nodes), 7))
    assert Counter(r.relation for r in found) == {"p": 40, "q": 40} and all(r.x_id[0] == "x" and r.y_id[0] == "y" for r in found)
    assert made == [80] * 4  # sizes and names of both ends; no places in a relation


def test_samples_build_paths_of_the_first_sources_only(spark, monkeypatch):
    """Samples equal those of all paths, whether the reasons come early, late, or fewer than n times."""
    rows = [(f"s{i:03}", f"p{j}", "a", "left", "benign" if i == 190 else "increase") for i in range(200) for j in range(4)] + [(f"o{i:02}", f"p{i % 4}", "b", "right", "increase" if i % 3 else "decrease") for i in range(40)]
    e = spark.createDataFrame(rows, "x_id string, y_id string, relation string, source string, direction string")
    t = C.Template("t", (("a", "s", "p"), ("b", "o", "p")), ("s", "o"), "r", signed=-1)
    told = lambda df: sorted((r.reason, r.r, r.x_id, r.y_id, r.path) for r in df.collect())
    for first in (2, 8, 300):
        assert told(C.samples(e, t, 3, first)) == told(C.ledger_samples(C.derive(e, t), 3))
    monkeypatch.setattr(C, "cut", lambda df: df)
    plain = e.where("direction <> 'benign'")
    found, made = join_rows(C.samples(plain, t, 3, 2))
    assert len(found) == 3 and max(made) <= 80  # two sources; all paths are 7,960


def test_supports_of_candidates_do_not_travel(spark):
    rows = [(f"s{i}", f"p{j}", "a", "left", "x") for i in range(6) for j in (i % 3, 12, 1)] + [(f"o{i}", f"p{j}", "b", "right" if i else "left", "x") for i in range(6) for j in (i % 3, 12)]
    e = spark.createDataFrame(rows, "x_id string, y_id string, relation string, source string, tissue string")
    t = C.Template("t", (("a", "s", "p"), ("b", "o", "p")), ("s", "o"), "r", context=("tissue",), independent=True)
    told = lambda df: sorted(tuple(r) for r in df.collect())
    got = C.candidates(C.gathered(e, t))
    assert told(got) == told(C.candidates(C.accepted(e, t))) != []
    assert "hashpartitioning(template" not in got._jdf.queryExecution().executedPlan().toString()
