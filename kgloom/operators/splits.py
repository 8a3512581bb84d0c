"""Train/valid/test splits, negative samples and candidate labels for link prediction.

Order is by a seeded hash of the keys, so a split is the same whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .cuts import cut
from .graph import draw, numbered

KEY = ["x_id", "y_id"]


def hash_order(seed: int, *cols: str) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *cols), *(F.col(c) for c in cols)]


def stratified(edges: DataFrame, seed: int, test: float, valid: float, order: list[Column] | None = None) -> DataFrame:
    """edges with `split`: per relation round(test * n) test rows, then round(valid / (1 - test) * rest) valid rows.

    In hash order nothing is sorted: counts by the first 16 bits of the hash tell the two slices of a relation in which it is
    cut, and only their rows are numbered."""
    n_test = F.round(F.col("__n") * test)
    n_valid = F.round((F.col("__n") - n_test) * (valid / (1 - test)))
    if order:
        r = numbered(edges, ["relation"], order)
        split = F.when(F.col("__r") <= n_test, "test").when(F.col("__r") <= n_test + n_valid, "valid").otherwise("train")
        return r.withColumn("split", split).drop("__n", "__r")
    rows = cut(edges.withColumn("__h", hash_order(seed, *KEY)[0])).withColumn("__slice", F.shiftright("__h", 48))
    whole = W.partitionBy("relation")
    sizes = rows.groupBy("relation", "__slice").agg(F.count(F.lit(1)).alias("__k"))
    sizes = sizes.withColumns({"__n": F.sum("__k").over(whole), "__b": F.sum("__k").over(whole.orderBy("__slice")) - F.col("__k")})
    at = lambda most, c: F.max(F.when((F.col("__b") < most) & (most <= F.col("__b") + F.col("__k")), c))
    cuts = sizes.groupBy(F.col("relation").alias("__of")).agg(*(at(most, c).alias(f"__{k}{i}") for i, most in enumerate((n_test, n_test + n_valid)) for k, c in (("s", F.col("__slice")), ("m", most - F.col("__b")))))
    # A row a relation.
    rows = rows.join(F.broadcast(cuts), F.col("relation").eqNullSafe(F.col("__of")), "left")
    divided = F.coalesce((F.col("__slice") == F.col("__s0")) | (F.col("__slice") == F.col("__s1")), F.lit(False))
    place = F.row_number().over(W.partitionBy("relation", "__slice").orderBy("__h", *KEY))
    rows = rows.where(divided).withColumn("__i", place).unionByName(rows.where(~divided).withColumn("__i", F.lit(0)))
    upto = lambda i: (F.col("__slice") < F.col(f"__s{i}")) | ((F.col("__slice") == F.col(f"__s{i}")) & (F.col("__i") <= F.col(f"__m{i}")))
    return rows.select(*edges.columns, F.when(upto(0), "test").when(upto(1), "valid").otherwise("train").alias("split"))


def hold_out(edges: DataFrame, entities: DataFrame, seed: int, valid: float = 0.05, order: list[Column] | None = None) -> DataFrame:
    """Edges of the given y entities are test; of the others, `valid` per relation is valid."""
    held = edges.join(entities.select(F.col("id").alias("y_id")).distinct(), "y_id", "left_semi").withColumn("split", F.lit("test"))
    rest = edges.join(entities.select(F.col("id").alias("y_id")).distinct(), "y_id", "left_anti")
    return held.unionByName(stratified(rest, seed, 0.0, valid, order))


def by_entity(edges: DataFrame, entity: str, seed: int, test: float, valid: float, order: list[Column] | None = None) -> DataFrame:
    """All edges of an entity share a split; entities are cut by fractions in hash order."""
    e = numbered(edges.select(entity).distinct(), [], order or hash_order(seed, entity))
    n_test, n_valid = F.round(F.col("__n") * test), F.round(F.col("__n") * valid)
    split = F.when(F.col("__r") <= n_test, "test").when(F.col("__r") <= n_test + n_valid, "valid").otherwise("train")
    return edges.join(e.select(entity, split.alias("split")), entity)


def few_neighbours(edges: DataFrame, targets: list[str], most: int = 3, entity: str = "y_id") -> DataFrame:
    """(id, n): target-relation entities with at most `most` incident edges of other relations, none included."""
    target = F.col("relation").isin(targets)
    ids = edges.where(target).select(F.col(entity).alias("id")).distinct()
    other = edges.where(~target)
    n = other.select(F.col("x_id").alias("id")).unionAll(other.select("y_id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return ids.join(n, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") <= most)


def few_targets(edges: DataFrame, targets: list[str], most: int = 3, entity: str = "y_id") -> DataFrame:
    """(id, n): entities with at most `most` target edges, counted by the entity itself."""
    return edges.where(F.col("relation").isin(targets)).groupBy(F.col(entity).alias("id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most)


def folds(edges: DataFrame, entity: str, k: int, seed: int, order: list[Column] | None = None) -> DataFrame:
    """edges with `fold` 1..k, equal for all edges of an entity; entities are dealt evenly in hash order."""
    e = numbered(edges.select(entity).distinct(), [], order or hash_order(seed, entity))
    small, at = F.floor(F.col("__n") / k), F.col("__r") - 1
    large = F.col("__n") % k * (small + 1)  # entities in folds that hold one more
    fold = F.when(at < large, F.floor(at / (small + 1))).otherwise(F.col("__n") % k + F.floor((at - large) / F.greatest(small, F.lit(1)))) + 1
    return edges.join(e.select(entity, fold.cast("int").alias("fold")), entity)


def three_way(edges: DataFrame, seed: int, most: int = 1024, order: list[Column] | None = None) -> DataFrame:
    """Per relation test = valid = min(n / 5, most), one at least; the rest trains."""
    r = numbered(edges, ["relation"], order or hash_order(seed, *KEY))
    k = F.greatest(F.lit(1), F.least(F.floor(F.col("__n") / 5), F.lit(most)))
    return r.withColumn("split", F.when(F.col("__r") <= k, "test").when(F.col("__r") <= 2 * k, "valid").otherwise("train")).drop("__n", "__r")


def leaks(split: DataFrame) -> DataFrame:
    """One row: pairs that stand in two splits, and held-out pairs that stand reversed in train."""
    # One row a pair of nodes in a relation, whichever way round: the splits that hold it each way, as bits.
    ahead, bit = F.col("x_id") <= F.col("y_id"), F.when(F.col("split") == "train", 1).when(F.col("split") == "valid", 2).when(F.col("split") == "test", 4).otherwise(0)
    known = split.where("relation is not null and x_id is not null and y_id is not null")
    at = lambda way: F.bit_or(F.when(way, bit).otherwise(0))
    pairs = known.groupBy("relation", F.least("x_id", "y_id").alias("__l"), F.greatest("x_id", "y_id").alias("__g")).agg(at(ahead).alias("__f"), at(~ahead).alias("__t"))
    # A loop is its own reverse.
    pairs = pairs.withColumn("__u", F.when(F.col("__l") == F.col("__g"), F.col("__f")).otherwise(F.col("__t"))).withColumn("__v", F.when(F.col("__l") == F.col("__g"), 0).otherwise(F.col("__f")))
    has = lambda c, bits: (F.col(c).bitwiseAND(F.lit(bits)) == bits).cast("long")
    both = lambda bits: has("__f", bits) + has("__t", bits)
    back = lambda held: has("__f", held) * has("__u", 1) + has("__t", held) * has("__v", 1)
    parts = {"train_valid": both(3), "train_test": both(5), "valid_test": both(6), "reversed": back(2) + back(4)}
    n = pairs.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in parts.items()))
    return n.select(F.inline(F.array(*(F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in parts))))


def negatives(positives: DataFrame, index: DataFrame, seed: int, k: int = 1, side: str = "y") -> DataFrame:
    """k corrupted copies of each positive (relation, x_id, x_type, y_id, y_type): the end `side` (x, y, or both) is replaced by
    a node of its type, drawn by a hash of the positive among all but the positive itself. index is (node_type, id, index),
    0..n-1 a type. The given ends are kept as x_pos and y_pos; a type of one node has nothing to draw."""
    ends = ["x", "y"] if side == "both" else [side]
    sizes = index.groupBy("node_type").agg((F.max("index") + 1).alias("__m"))
    p = positives.withColumns({"x_pos": F.col("x_id"), "y_pos": F.col("y_id"), "k": F.explode(F.sequence(F.lit(1), F.lit(k)))})
    for e in ends:
        own = index.select(F.col("node_type").alias(f"{e}_type"), F.col("id").alias(f"{e}_id"), F.col("index").alias(f"__own_{e}"))
        p = p.join(F.broadcast(sizes.select(F.col("node_type").alias(f"{e}_type"), F.col("__m").alias(f"__m_{e}"))), f"{e}_type").join(own, [f"{e}_type", f"{e}_id"])
    # One number stands for the drawn end, or for the pair of ends; numbers from the positive's own on are shifted by one.
    size, own = (F.col(f"__m_{side}"), F.col(f"__own_{side}")) if side != "both" else (F.col("__m_x") * F.col("__m_y"), F.col("__own_x") * F.col("__m_y") + F.col("__own_y"))
    p = p.withColumn("__all", size).where("__all > 1").withColumn("__at", F.pmod(draw(F.lit(str(seed)), "x_pos", "y_pos", F.col("k").cast("string")), F.col("__all") - 1))
    p = p.withColumn("__at", F.col("__at") + F.when(F.col("__at") >= own, 1).otherwise(0))
    place = {side: F.col("__at")} if side != "both" else {"x": F.expr("__at div __m_y"), "y": F.expr("__at % __m_y")}
    for e in ends:
        to = index.select(F.col("node_type").alias(f"{e}_type"), F.col("index").alias(f"__i_{e}"), F.col("id").alias(f"__to_{e}"))
        p = p.withColumn(f"__i_{e}", place[e]).join(to, [f"{e}_type", f"__i_{e}"]).withColumn(f"{e}_id", F.col(f"__to_{e}"))
    return p.select(*positives.columns, "x_pos", "y_pos", "k")


def weighted_negatives(positives: DataFrame, degrees: DataFrame, seed: int, power: float = 0.75) -> DataFrame:
    """One corrupted copy of each positive whose target is drawn with weight degree**power, in thousandths and at least one (a negative
    power favours rare nodes). degrees is (id, degree), all of one type. The line of all weights is cut into equal slots, as
    many as there are nodes, 2^22 at most, so the draw is an equi-join on the slot followed by a range test of few nodes."""
    own = F.greatest(F.lit(1), F.round(1000 * F.pow(F.col("degree"), F.lit(power)))).cast("long")
    cum = numbered(degrees.where("degree > 0"), [], [F.col("id")], own)
    top = cum.agg(F.max("__all"), F.max("__n")).first()
    total, slots = top[0] or 1, max(1024, min(1 << 22, top[1] or 1))
    width = total // slots + 1
    cum = cum.select("id", (F.col("__w") - own).alias("lo"), F.col("__w").alias("hi"))
    cum = cum.withColumn("slot", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))))
    p = positives.withColumn("u", F.pmod(draw(F.lit(str(seed)), *KEY), F.lit(total))).withColumn("slot", F.expr(f"u div {width}"))
    return p.join(cum.select("slot", "lo", "hi", F.col("id").alias("__to")), "slot").where("u >= lo and u < hi").withColumn("y_id", F.col("__to")).drop("__to", "u", "slot", "lo", "hi")


def filtered_negatives(positives: DataFrame, existing: DataFrame, index: DataFrame, seed: int, k: int = 1, side: str = "y", attempts: int = 20) -> DataFrame:
    """k negatives of each distinct positive that are no existing pair and all different: (relation, x_pos, y_pos, k, x_id,
    y_id, attempt, reason).

    Each attempt draws for the slots still open only, refuses pairs that exist or are taken (two slots that draw one pair: the
    first by its positive keeps it), and leaves the rest open. Slots open after `attempts` rounds have null ends and the reason
    attempts_exhausted, or too_few_nodes when their type has nothing else to draw. A job an attempt, when the plan is made.
    """
    slot = ["relation", "x_pos", "y_pos", "k"]
    types = ["x_type", "y_type"]
    once = positives.select("relation", *KEY, *types).distinct()
    open_ = once.select("relation", F.col("x_id").alias("x_pos"), F.col("y_id").alias("y_pos"), *types).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(k))))
    seen = existing.select("relation", *KEY).distinct()
    taken = None
    for n in range(1, attempts + 1):
        asked = once if n == 1 else open_.select("relation", F.col("x_pos").alias("x_id"), F.col("y_pos").alias("y_id"), *types).distinct()
        drawn = negatives(asked, index, seed + n, k, side)
        drawn = drawn.join(open_.select(*slot), slot, "left_semi") if n > 1 else drawn
        drawn = drawn.join(seen, ["relation", *KEY], "left_anti")
        if taken is not None:
            drawn = drawn.join(taken, ["relation", *KEY], "left_anti")
        won = drawn.groupBy("relation", *KEY).agg(F.min(F.struct("x_pos", "y_pos", "k")).alias("__s"))
        won = cut(won.select("relation", "__s.*", *KEY, F.lit(n).alias("attempt")))
        taken = won if taken is None else taken.unionByName(won)
        open_ = cut(open_.join(won.select(*slot), slot, "left_anti"))
        if open_.isEmpty():
            break
    sizes = index.groupBy("node_type").agg(F.count(F.lit(1)).alias("__m"))
    few = F.lit(True)
    for e in ["x", "y"] if side == "both" else [side]:
        open_ = open_.join(F.broadcast(sizes.select(F.col("node_type").alias(f"{e}_type"), F.col("__m").alias(f"__{e}"))), f"{e}_type", "left")
        few = few & (F.coalesce(f"__{e}", F.lit(0)) <= 1)
    none = F.lit(None).cast("string")
    left = open_.select(*slot, none.alias("x_id"), none.alias("y_id"), F.lit(None).cast("int").alias("attempt"), F.when(few, "too_few_nodes").otherwise("attempts_exhausted").alias("reason"))
    return taken.select(*slot, *KEY, "attempt", none.alias("reason")).unionByName(left)


def filtered(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct candidates that aren't existing pairs."""
    return candidates.select("relation", *KEY).distinct().join(existing.select("relation", *KEY), ["relation", *KEY], "left_anti")


def label_matrix(queries: DataFrame, candidates: DataFrame, split: DataFrame) -> DataFrame:
    """(y_id, x_id, label, n_other): the labels of the observed pairs of a query entity and a candidate, 1 for a test edge and
    -1 for one seen in training or validation only. All n_other other candidates of that entity have label 0: they are
    counted, not listed, so the result is as large as the edges and not as entities times candidates. An entity without an
    observed candidate has one row with a null x_id and label."""
    asked, known = queries.select("y_id").where("y_id is not null").distinct(), candidates.select("x_id").where("x_id is not null").distinct()
    seen = split.groupBy("x_id", "y_id").agg(F.max(F.when(F.col("split") == "test", 1).otherwise(-1)).alias("label")).join(known, "x_id", "left_semi")
    many = seen.groupBy("y_id").agg(F.count(F.lit(1)).alias("__n"))
    # One row of one count.
    asked = asked.join(many, "y_id", "left").crossJoin(F.broadcast(known.agg(F.count(F.lit(1)).alias("__all"))))
    return asked.join(seen, "y_id", "left").select("y_id", "x_id", "label", (F.col("__all") - F.coalesce("__n", F.lit(0))).alias("n_other"))
