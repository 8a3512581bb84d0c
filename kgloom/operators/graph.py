"""Graph operators: indexing, neighbourhoods, closure, composition of paths, perturbation, walks, similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .cuts import cut


def numbered(df: DataFrame, group: list[str], order: list[Column], weight: Column | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    """df with __r, the place of each row in its group by `order`, from 1, and __n, the group's size; with a weight also __w,
    the sum of weights up to and with the row, and __all, the group's sum; for each further weight __w_<name> and __all_<name>.

    Rows are range-partitioned by (group, order); each partition numbers its own rows and adds what stands in the partitions
    before it, so no group needs to fit one task.
    """
    weights = ({"": weight} if weight is not None else {}) | {f"_{k}": c for k, c in (more or {}).items()}
    keys = {f"__o{i}": c for i, c in enumerate(order)}
    rows = df.withColumns(keys | {f"__v{k}": c for k, c in weights.items()})
    # A range exchange samples anew whenever it runs: both readers below need the same written partitions.
    rows = cut(rows.repartitionByRange(*group, *keys).withColumn("__p", F.spark_partition_id()))
    sizes = rows.groupBy("__p", *group).agg(F.count(F.lit(1)).alias("__k"), *(F.sum(f"__v{k}").alias(f"__s{k}") for k in weights))
    # A row a partition and group.
    inside, whole = W.partitionBy("__p", *group).orderBy(*keys), W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = whole.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = [x for k in weights for x in (zero(F.sum(f"__s{k}").over(before)).alias(f"__c{k}"), F.sum(f"__s{k}").over(whole).alias(f"__all{k}"))]
    sizes = sizes.select(F.col("__p").alias("__q"), *(F.col(g).alias(f"__g{i}") for i, g in enumerate(group)), zero(F.sum("__k").over(before)).alias("__b"), F.sum("__k").over(whole).alias("__n"), *sums)
    new = {"__i": F.row_number().over(inside)} | {f"__u{k}": F.sum(f"__v{k}").over(inside.rowsBetween(W.unboundedPreceding, 0)) for k in weights}
    # Groups of null are groups like others.
    same = F.col("__p") == F.col("__q")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    out = rows.withColumns(new).join(sizes, same).withColumn("__r", F.col("__i") + F.col("__b"))
    out = out.withColumns({f"__w{k}": F.col(f"__u{k}") + F.col(f"__c{k}") for k in weights}) if weights else out
    return out.drop(*keys, "__p", "__q", "__i", "__b", *(f"__g{i}" for i in range(len(group))), *(f"__{x}{k}" for k in weights for x in "vuc"))


def dense_index(nodes: DataFrame, kind: str = "node_type", key: str = "id") -> DataFrame:
    """(type, id, index): 0..n-1 per type in id order."""
    ids = nodes.where(F.col(key).isNotNull()).select(kind, key).distinct()
    return numbered(ids, [kind], [F.col(key)]).select(kind, key, (F.col("__r") - 1).cast("long").alias("index"))


def edge_index(edges: DataFrame, index: DataFrame) -> DataFrame:
    """edges with src and dst indexes; a missing end has a null index."""
    m = lambda e, name: index.select(F.col("node_type").alias(f"{e}_type"), F.col("id").alias(f"{e}_id"), F.col("index").alias(name))
    return edges.join(m("x", "src"), ["x_type", "x_id"], "left").join(m("y", "dst"), ["y_type", "y_id"], "left")


def undirected(edges: DataFrame, seq: str = "seq") -> DataFrame:
    """Relations named a_a keep one row per unordered pair; others keep rows of the first row's source type."""
    parts = F.split("relation", "_")
    same = parts[0] == F.try_element_at(parts, F.lit(2))
    first = edges.groupBy("relation").agg(F.min_by("x_type", seq).alias("__first"))
    j = edges.join(F.broadcast(first), "relation").withColumn("__same", F.coalesce(same, F.lit(False)))
    one = F.row_number().over(W.partitionBy("relation", F.least("x_id", "y_id"), F.greatest("x_id", "y_id")).orderBy(seq))
    paired = j.where("__same").withColumn("__r", one).where("__r = 1").drop("__r")
    return paired.unionByName(j.where("not __same and x_type = __first")).drop("__first", "__same")


def reversed_edges(edges: DataFrame) -> DataFrame:
    """edges and their reverse; the reverse of a relation between different types is called rev_<relation>."""
    swap = {"x_id": F.col("y_id"), "x_type": F.col("y_type"), "y_id": F.col("x_id"), "y_type": F.col("x_type"), "relation": F.when(F.col("x_type") != F.col("y_type"), F.concat(F.lit("rev_"), "relation")).otherwise(F.col("relation"))}
    return edges.unionByName(edges.select(*(swap.get(c, F.col(c)).alias(c) for c in edges.columns)))


def two_hops(edges: DataFrame, anchor: str) -> DataFrame:
    """Distinct edges at the anchor or at one of its neighbours."""
    return k_hops(edges, edges.sparkSession.createDataFrame([(anchor,)], "id string"), 2)


def k_hops(edges: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """Distinct edges within k hops of a set of nodes: every edge with an end that is less than k steps away. The nodes reached
    are written after each hop, a job when the plan is made."""
    touch = lambda ids: edges.join(ids.withColumnRenamed("id", "x_id"), "x_id", "left_semi").select(*edges.columns).unionAll(edges.join(ids.withColumnRenamed("id", "y_id"), "y_id", "left_semi").select(*edges.columns))
    reach = anchors.select("id").distinct()
    for _ in range(k - 1):
        near = touch(reach)
        reach = cut(reach.unionAll(near.select(F.col("x_id").alias("id"))).unionAll(near.select("y_id")).distinct())
    return touch(reach).distinct()


def subgraph(edges: DataFrame, anchors: DataFrame, k: int, targets: list[str], sample: int, seed: int) -> DataFrame:
    """Distinct edges with `part`: `hop` for those within k hops of the anchors, `target` for all other edges of the target
    relations at an anchor, and `test` for `sample` further edges of the target relations, drawn by a hash of their ends.

    The draw is numbered over range partitions; targets at an anchor are within the first hop, so with k of 1 or more they are
    told as `target`, not as `hop`.
    """
    ids, mine = anchors.select("id").distinct(), F.col("relation").isin(*targets)
    at = lambda e: edges.where(mine).join(ids.withColumnRenamed("id", e), e, "left_semi").select(*edges.columns)
    target = at("x_id").unionAll(at("y_id")).distinct()
    hop = k_hops(edges, anchors, k).join(target.select("relation", "x_id", "y_id"), ["relation", "x_id", "y_id"], "left_anti").select(*edges.columns)
    found = cut(hop.withColumn("part", F.lit("hop")).unionByName(target.withColumn("part", F.lit("target"))))
    rest = edges.where(mine).join(found.select("relation", "x_id", "y_id"), ["relation", "x_id", "y_id"], "left_anti").select(*edges.columns).distinct()
    drawn = numbered(rest, [], [draw(F.lit(str(seed)), "relation", "x_id", "y_id"), F.col("x_id"), F.col("y_id")]).where(F.col("__r") <= sample)
    return found.unionByName(drawn.select(*edges.columns, F.lit("test").alias("part")))


def closure(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(ancestor, descendant, depth) over child -> parent edges (x_id, y_id) with the shortest depth; an entity is not its own
    ancestor, whatever cycles there are.

    Depths double: when all pairs up to depth r are known, those at exactly r are joined with all of them, which gives each
    pair between r and 2r by the nodes in the middle of its shortest paths. A chain of n takes about log2(n) rounds, each one
    job, when the plan is made; nothing is cut off. With `most`, needing more rounds is an error.
    """
    step = edges.select(F.col("x_id").alias("descendant"), F.col("y_id").alias("ancestor")).where("descendant <> ancestor").distinct()
    found = edge = cut(step.select("ancestor", "descendant", F.lit(1).alias("depth")))
    reach, rounds = 1, 0
    while not edge.isEmpty():
        if most is not None and rounds >= most:
            raise ValueError(f"paths of more than {reach} steps: {most} rounds don't close them")
        up = found.select(F.col("ancestor").alias("__top"), F.col("descendant").alias("ancestor"), F.col("depth").alias("__more"))
        more = edge.join(up, "ancestor").where(F.col("__top") != F.col("descendant")).groupBy(F.col("__top").alias("ancestor"), "descendant").agg((F.min("__more") + reach).cast("int").alias("depth"))
        new = cut(more.join(found, ["ancestor", "descendant"], "left_anti"))
        found, reach, rounds = found.unionByName(new), 2 * reach, rounds + 1
        edge = new.where(F.col("depth") == reach)
    return found


def code_nodes(below: DataFrame, xrefs: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(code, id): the nodes that a code of an ontology stands for: those of itself and its descendants.

    below is the closure (ancestor, descendant), xrefs (code, entity), groups (entity, group_id), nodes (id). A code's entities
    by cross-reference count where they are nodes, and so do the groups that hold such an entity.
    """
    codes = xrefs.select("code").unionAll(below.select("ancestor")).where("code is not null").distinct()
    members = below.select(F.col("ancestor").alias("top"), F.col("descendant").alias("code")).unionAll(codes.select("code", "code")).toDF("top", "code").distinct()
    reached = members.join(xrefs, "code").select(F.col("top").alias("code"), "entity").distinct()
    found = reached.select("code", F.col("entity").alias("id")).unionAll(reached.join(groups, "entity").select("code", "group_id")).distinct()
    return found.join(nodes.select("id").distinct(), "id", "left_semi").select("code", "id")


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """Paths a -> c -> b where c is the same node: composed relation, the node between, the lower credibility."""
    a = first.select("x_id", "x_type", F.col("y_id").alias("via_id"), F.col("y_type").alias("via_type"), F.col("relation").alias("r1"), F.col("credibility").alias("c1"))
    b = second.select(F.col("x_id").alias("via_id"), F.col("x_type").alias("via_type"), "y_id", "y_type", F.col("relation").alias("r2"), F.col("credibility").alias("c2"))
    return a.join(b, ["via_id", "via_type"]).select(
        "x_id", "x_type", "y_id", "y_type", F.concat(F.lit("composed:"), "r1", F.lit("+"), "r2").alias("relation"), F.concat_ws(":", F.lit("via"), "via_type", "via_id").alias("via"), F.least("c1", "c2").alias("credibility")
    )


def hashed_order(seed: int, *cols: str):
    return F.xxhash64(F.lit(seed), *cols)


def drawn_order(seed: int) -> list[Column]:
    """An order of edges by a draw."""
    return [draw(F.lit(str(seed)), "relation", "x_id", "y_id"), F.col("x_id"), F.col("y_id")]


def drop_share(edges: DataFrame, percent: float, seed: int) -> DataFrame:
    """edges less floor(percent of each relation), the first by a drawn order."""
    r = numbered(edges, ["relation"], drawn_order(seed))
    return r.where(F.col("__r") > F.floor(F.col("__n") * percent / 100)).select(*edges.columns)


def drop_relation(edges: DataFrame, relation: str) -> DataFrame:
    return edges.where(~F.col("relation").isin(relation, f"rev_{relation}"))


def random_edges(edges: DataFrame, index: DataFrame, percent: float, seed: int, ends: str = "y") -> DataFrame:
    """floor(percent of each relation) further edges: copies of its first edges by a drawn order, with random nodes of the right
    types at the ends named (x, y or xy). Registry of type sizes: a row a node type."""
    # All of a relation need no order.
    pick = edges
    if percent < 100:
        r = numbered(edges, ["relation"], drawn_order(seed))
        pick = r.where(F.col("__r") <= F.floor(F.col("__n") * percent / 100)).select(*edges.columns)
    index = cut(index.select("node_type", "index", "id"))
    sizes = index.groupBy("node_type").agg((F.max("index") + 1).alias("__m"))
    # Places are drawn first, so that the ends they replace don't travel.
    for e in ends:
        mine = sizes.select(F.col("node_type").alias(f"{e}_type"), F.col("__m").alias(f"__m{e}"))
        pick = pick.join(F.broadcast(mine), f"{e}_type").withColumn(f"__i{e}", F.pmod(draw(F.lit(f"{seed}{e}"), "relation", "x_id", "y_id"), F.col(f"__m{e}")))
    for e in ends:
        to = index.select(F.col("node_type").alias(f"{e}_type"), F.col("index").alias(f"__i{e}"), F.col("id").alias(f"__to{e}"))
        pick = pick.join(to, [f"{e}_type", f"__i{e}"]).withColumn(f"{e}_id", F.col(f"__to{e}"))
    return pick.select(*edges.columns)


def rewired(edges: DataFrame, index: DataFrame, seed: int) -> DataFrame:
    """As many edges of each relation as there are, all with random ends of the right types."""
    return random_edges(edges, index, 100, seed, "xy")


def neighbour_classes(edges: DataFrame) -> DataFrame:
    """(a, class_id, d): sources with equal neighbour sets are one class, named by its least source; d is the size of the set.

    Sets are compared by their size and two sums of 64-bit hashes of their distinct members, so no set is gathered.
    """
    e = edges.select(F.col("x_id").alias("a"), "y_id").where("a is not null and y_id is not null").distinct()
    s = e.groupBy("a").agg(F.count(F.lit(1)).alias("d"), *(F.sum(F.xxhash64(F.lit(k), "y_id").cast("decimal(38,0)")).alias(f"__s{k}") for k in (1, 2)))
    key = ["d", "__s1", "__s2"]
    return s.join(s.groupBy(*key).agg(F.min("a").alias("class_id")), key).select("a", "class_id", "d")


def prefixes(ranked: DataFrame, least: float) -> DataFrame:
    """Of sets in rows (a, y_id, place, d), places by one order of all members, the members of which two sets of cosine
    `least` or more share one: those sets have at least least^2 * d members in common."""
    return ranked.where(F.col("place") <= F.col("d") - F.ceil(F.col("d") * (least * least) - 1e-9) + 1)


def similar_neighbours(edges: DataFrame, least: float, small: int = 24) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs): neighbour_classes, and all pairs of classes (a < b, d_a, d_b, shared, cosine) whose binary neighbour sets have a
    cosine of `least` or more.

    Three joins, by what a pair of sizes asks for. Where one shared member is enough, each meeting at a member is a result.
    Where two or more are, and both sets have `small` members at most, sets meet on two members at once: members are ordered
    by how many classes hold them, rarest first, and two similar sets share a pair among their first d - t + 2 members, t the
    least that they share. Pairs with a larger set meet on one member of their prefixes, pass bounds on their sizes and on what
    can still follow, and are counted from the smaller set. Sets and members travel as numbers, names come back at the end.
    """
    numbers = lambda df, c: cut(df.withColumn(c, F.monotonically_increasing_id()))
    edges = cut(edges.select("x_id", "y_id").where("x_id is not null and y_id is not null").distinct())
    classes = cut(neighbour_classes(edges))
    names = numbers(classes.where("a = class_id").select("a", F.col("d").cast("int").alias("d")), "i")
    e = cut(edges.select(F.col("x_id").alias("a"), "y_id").join(names, "a").select("i", "d", "y_id"))
    often = numbers(e.groupBy("y_id").agg(F.count(F.lit(1)).alias("often")), "y")
    held = cut(e.join(often, "y_id").select("i", "d", "y", "often"))
    # What two sets of sizes d and e must share.
    asks = lambda d, e: F.ceil(F.sqrt(F.col(d) * F.col(e)) * least - 1e-9)
    side = lambda df, i, d, *more: df.select(F.col("i").alias(i), F.col("d").alias(d), *more)

    one = held.where(F.ceil(F.sqrt("d") * least - 1e-9) <= 1).select("y", "i", "d")
    one = side(one, "p", "d_p", "y").join(side(one, "q", "d_q", "y"), "y").where((F.col("p") < F.col("q")) & (asks("d_p", "d_q") <= 1))
    found = [one.groupBy("p", "q", "d_p", "d_q").agg(F.count(F.lit(1)).alias("shared"))]

    sets = held.where((F.col("d") >= 2) & (F.col("d") <= small)).groupBy("i", "d").agg(F.array_sort(F.collect_list(F.struct("often", "y"))).alias("m"))
    sets = cut(sets.select("i", "d", F.col("m.y").alias("m")))
    first = F.slice("m", F.lit(1), F.col("d") - F.greatest(F.lit(2), F.ceil(F.col("d") * (least * least) - 1e-6)).cast("int") + 2)
    twos = F.flatten(F.transform(first, lambda x, n: F.transform(F.slice(first, F.lit(1), n), lambda z: F.xxhash64(z, x))))
    two = sets.select("i", F.explode(twos).alias("h"))
    both = two.withColumnRenamed("i", "p").join(two.withColumnRenamed("i", "q"), "h").where("p < q").select("p", "q").distinct()
    both = both.join(side(sets, "p", "d_p", F.col("m").alias("m_p")), "p").join(side(sets, "q", "d_q", F.col("m").alias("m_q")), "q")
    found.append(both.where(asks("d_p", "d_q") >= 2).select("p", "q", "d_p", "d_q", F.size(F.array_intersect("m_p", "m_q")).cast("long").alias("shared")))

    if not held.where(F.col("d") > small).isEmpty():
        some = held.where(F.col("d") >= (least * least) * small)
        ranked = cut(numbered(some, ["i"], [F.col("often"), F.col("y")]).select("i", "d", "y", F.col("__r").alias("place")))
        head = prefixes(ranked, least)
        many = side(head.where(F.col("d") > small), "p", "d_p", "y", F.col("place").alias("at_p")).join(side(head, "q", "d_q", "y", F.col("place").alias("at_q")), "y")
        apart = ((F.col("d_q") <= small) | (F.col("p") < F.col("q"))) & (F.col("p") != F.col("q"))
        sizes = F.least("d_p", "d_q") >= (least * least) * F.greatest("d_p", "d_q") - 1e-9
        follow = 1 + F.least(F.col("d_p") - F.col("at_p"), F.col("d_q") - F.col("at_q")) >= asks("d_p", "d_q")
        many = many.where(apart & sizes & follow & (asks("d_p", "d_q") >= 2)).select("p", "q", "d_p", "d_q").distinct()
        less = F.col("d_p") <= F.col("d_q")
        many = many.withColumns({"__small": F.when(less, F.col("p")).otherwise(F.col("q")), "__large": F.when(less, F.col("q")).otherwise(F.col("p"))})
        many = many.join(ranked.select(F.col("i").alias("__small"), "y"), "__small").join(ranked.select(F.col("i").alias("__large"), "y"), ["__large", "y"])
        found.append(many.groupBy("p", "q", "d_p", "d_q").agg(F.count(F.lit(1)).alias("shared")))

    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.where(F.col("shared") >= asks("d_p", "d_q")).join(names.select(F.col("i").alias("p"), F.col("a").alias("a_p")), "p").join(names.select(F.col("i").alias("q"), F.col("a").alias("a_q")), "q")
    swap = F.col("a_p") > F.col("a_q")
    d = lambda x, y: F.when(swap, F.col(x)).otherwise(F.col(y)).cast("long")
    pairs = pairs.select(F.least("a_p", "a_q").alias("a"), F.greatest("a_p", "a_q").alias("b"), d("d_q", "d_p").alias("d_a"), d("d_p", "d_q").alias("d_b"), "shared")
    return classes, pairs.withColumn("cosine", F.col("shared") / F.sqrt(F.col("d_a") * F.col("d_b")))


def shared_neighbours(edges: DataFrame, block: int = 1024) -> DataFrame:
    """(a, b, shared, cosine) of all pairs a < b of sources with a target in common: the cosine of binary neighbour sets,
    shared / sqrt(d_a * d_b).

    Each pair is listed, so the work is the sum of squared target degrees. A target's sources are dealt by hash into blocks of
    about `block`, and two blocks meet in a join key of their own, so no hub meets in one task. Sources are counted by their
    places in id order, two places packed in one number.
    """
    e = cut(edges.select(F.col("x_id").alias("a"), "y_id").where("a is not null and y_id is not null").distinct())
    places = cut(numbered(e.groupBy("a").agg(F.count(F.lit(1)).alias("d")), [], [F.col("a")]).select("a", F.col("__r").cast("long").alias("i"), "d"))
    often = e.groupBy("y_id").agg(F.count(F.lit(1)).alias("__often")).where("__often > 1")
    rows = e.join(often, "y_id").join(places.select("a", "i"), "a").select("y_id", "i", F.ceil(F.col("__often") / block).cast("int").alias("__m"))
    rows = rows.withColumn("c", F.pmod(F.xxhash64("i"), F.col("__m")).cast("int"))
    met = rows.select("y_id", "i", "c", F.explode(F.sequence(F.lit(0), F.col("__m") - 1)).alias("__j"))
    met = cut(met.select("y_id", F.least("c", "__j").alias("p"), F.greatest("c", "__j").alias("q"), "i", "c"))
    right = met.select("y_id", "p", "q", F.col("i").alias("k"), F.col("c").alias("e"))
    # Sources of one block meet where the block meets itself.
    j = met.join(right, ["y_id", "p", "q"]).where((F.col("i") < F.col("k")) & ((F.col("c") != F.col("e")) | (F.col("p") == F.col("q"))))
    n = j.groupBy(F.shiftleft("i", 31).bitwiseOR(F.col("k")).alias("pair")).agg(F.count(F.lit(1)).alias("shared"))
    n = n.select(F.shiftright("pair", 31).alias("i"), F.col("pair").bitwiseAND(F.lit((1 << 31) - 1)).alias("k"), "shared")
    n = n.join(places.withColumnRenamed("d", "d_a"), "i").join(places.select(F.col("i").alias("k"), F.col("a").alias("b"), F.col("d").alias("d_b")), "k")
    return n.select("a", "b", "shared", (F.col("shared") / F.sqrt(F.col("d_a") * F.col("d_b"))).alias("cosine"))


def draw(*parts: Column | str) -> Column:
    """A number from 0 to 2^60 that depends on the parts only."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def placed(adjacent: DataFrame, block: int = 4096) -> DataFrame:
    """(relation, at, to) with each neighbour's place in its (relation, at) from 0, and the degree.

    A hub's neighbours are dealt by hash into blocks of about `block`; places are numbered inside a block and follow the sizes
    of the blocks before it, so no node's neighbours meet in one task.
    """
    degree = adjacent.groupBy("relation", "at").agg(F.count(F.lit(1)).alias("degree"))
    rows = adjacent.join(degree, ["relation", "at"]).withColumn("__block", F.pmod(F.xxhash64("to"), F.ceil(F.col("degree") / block)))
    own, key = W.partitionBy("relation", "at", "__block").orderBy("to"), ["relation", "at", "__block"]
    before = W.partitionBy("relation", "at").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__k")).withColumn("__before", F.coalesce(F.sum("__k").over(before), F.lit(0)))
    out = rows.withColumn("__i", F.row_number().over(own)).join(sizes, key)
    return out.select("relation", "at", "to", "degree", (F.col("__before") + F.col("__i") - 1).alias("place"))


def walk_profile(edges: DataFrame, anchors: DataFrame, hops: list[str], walks: int, seed: int, dead_ends: str = "keep") -> DataFrame:
    """(anchor, id, visits, prob, bit) over seeded random walks along typed hops: hop s of a walk takes a neighbour by the
    relation hops[s] (edges x_id -> y_id; `rev_<relation>` goes back, `any` both ways by every relation).

    All nodes after the anchor count. A walk that finds no neighbour ends: with dead_ends `keep` what it visited counts, with
    `drop` only full walks do. prob is the share of all visits of the anchor, bit is 1 for a visited node. The neighbour's
    place is a draw from (seed, anchor, walk, hop) modulo the degree, so results don't depend on partitions.
    """
    if dead_ends not in ("keep", "drop"):
        raise ValueError("dead_ends is keep or drop")
    e = edges.select("relation", F.col("x_id").alias("at"), F.col("y_id").alias("to")).where("at is not null and to is not null")
    back = e.select(F.concat(F.lit("rev_"), "relation").alias("relation"), F.col("to").alias("at"), F.col("at").alias("to"))
    both = e.unionAll(back)
    all_ways = both.unionAll(both.select(F.lit("any"), "at", "to")) if "any" in hops else both
    adjacent = cut(placed(all_ways.where(F.col("relation").isin(*dict.fromkeys(hops))).distinct()))
    degrees = adjacent.where("place = 0").select("relation", "at", "degree")
    now = anchors.select(F.col("id").alias("anchor"), F.col("id").alias("at")).distinct().withColumn("walk", F.explode(F.sequence(F.lit(0), F.lit(walks - 1))))
    seen = None
    for s, relation in enumerate(hops):
        here = lambda df: df.where(F.col("relation") == relation).drop("relation")  # noqa: E731, B023
        place = F.pmod(draw(F.lit(str(seed)), "anchor", F.col("walk").cast("string"), F.lit(str(s))), F.col("degree")).alias("place")
        now = now.join(here(degrees), "at").select("anchor", "walk", "at", place).join(here(adjacent).drop("degree"), ["at", "place"]).select("anchor", "walk", F.col("to").alias("at"))
        now = cut(now)
        seen = now if seen is None else seen.unionAll(now)
    if dead_ends == "drop":
        seen = seen.join(now.select("anchor", "walk").distinct(), ["anchor", "walk"], "left_semi")
    visits = seen.groupBy("anchor", F.col("at").alias("id")).agg(F.count(F.lit(1)).alias("visits"))
    total = visits.groupBy("anchor").agg(F.sum("visits").alias("__all"))
    return visits.join(total, "anchor").select("anchor", "id", "visits", (F.col("visits") / F.col("__all")).alias("prob"), F.lit(1).alias("bit"))


def distmult(pairs: DataFrame, vectors: DataFrame, relation: DataFrame) -> DataFrame:
    """Score sum(h * r * t) and its sigmoid of (x_id, y_id, relation) pairs; relation vectors are a small table."""
    v = lambda e: vectors.select(F.col("id").alias(f"{e}_id"), F.col("vector").alias(f"__{e}"))
    j = pairs.join(v("x"), "x_id").join(v("y"), "y_id").join(F.broadcast(relation.select("relation", F.col("vector").alias("__r"))), "relation")
    s = F.aggregate(F.zip_with(F.zip_with("__x", "__r", lambda a, b: a.cast("double") * b), "__y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return j.select("relation", "x_id", "y_id", s.alias("score")).withColumn("probability", 1 / (1 + F.exp(-F.col("score"))))
