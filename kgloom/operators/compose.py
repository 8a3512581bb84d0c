"""Rule-driven composition of relations into inferred edges with provenance.

A template is data: premise relations in order, which ends join, gates, and the ends of the result. Premises are joined by
equi-joins, gates give the first reason against a path, accepted paths become candidates with support, context and a
derivation hash, and rejected ones are counted by reason. Inferred edges never go into the edge table.

Counting needs no paths. `counted` and `path_count` collapse each premise to the variables that others share and the fields
that gates read, with a weight, and push products of weights along the chain, so a hub's edges are as few rows as it has kinds
of edges. Path counts of parts of a template also give the join order, and refuse templates that would join too many paths.
Closing a triangle starts from the closing edges, each from its rarer end, so open wedges are never built.
"""

from __future__ import annotations

import functools
import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .cuts import cut
from .graph import numbered

# Fields that describe an assertion's context, those that name a mapping, and words with a sign.
CONTEXT = ["assembly", "organism", "tissue", "biosample", "cell_type", "cell_line", "disease_context", "phenotype_context", "population", "dose", "time", "readout"]
MAPPING = ["assembly", "organism", "transcript_id", "isoform_id", "protein_isoform"]
POSITIVE = ["activate", "activation", "agonist", "gain_of_function", "increase", "risk", "positive"]
NEGATIVE = ["inhibit", "inhibition", "inhibitor", "antagonist", "loss_of_function", "decrease", "protective", "negative"]
PATHOGENIC = ["pathogenic", "likely_pathogenic", "pathogenic_likely_pathogenic", "reviewed_causal", "causal_reviewed"]
REFUSED = ["benign", "likely_benign", "associative", "association", "generic"]
CAUSAL = ["causal", "causal_mechanistic", "genetic_causal", "mechanistic", "pathogenic_causal", "validated_causal"]


def values(c: Column) -> Column:
    """Distinct lower-case values of a comma-joined field; unknown and blank ones are no values."""
    kept = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: ~x.isin("", "unknown"))
    return F.array_sort(F.array_distinct(kept))


def resolved(c: Column) -> Column:
    v = values(c)
    return F.when(F.size(v) == 0, "unknown").when(F.size(v) == 1, "known").otherwise("conflicting")


def agree(*cols: Column) -> Column:
    """No column conflicts and the known values are equal."""
    every = F.array_distinct(F.flatten(F.array(*(values(c) for c in cols))))
    return F.size(every) <= 1


def shared(*cols: Column) -> Column:
    """All columns have the same single known value."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & (F.size(values(c)) == 1)
    return ok & agree(*cols)


def independent(*cols: Column) -> Column:
    """All source sets are non-empty and have nothing in common."""
    sets = [values(c) for c in cols]
    common, full = sets[0], F.size(sets[0]) > 0
    for s in sets[1:]:
        common, full = F.array_intersect(common, s), full & (F.size(s) > 0)
    return full & (F.size(common) == 0)


def sign(c: Column) -> Column:
    """+1, -1, 0 for conflicting words, null for none that is known."""
    s = F.array_distinct(F.filter(F.transform(values(c), lambda x: F.when(x.isin(POSITIVE), 1).when(x.isin(NEGATIVE), -1)), lambda x: x.isNotNull()))
    return F.when(F.size(s) == 1, s[0]).when(F.size(s) > 1, 0)


def pathogenicity_reason(c: Column) -> Column:
    """Null when only allowed values are there; else why not."""
    v = values(c)
    good, bad = F.array(*map(F.lit, PATHOGENIC)), F.array(*map(F.lit, REFUSED))
    return (
        F.when(F.size(v) == 0, "missing_pathogenicity").when(F.arrays_overlap(v, good) & (F.size(F.array_except(v, good)) > 0), "conflicting_pathogenicity")
        .when(F.arrays_overlap(v, good), F.lit(None).cast("string")).when(F.arrays_overlap(v, bad), F.concat(F.array_intersect(v, bad)[0], F.lit("_only"))).otherwise("unsupported_pathogenicity")
    )


@dataclass(frozen=True)
class Template:
    """name; premises (relation, from variable, to variable); out: the variables of the result's ends; gates: functions of
    cell(i, field) that give a reason against a path or null, asked first; context fields that must agree; mapping fields that
    must agree, asked after the context; independent: premise sources must not overlap; triangle: a relation that must already
    join the ends; signed: +1 or -1 product wanted."""

    name: str
    premises: tuple[tuple[str, str, str], ...]
    out: tuple[str, str]
    relation: str
    context: tuple[str, ...] = ()
    independent: bool = False
    triangle: str | None = None
    signed: int | None = None
    gates: tuple = ()
    mapping: tuple[str, ...] = ()


def _compared(t: Template) -> list[str]:
    return list(dict.fromkeys((*t.context, *t.mapping, *(["source"] if t.independent else []))))


def _taken(edges: DataFrame, t: Template) -> DataFrame:
    """edges with the values that the template compares taken apart once an edge, before paths multiply: f_<field> holds them,
    one_<field> the only one, if there is one, and sign the direction's sign."""
    out = edges.withColumns({f"f_{f}": values(F.col(f)) for f in _compared(t)} | ({"sign": sign(F.col("direction"))} if t.signed is not None else {}))
    one = {f"one_{f}": F.when(F.size(f"f_{f}") == 1, F.col(f"f_{f}")[0]) for f in _compared(t)}
    return out.withColumns(one | {"key": F.concat_ws("|", "relation", "x_id", "y_id")})


def _variables(t: Template, i: int) -> tuple[str, ...]:
    return tuple(dict.fromkeys(t.premises[i][1:]))


def _premise(taken: DataFrame, t: Template, i: int, fields: list[str]) -> DataFrame:
    """Premise i: its variables v_*, and a struct p<i> of the fields."""
    relation, a, b = t.premises[i]
    return taken.where(F.col("relation") == relation).where(F.lit(True) if a != b else F.col("x_id") == F.col("y_id")).select(*({f"v_{a}": F.col("x_id").alias(f"v_{a}"), f"v_{b}": F.col("y_id").alias(f"v_{b}")}.values()), F.struct(*fields).alias(f"p{i}"))


def paths(edges: DataFrame, t: Template, order: list[int] | None = None) -> DataFrame:
    """All joins of the premises: variables v_*, and each premise's row as p0, p1, ..., joined in the order given."""
    taken = _taken(edges, t)
    fields = [c for c in taken.columns if c not in ("x_id", "y_id")]
    out, known = None, set()
    for i in order or range(len(t.premises)):
        p = _premise(taken, t, i, fields)
        out = p if out is None else out.join(p, [f"v_{v}" for v in _variables(t, i) if v in known])
        known |= set(_variables(t, i))
    return out


def _cell(i: int, field_: str) -> Column:
    return F.col(f"p{i}.{field_}")


def _reason(t: Template) -> Column:
    """The first reason against a path of premise structs p0, p1, ...; null for none."""
    n = len(t.premises)
    each = lambda f: [_cell(i, f) for i in range(n)]
    every = lambda conditions: functools.reduce(lambda a, b: a & b, conditions)
    # No field holds two values, and those that hold one hold the same; nulls don't count in least and greatest.
    single = lambda f: every(F.size(c) <= 1 for c in each(f"f_{f}"))
    same = lambda f: F.coalesce(F.least(*each(f"one_{f}")) == F.greatest(*each(f"one_{f}")), F.lit(True))
    full = lambda f: every(c.isNotNull() for c in each(f"one_{f}"))
    reasons = [gate(_cell) for gate in t.gates]
    if t.signed is not None:
        product = functools.reduce(lambda a, b: a * b, each("sign"))
        reasons.append(F.when(product == 0, "conflicting_sign").when(product.isNull(), "missing_sign").when(product != t.signed, "other_sign"))
    if t.context:
        reasons.append(F.when(~every(single(f) & same(f) for f in t.context), "context_mismatch"))
        if t.signed is not None:
            reasons.append(F.when(~functools.reduce(lambda a, b: a | b, (full(f) & same(f) for f in t.context)), "missing_shared_context"))
    if t.mapping:
        reasons.append(F.when(~every(single(f) & same(f) for f in t.mapping), "isoform_or_assembly_mismatch"))
    if t.independent:
        common = functools.reduce(F.array_intersect, each("f_source"))
        apart = F.when(full("source"), ~same("source")).otherwise(every(F.size(c) > 0 for c in each("f_source")) & (F.size(common) == 0))
        reasons.append(F.when(~apart, "source_not_independent"))
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def _read_fields(t: Template) -> list[list[str]]:
    """Of each premise, the fields that the template's gates read."""
    seen = [{f"{k}_{f}" for f in _compared(t) for k in ("f", "one")} | ({"sign"} if t.signed is not None else set()) for _ in t.premises]

    def note(i: int, field_: str) -> Column:
        seen[i].add(field_)
        return _cell(i, field_)

    for gate in t.gates:
        gate(note)
    return [sorted(s) for s in seen]


def _ends(t: Template, p: DataFrame) -> DataFrame:
    return p.withColumns({"x_id": F.col(f"v_{t.out[0]}"), "y_id": F.col(f"v_{t.out[1]}")})


def _closing(edges: DataFrame, t: Template) -> DataFrame:
    return edges.where(F.col("relation") == t.triangle).select("x_id", "y_id").distinct()


def _told(t: Template, p: DataFrame) -> DataFrame:
    n = len(t.premises)
    keys = [_cell(i, "key") for i in range(n)]
    return p.select("x_id", "y_id", F.lit(t.relation).alias("relation"), F.lit(t.name).alias("template"), "reason", F.array_join(F.array_sort(F.array(*keys)), ";").alias("support"), F.array_join(F.array(*keys), ">").alias("path"))


def derive(edges: DataFrame, t: Template, order: list[int] | None = None) -> DataFrame:
    """Every path with its ends and `reason`, null for accepted ones; for single rejected paths. `counted` counts without
    building them, and `closed` builds a triangle's closed paths only."""
    p = _ends(t, paths(edges, t, order)).withColumn("reason", _reason(t))
    if t.triangle:
        p = p.join(_closing(edges, t).withColumn("__closed", F.lit(True)), ["x_id", "y_id"], "left").withColumn("reason", F.coalesce("reason", F.when(F.col("__closed").isNull(), "no_closing_edge"))).drop("__closed")
    return _told(t, p)


def closed(edges: DataFrame, t: Template) -> DataFrame:
    """A triangle template's closed paths with their reason, as derive gives them.

    Two premises share a variable; the closing edge joins the other two. Each closing edge is extended from the end that has
    fewer premise edges, and the pair so found is looked up in the other premise: the rows made are at most the sum of the
    smaller degrees of the closing edges. The relations concerned are read six times, so they are written once, by a job when
    the plan is made.
    """
    edges = cut(edges.where(F.col("relation").isin(t.triangle, *(p[0] for p in t.premises))))
    (one, two), taken = [_variables(t, i) for i in (0, 1)], _taken(edges, t)
    (shared_,) = set(one) & set(two)
    if len(t.premises) != 2 or {*t.out} != {*one, *two} - {shared_}:
        raise ValueError("a triangle has two premises and a closing relation between their other ends")
    fields = [c for c in taken.columns if c not in ("x_id", "y_id")]
    sides = [_premise(taken, t, i, fields) for i in (0, 1)]
    far = [f"v_{next(v for v in x if v != shared_)}" for x in (one, two)]
    pairs = _closing(edges, t).select(F.col("x_id").alias(f"v_{t.out[0]}"), F.col("y_id").alias(f"v_{t.out[1]}"))
    for i in (0, 1):
        pairs = pairs.join(sides[i].groupBy(far[i]).agg(F.count(F.lit(1)).alias(f"__d{i}")), far[i])
    found = None
    for i, rarer in ((0, F.col("__d0") <= F.col("__d1")), (1, F.col("__d0") > F.col("__d1"))):
        part = pairs.where(rarer).drop("__d0", "__d1").join(sides[i], far[i]).join(sides[1 - i], [f"v_{shared_}", far[1 - i]]).select(f"v_{shared_}", *far, "p0", "p1")
        found = part if found is None else found.unionByName(part)
    return _told(t, _ends(t, found).withColumn("reason", _reason(t)))


def _collapsed(edges: DataFrame, t: Template, which: list[int], fields: list[list[str]]) -> DataFrame:
    """Premises `which` joined, collapsed to kinds of paths: the structs of the fields (p<i>) and `weight`, how many there are.

    A premise is first counted by the variables that it shares and its fields; after each join, variables that nothing further
    needs are dropped and equal rows added up.
    """
    taken = _taken(edges, t)
    exact = lambda c: F.sum(c).cast("decimal(38,0)").alias("weight")
    out, known = None, set()
    for at, i in enumerate(which):
        mine = set(_variables(t, i))
        later = {v for j in which[at + 1 :] for v in _variables(t, j)}
        keep = [f"v_{v}" for v in _variables(t, i) if v in later | known]
        has = [f"p{i}"] if fields[i] else []
        p = _premise(taken, t, i, fields[i] or ["key"]).groupBy(*keep, *has).agg(exact(F.lit(1).cast("decimal(20,0)")))
        if out is None:
            out = p
        else:
            common = [f"v_{v}" for v in _variables(t, i) if v in known]
            out = out.join(p.withColumnRenamed("weight", "__w"), common)
            rest = [c for c in out.columns if c not in ("weight", "__w") and (not c.startswith("v_") or c[2:] in later)]
            out = out.groupBy(*rest).agg(exact((F.col("weight") * F.col("__w")).cast("decimal(38,0)")))
        known |= mine
    return out


def path_count(edges: DataFrame, t: Template, which: list[int] | None = None) -> int:
    """How many paths the premises (of `which`) join to, before gates: products of degrees pushed along the chain."""
    which = which or list(range(len(t.premises)))
    return int(_collapsed(edges, t, which, [[] for _ in t.premises]).agg(F.sum("weight")).first()[0] or 0)


def join_order(edges: DataFrame, t: Template) -> list[int]:
    """The order of the premises whose intermediate results are smallest, by exact counts of each connected part."""
    n, counts = len(t.premises), {}
    if n < 3:
        return list(range(n))

    def cost(order: tuple[int, ...]) -> int | None:
        total, known = 0, set(_variables(t, order[0]))
        for k in range(1, n):
            if not known & set(_variables(t, order[k])):
                return None
            known |= set(_variables(t, order[k]))
            part = tuple(sorted(order[: k + 1]))
            if k < n - 1 and part not in counts:
                counts[part] = path_count(edges, t, list(order[: k + 1]))
            total += counts.get(part, 0)
        return total

    orders = [(c, o) for o in itertools.permutations(range(n)) if o[0] < o[1] and (c := cost(o)) is not None]
    return list(min(orders)[1])


def bounded(edges: DataFrame, t: Template, most: int) -> DataFrame:
    """derive, in the best join order, or an error that names the number of paths when it is above `most`; nothing is joined then."""
    found = path_count(edges, t)
    if found > most:
        raise ValueError(f"template {t.name} joins {found} paths, more than {most}")
    return derive(edges, t, join_order(edges, t))


def counted(edges: DataFrame, t: Template, max_paths: int | None = None) -> DataFrame:
    """Paths by reason (template, reason, paths), accepted ones as `accepted`, without building open paths.

    Beyond max_paths, accepted paths count as `max_paths_bound`. Of a triangle, only closed paths are built; the open ones are
    those that no gate refuses, less the closed ones.
    """
    rows = _collapsed(edges, t, list(range(len(t.premises))), _read_fields(t))
    rows = rows.groupBy(F.coalesce(_reason(t), F.lit("accepted")).alias("reason")).agg(F.sum("weight").alias("paths"))
    if t.triangle:
        ok = closed(edges, t).where("reason is null").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("paths"))
        ok = ok.select(F.explode(F.array(F.struct(F.lit("accepted").alias("reason"), "paths"), F.struct(F.lit("no_closing_edge").alias("reason"), (-F.col("paths")).alias("paths")))).alias("r")).select("r.*")
        open_ = F.when(F.col("reason") == "accepted", "no_closing_edge").otherwise(F.col("reason"))
        rows = rows.withColumn("reason", open_).unionByName(ok).groupBy("reason").agg(F.sum("paths").alias("paths"))
    if max_paths is not None:
        over = F.greatest(F.lit(0), F.col("paths") - max_paths)
        split = F.array(F.struct(F.lit("accepted").alias("reason"), (F.col("paths") - over).alias("paths")), F.struct(F.lit("max_paths_bound").alias("reason"), over.alias("paths")))
        rows = rows.where("reason <> 'accepted'").unionByName(rows.where("reason = 'accepted'").select(F.explode(split).alias("r")).select("r.*"))
    return rows.where("paths > 0").select(F.lit(t.name).alias("template"), "reason", F.col("paths").cast("long").alias("paths"))


def accepted(edges: DataFrame, t: Template, max_paths: int | None = None) -> DataFrame:
    """The accepted paths; beyond max_paths, the first by ends and path, numbered over range partitions."""
    found = (closed(edges, t) if t.triangle else derive(edges, t, join_order(edges, t))).where("reason is null")
    if max_paths is None:
        return found
    kept = numbered(found, [], [F.col("x_id"), F.col("y_id"), F.col("path")])
    return kept.where(F.col("__r") <= max_paths).select(*found.columns)


def pathogenic(i: int):
    """Gate: the pathogenicity that premise i states is allowed."""
    return lambda cell: pathogenicity_reason(cell(i, "pathogenicity"))


def names(i: int, j: int):
    """Gate: premise i names, as its only isoform, what premise j joins."""
    return lambda cell: F.when(~F.coalesce((F.size(values(cell(i, "protein_isoform"))) == 1) & (values(cell(i, "protein_isoform"))[0] == F.lower(F.substring_index(cell(j, "key"), "|", -1))), F.lit(False)), "isoform_not_named")


def states(i: int, field_: str, wanted: str, reason: str):
    """Gate: premise i has the one value `wanted` in a field."""
    return lambda cell: F.when(~F.coalesce((F.size(values(cell(i, field_))) == 1) & (values(cell(i, field_))[0] == wanted), F.lit(False)), reason)


def member_views(members: DataFrame, targets: DataFrame, most: int = 500) -> DataFrame:
    """(g, m, y): a row for each member m of a group of at most `most` members and each of its targets y."""
    size = members.groupBy("x_id").agg(F.count_distinct("y_id").alias("n_members")).where(F.col("n_members") <= most)
    small = members.join(size, "x_id").select(F.col("x_id").alias("g"), F.col("y_id").alias("m"), "n_members").distinct()
    return small.join(targets.select(F.col("x_id").alias("m"), F.col("y_id").alias("y")).distinct(), "m").select("g", "m", "y", "n_members")


def candidates(found: DataFrame) -> DataFrame:
    """One row per inferred edge of the paths without a reason: how many derivations, the hash of the one with the least
    support, and a digest of all, two sums of 64-bit hashes, which the order of paths doesn't change."""
    sums = [F.sum(F.xxhash64(F.lit(k), "support").cast("decimal(38,0)")).cast("string") for k in (1, 2)]
    g = found.where("reason is null").groupBy("template", "relation", "x_id", "y_id").agg(F.min("support").alias("least_support"), F.count(F.lit(1)).alias("derivations"), F.concat_ws(":", *sums).alias("digest"))
    return g.withColumn("derivation_hash", F.sha2(F.concat_ws("\t", "template", "x_id", "y_id", "least_support"), 256)).drop("least_support")


def gathered(edges: DataFrame, t: Template) -> DataFrame:
    """The accepted paths of a template without a triangle, dealt by their ends: only the variables travel, supports are told
    where they arrive, so that `candidates` sums them up without another shuffle."""
    held = list(dict.fromkeys(v for i in range(len(t.premises)) for v in _variables(t, i)))
    p = paths(edges, t, join_order(edges, t)).where(_reason(t).isNull()).select(*(f"v_{v}" for v in held))
    p = p.repartition(*dict.fromkeys(f"v_{v}" for v in t.out))
    keys = [F.concat_ws("|", F.lit(r), f"v_{a}", f"v_{b}") for r, a, b in t.premises]
    return _ends(t, p).select("x_id", "y_id", F.lit(t.relation).alias("relation"), F.lit(t.name).alias("template"), F.lit(None).cast("string").alias("reason"), F.array_join(F.array_sort(F.array(*keys)), ";").alias("support"))


def ledger(derived: DataFrame) -> DataFrame:
    """Paths of derive by reason; accepted ones count as `accepted`. `counted` gives the same without paths."""
    return derived.groupBy("template", F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("paths"))


def ledger_samples(derived: DataFrame, n: int) -> DataFrame:
    """The first n rejected paths of each reason."""
    w = W.partitionBy("template", "reason").orderBy("x_id", "y_id", "path")
    return derived.where("reason is not null").withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)


def samples(edges: DataFrame, t: Template, n: int, first: int = 64) -> DataFrame:
    """ledger_samples of derive, from the first sources only: counts by reason, taken without paths, tell how many samples there
    must be, and paths are built from the `first` sources in order of their ids, then from 16 times as many, until all are
    there. Jobs run when the plan is made."""
    # A row a reason.
    wanted = {r["reason"]: min(n, r["paths"]) for r in counted(edges, t).collect() if r["reason"] != "accepted"}
    at = next(p for p in t.premises if t.out[0] in p[1:])
    ids = edges.where(F.col("relation") == at[0]).select(F.col("x_id" if at[1] == t.out[0] else "y_id").alias("id")).where("id is not null").distinct().orderBy("id")
    while True:
        # The last of the first ids: one row.
        last = ids.limit(first).agg(F.max("id"), F.count(F.lit(1))).first()
        some = derive(edges, t)
        found = cut(ledger_samples(some.where(F.col("x_id") <= F.lit(last[0])) if last[1] == first else some, n))
        have = {r["reason"]: r["count"] for r in found.groupBy("reason").count().collect()}
        if last[1] < first or all(have.get(k, 0) >= v for k, v in wanted.items()):
            return found
        first *= 16


def overlap(found: DataFrame, observed: DataFrame) -> DataFrame:
    """found with whether its ends are already joined by an observed edge."""
    seen = observed.select("x_id", "y_id").distinct().withColumn("__o", F.lit(True))
    return found.join(seen, ["x_id", "y_id"], "left").withColumn("observed_overlap", F.col("__o").isNotNull()).drop("__o")


def disjoint_pair(sets: Column) -> Column:
    """Whether some two of the sets (array<array<string>>) have nothing in common; empty sets don't count.

    Sets are bit masks over their union, in words of 63 bits, so a comparison is an AND a word. A value that all sets hold
    settles most groups without a comparison.
    """
    kept = F.filter(sets, lambda x: F.size(x) > 0)
    union = F.array_sort(F.array_distinct(F.flatten(kept)))
    place = lambda every, v: F.array_position(every, v) - 1
    word = lambda every, x, w: F.aggregate(
        F.filter(x, lambda v: F.floor(place(every, v) / 63) == w), F.lit(0).cast("long"), lambda acc, v: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (place(every, v) % 63).cast("int")))
    )
    masks = lambda every: F.transform(kept, lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / 63).cast("int")), lambda w: word(every, x, w)))
    apart = lambda a, b: F.forall(F.zip_with(a, b, lambda m, n: m.bitwiseAND(n)), lambda m: m == 0)
    # A one-element transform binds the masks, so that they are computed once a group.
    pairs = F.transform(F.array(masks(union)), lambda ms: F.exists(ms, lambda a: F.exists(ms, lambda b: apart(a, b))))[0]
    common = F.aggregate(kept, kept[0], F.array_intersect)
    return F.when(F.size(kept) < 2, F.lit(False)).when(F.size(common) > 0, F.lit(False)).otherwise(pairs)


def group_consensus(members: DataFrame, targets: DataFrame, most: int = 500) -> DataFrame:
    """Targets y that the members of a group g support together: one row for every (g, y) that a path g -> m -> y joins.

    members (x_id: g, y_id: m, source), targets (x_id: m, y_id: y, source, and native_support if there is such a field).
    A path is independent when the sources of its two edges are known and have nothing in common; a member's sources are
    those of its target edges on independent paths. reason, null when the group is accepted: `pathway_fanout` for groups of
    more than `most` membership rows; else, unless a path states native support, `insufficient_independent_members` for fewer
    than two members with an independent path, and `source_commonality_or_circularity` when no two members have disjoint
    sources. members counts those of the accepted paths (all paths with native support, else the independent ones), support
    lists the edges of these.

    Groups beyond `most` are never joined path by path: their targets are told once each. In the others a group and target
    has `most` members at most; members with equal sources are one class, and classes are compared as bit masks.
    """
    key = lambda relation: F.concat_ws("|", F.lit(relation) if isinstance(relation, str) else relation, "x_id", "y_id")
    size = members.groupBy(F.col("x_id").alias("g")).agg(F.count(F.lit(1)).alias("group_size"))
    native = values(F.col("native_support")) if "native_support" in targets.columns else F.array().cast("array<string>")
    m = members.select(F.col("x_id").alias("g"), F.col("y_id").alias("m"), values(F.col("source")).alias("s1"), key("contains").alias("k1")).join(size, "g")
    t = targets.select(F.col("x_id").alias("m"), F.col("y_id").alias("y"), values(F.col("source")).alias("s2"), key("supports").alias("k2"), F.arrays_overlap(native, F.array(F.lit("true"), F.lit("1"), F.lit("yes"))).alias("native"))
    none = lambda kind: F.lit(None).cast(kind)
    large = m.where(F.col("group_size") > most).select("g", "m", "group_size").distinct().join(t.select("m", "y").distinct(), "m").select("g", "y", "group_size").distinct()
    large = large.select("g", "y", "group_size", F.lit("pathway_fanout").alias("reason"), none("boolean").alias("native"), none("long").alias("members"), none("string").alias("support"))
    paths = m.where(F.col("group_size") <= most).join(t, "m")
    paths = paths.withColumn("apart", (F.size("s1") > 0) & (F.size("s2") > 0) & ~F.arrays_overlap("s1", "s2"))
    keys = F.array("k1", "k2")
    each = paths.groupBy("g", "y", "group_size", "m").agg(
        F.max("native").alias("native"), F.max("apart").alias("apart"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("apart"), F.col("s2")))))).alias("sources"),
        F.flatten(F.collect_set(keys)).alias("all_keys"), F.flatten(F.collect_set(F.when(F.col("apart"), keys))).alias("apart_keys"),
    )
    one = each.groupBy("g", "y", "group_size").agg(
        F.max("native").alias("native"), F.count(F.lit(1)).alias("every"), F.count(F.when(F.col("apart"), 1)).alias("some"), F.collect_set(F.when(F.col("apart"), F.col("sources"))).alias("classes"),
        F.flatten(F.collect_list("all_keys")).alias("all_keys"), F.flatten(F.collect_list("apart_keys")).alias("apart_keys"),
    )
    one = one.withColumn("reason", F.when(F.col("native"), none("string")).when(F.col("some") < 2, "insufficient_independent_members").when(~disjoint_pair(F.col("classes")), "source_commonality_or_circularity"))
    listed = F.array_join(F.array_sort(F.array_distinct(F.when(F.col("native"), F.col("all_keys")).otherwise(F.col("apart_keys")))), ";")
    accepted = F.col("reason").isNull()
    one = one.select("g", "y", "group_size", "reason", "native", F.when(accepted, F.when(F.col("native"), F.col("every")).otherwise(F.col("some"))).alias("members"), F.when(accepted, listed).alias("support"))
    return one.unionByName(large)
