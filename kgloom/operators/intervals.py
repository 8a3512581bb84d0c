"""Range joins of points and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Bins of level L hold 2^L positions.
LEVELS = tuple(range(6, 63, 3))


def contains(points: DataFrame, intervals: DataFrame, chrom: str, position: str, start: str, end: str, padding: int = 0, wide: int = 18, copies: int = 16) -> DataFrame:
    """Pairs of a point and an interval (both ends inclusive, widened by padding) on the same sequence.

    Bins are nested: an interval stands at the first level whose bins are as long as it is, so it touches two bins at most,
    whatever its length; a point probes one bin a level, of the levels that intervals are at (a query over the intervals'
    bounds tells them, 19 numbers at most, when the plan is made). The join is an equi-join on (sequence, level, bin). A bin of
    more than 2^wide positions can hold a large share of the points: there intervals stand in `copies` copies and each point
    goes to one of them, so that no key gathers a sequence's points in one task.

    Nulls and intervals that end before they start give no pair.
    """
    lo, hi = F.col(start).cast("long") - padding, F.col(end).cast("long") + padding
    i = intervals.where(F.col(end) >= F.col(start)).withColumn("__level", F.coalesce(*(F.when(hi - lo < (1 << n), n) for n in LEVELS)))
    bin_ = lambda c: F.expr(f"shiftright({c}, __level)")
    i = i.withColumns({"__lo": lo, "__hi": hi})
    levels = sorted(r[0] for r in i.select("__level").distinct().collect())
    salts = F.when(F.col("__level") > wide, copies).otherwise(1)
    i = i.withColumn("__bin", F.explode(F.array_distinct(F.array(bin_("__lo"), bin_("__hi"))))).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    p = points.withColumn("__at", F.col(position).cast("long")).withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    p = p.withColumns({"__bin": bin_("__at"), "__salt": F.pmod(F.xxhash64(*points.columns), salts.cast("long")).cast("int")})
    return p.join(i, [chrom, "__level", "__bin", "__salt"]).where("__at between __lo and __hi").drop("__level", "__bin", "__salt", "__lo", "__hi", "__at")


def summed(points: DataFrame, intervals: DataFrame, chrom: str, position: str, start: str, end: str, by: list[str], sums: dict[str, Column], padding: int = 0) -> DataFrame:
    """The pairs of `contains`, grouped by columns of the intervals and added up, without building them: by, each sum over the
    points of the pairs (whole numbers; null where all values are), and __pairs, how many there are.

    What lies in an interval is what lies up to its end less what lies before its start, so work grows with points plus
    intervals, however many of them meet. Positions are cut into bins of one width, 2^16 at most; bins that hold more than a
    thousandth of all rows are cut again, down to single positions (two queries or more when the plan is made, a thousand bins
    at most reach the driver a round). Rows are summed inside their bin and add what stands in the bins before it.
    """
    lo, hi = F.col(start).cast("long") - padding, F.col(end).cast("long") + padding
    bounds = F.array(*(F.struct(F.lit(kind).alias("__kind"), at.alias("__at")) for kind, at in ((0, lo), (2, hi))))
    i = intervals.where((F.col(end) >= F.col(start)) & (hi >= lo)).select(F.col(chrom).alias("__chrom"), F.struct(*by).alias("__by"), F.inline(bounds))
    p = points.select(F.col(chrom).alias("__chrom"), F.col(position).cast("long").alias("__at"), F.lit(1).alias("__kind"), *(c.alias(f"__v{k}") for k, c in sums.items()))
    # Rows of one position: starts, points, ends.
    rows = p.unionByName(i, allowMissingColumns=True).where("__chrom is not null and __at is not null")
    least, most, n = rows.agg(F.min("__at"), F.max("__at"), F.count(F.lit(1))).first()
    shift = max(0, ((most or 0) - (least or 0)).bit_length() - 16)
    bin_ = lambda: F.shiftleft(F.shiftright("__at", shift), shift)
    rows, key = rows.withColumn("__bin", bin_()), ["__chrom", "__bin"]
    while shift:
        large = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max(1024, n // 1000)).select(*key)
        found = large.collect()
        if not found:
            break
        shift = max(0, shift - 10)
        large = rows.sparkSession.createDataFrame(found, large.schema).withColumn("__large", F.lit(True))
        rows = rows.join(F.broadcast(large), key, "left").withColumn("__bin", F.when(F.col("__large"), bin_()).otherwise(F.col("__bin"))).drop("__large")
    # A value is two halves, so that running sums of any values stay in 64 bits.
    halves = lambda c: {"h": F.shiftright(c, 32), "l": c.bitwiseAND(F.lit((1 << 32) - 1)), "k": F.when(c.isNotNull(), 1)}
    values = {"__pairs": F.when(F.col("__kind") == 1, 1)} | {f"__{x}{k}": c for k in sums for x, c in halves(F.col(f"__v{k}").cast("long")).items()}
    total = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0))
    upto = W.partitionBy(*key).orderBy("__at", "__kind").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("__chrom").orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy(*key).agg(*(F.sum(c).alias(f"__t{k}") for k, c in values.items())).select(*key, *(total(f"__t{k}", before).alias(f"__b{k}") for k in values))
    ends = rows.select(*key, "__by", "__kind", *(total(c, upto).alias(f"__r{k}") for k, c in values.items())).where("__kind <> 1").join(base, key)
    side = F.when(F.col("__kind") == 2, 1).otherwise(-1)
    out = ends.groupBy("__by").agg(*(F.sum((F.col(f"__r{k}") + F.col(f"__b{k}")) * side).alias(k) for k in values)).where("__pairs > 0")
    whole = lambda k: (F.col(f"__h{k}").cast("decimal(20,0)") * (1 << 32) + F.col(f"__l{k}")).cast("long")
    return out.select("__by.*", *(F.when(F.col(f"__k{k}") > 0, whole(k)).alias(k) for k in sums), "__pairs")


def containment(pairs: DataFrame, intervals: DataFrame) -> DataFrame:
    """Whether each point lies in an interval of the entity it is paired with, and the interval that proves it.

    pairs (id, entity, chrom, pos), intervals (entity, chrom, start, end, strand); a leading `chr` doesn't matter. One row a
    distinct pair: contained, reason (missing_variant_coordinate, missing_gene_interval, outside_gene_interval, contained, the
    first that holds) and the proof, the least of the containing intervals by start, end and strand. An equi-join on the
    entity, summed up a pair; an entity's intervals are never gathered.
    """
    plain = lambda c: F.regexp_replace(c, "^chr", "")
    p = pairs.select("id", "entity", plain("chrom").alias("chrom"), F.col("pos").cast("long").alias("pos")).distinct()
    i = intervals.select(F.col("entity"), plain("chrom").alias("__chrom"), F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "strand").alias("__i"))
    inside = (F.col("chrom") == F.col("__chrom")) & F.col("pos").between(F.col("__i.start"), F.col("__i.end"))
    j = p.join(i, "entity", "left").groupBy("id", "entity", "chrom", "pos").agg(F.min(F.when(inside, F.col("__i"))).alias("proof"), F.count("__i").alias("__n"))
    reason = F.when(F.col("chrom").isNull() | F.col("pos").isNull(), "missing_variant_coordinate").when(F.col("__n") == 0, "missing_gene_interval").when(F.col("proof").isNull(), "outside_gene_interval").otherwise("contained")
    return j.select("id", "entity", "chrom", "pos", F.col("proof").isNotNull().alias("contained"), reason.alias("reason"), "proof")


def interval_faults(start: Column, end: Column, strand: Column) -> Column:
    """The first fault of an interval row, or null."""
    return F.when(start.isNull() | end.isNull(), "missing_bound").when(start < 1, "start_below_one").when(end < start, "end_before_start").when(~strand.isin("+", "-", "."), "bad_strand")
