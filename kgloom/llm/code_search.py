"""Exact top-k search (operator 8): incremental multi-index hashing of binary codes.

A vector's code has one bit per dimension, set where the value is positive. Codes are cut into segments of 16 bits. Two codes
at distance d have a segment at distance d // segments or less, so after all segments were searched to radius s every code
within segments * (s + 1) - 1 has been seen. The search looks at codes whose segments are 0, 1, 2, ... bits from the query's
and stops, query by query, as soon as the kth verified distance is covered by that bound. The result is exact.

At scale: equal codes are collapsed first and keep the k smallest ids, all that any query can need. The index is a table of
(segment, value, code); a round joins it with the queries that are still open, each segment value changed in s bits. A code
that a query meets over several segments counts where it is nearest, in the first such segment, so no pair comes twice and
no state but the k best of a query is kept between rounds. DataFrame functions only.

Defined results: null and empty vectors, and vectors of null ids, are neither found nor ask; null elements count as not
positive; shorter vectors are padded with zeros; ties go to the smaller id; repeated ids count once per distinct code; with
fewer than k other vectors all are returned; a query isn't its own neighbour; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .storage import materialize

SEGMENT = 16


def _segments(vector: Column, dims: int) -> list[Column]:
    """The sign bits of a vector, cut into numbers of SEGMENT bits; missing elements are no bits."""
    bits = F.rpad(F.array_join(F.transform(vector, lambda x: F.when(x > 0, "1").otherwise("0")), ""), -(-dims // SEGMENT) * SEGMENT, "0")
    return [F.conv(F.substring(bits, at + 1, SEGMENT), 2, 10).cast("long").alias(f"c{at // SEGMENT}") for at in range(0, dims, SEGMENT)]


def _probes(found: DataFrame, codes: list[str], radius: int) -> DataFrame:
    """found with a row for each segment j and each value that differs from the code's in exactly `radius` bits."""
    every = F.explode(F.array(*(F.struct(F.lit(j).alias("j"), F.col(c).alias("value")) for j, c in enumerate(codes)))).alias("at")
    out = found.select("*", every).select("*", "at.j", "at.value").drop("at")
    if not radius:
        return out
    # A constant, folded once: all numbers of SEGMENT bits with `radius` ones.
    masks = F.split(F.lit(",".join(str(x) for x in range(1 << SEGMENT) if x.bit_count() == radius)), ",").cast("array<long>")
    return out.withColumn("mask", F.explode(masks)).withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, distance): the k nearest vectors by Hamming distance of each row of queries, a subset of
    vectors."""
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and size(v) > 0")
    dims = src.agg(F.max(F.size("v"))).first()[0] or SEGMENT
    coded = src.select("id", *_segments(F.col("v"), dims)).distinct()
    codes = coded.columns[1:]
    coded = materialize(coded, "codes")
    asking = coded.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi").withColumnRenamed("id", "query_id")
    # Of equal codes the k + 1 smallest ids: one may be the query itself.
    ranked = coded.withColumn("r", F.row_number().over(W.partitionBy(*codes).orderBy("id"))).where(F.col("r") <= k + 1)
    distinct = ranked.groupBy(*codes).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    index = materialize(_probes(distinct, codes, 0).select("j", "value", "ids", *(F.col(c).alias(f"x{c}") for c in codes)), "index")
    open_ = materialize(asking, "open")
    best = None
    done = []
    for s in range(SEGMENT + 1):
        apart = [F.bit_count(F.col(c).bitwiseXOR(F.col(f"x{c}"))) for c in codes]
        # Once only: no segment is nearer, and none before this one is as near.
        first = F.lit(True)
        for i, d in enumerate(apart):
            first = first & F.when(F.col("j") > i, d > s).otherwise(d >= s)
        # Probes are many more than the rows they come from: sizes guessed before that must not lead to a broadcast.
        met = _probes(open_, codes, s).join(index.hint("merge"), ["j", "value"]).where(first)
        met = met.select("query_id", *codes, sum(apart[1:], apart[0]).cast("int").alias("distance"), F.explode("ids").alias("vec_id")).where("vec_id <> query_id").select("query_id", "distance", "vec_id")
        met = met if best is None else met.unionAll(best)
        rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "vec_id")).alias("rank")
        met = materialize(met.distinct().select("query_id", rank, "vec_id", "distance").where(F.col("rank") <= k), "best")
        if s == SEGMENT:
            done.append(met)
            break
        covered = len(codes) * (s + 1) - 1
        closed = met.where((F.col("rank") == k) & (F.col("distance") <= covered)).select("query_id").distinct()
        done.append(met.join(closed, "query_id", "left_semi"))
        best = met.join(closed, "query_id", "left_anti").select("query_id", "distance", "vec_id")
        open_ = materialize(open_.join(closed, "query_id", "left_anti"), "open")
        if open_.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out.select("query_id", "rank", "vec_id", "distance")


def op8_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """Ten nearest of every vector whose id is divisible by 50, among all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))
