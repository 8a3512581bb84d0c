"""Node feature rows: checks, audits, hashed text vectors, attachment with a fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sequence_faults(text: Column, alphabet: str, most: int) -> Column:
    """The first fault of a sequence, or null; alphabet is a pattern of whole valid sequences."""
    return F.when(F.length(F.coalesce(text, F.lit(""))) == 0, "empty").when(~text.rlike(alphabet), "bad_alphabet").when(F.length(text) > most, "too_long")


def text_faults(text: Column, most: int) -> Column:
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty").when(F.length(text) > most, "too_long")


def bit_faults(bits: Column, n: int) -> Column:
    """The first fault of a list of set bits, or null."""
    return F.when(F.exists(bits, lambda b: (b < 0) | (b >= n)), "out_of_range").when(F.size(bits) == 0, "all_zero")


def length_audit(df: DataFrame, text: str, window: int, stride: int) -> DataFrame:
    """One row: rows, rows over the window, windows in all, shortest and longest."""
    n = F.length(text)
    k = F.when(n > 0, F.greatest(F.lit(0), F.ceil((n - window) / stride)) + 1).otherwise(0)
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(n > window).alias("over"), F.sum(k).cast("long").alias("windows"), F.min(n).alias("shortest"), F.max(n).alias("longest"))


def hashed_text(df: DataFrame, text: str, dim: int) -> DataFrame:
    """df with `vector`: hashed counts of lower-case words of two letters and more and of their pairs, of length one."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\w\w+"), F.lit(0))
    pairs = F.zip_with("__w", F.slice("__w", 2, F.greatest(F.size("__w"), F.lit(1))), lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
    terms = df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__w", words)
    out = terms.withColumn("__t", F.filter(F.concat("__w", pairs), lambda x: x.isNotNull()))
    slots = F.transform("__t", lambda x: F.pmod(F.xxhash64(x), F.lit(dim)).cast("int"))
    # One pass per text: sorted slots are counted by run ends.
    out = out.withColumn("__s", F.array_sort(slots))
    ends = F.filter(F.transform("__s", lambda x, i: F.when((i + 1 == F.size("__s")) | (F.try_element_at("__s", i + 2) != x), F.struct(x.alias("k"), (i + 1).alias("e")))), lambda x: x.isNotNull())
    out = out.withColumn("__e", ends)
    runs = F.transform("__e", lambda x, i: F.struct(x["k"].alias("k"), (x["e"] - F.when(i > 0, F.try_element_at("__e", i)["e"]).otherwise(0)).cast("double").alias("n")))
    out = out.withColumn("__m", F.map_from_entries(runs)).withColumn("__l", F.sqrt(F.aggregate(F.map_values("__m"), F.lit(0.0), lambda a, x: a + x * x)))
    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: F.coalesce(F.try_element_at(F.col("__m"), k) / F.nullif(F.col("__l"), F.lit(0.0)), F.lit(0.0)))
    return out.withColumn("vector", vec).select(*df.columns, "vector")


def attach(nodes: DataFrame, features: DataFrame, dim: int, seed: int) -> DataFrame:
    """nodes with `vector` and `real`: the feature where there is one of the right size, else a seeded vector from the id."""
    v = nodes.join(features.select("id", F.col("vector").alias("__v")), "id", "left")
    fallback = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: F.pmod(F.xxhash64(F.lit(seed), "id", k), F.lit(1 << 20)) / float(1 << 20) - 0.5)
    real = F.coalesce(F.size("__v") == dim, F.lit(False))
    return v.withColumn("vector", F.when(real, F.col("__v").cast("array<double>")).otherwise(fallback)).withColumn("real", real).drop("__v")
