"""Column functions: ids, sentinels, scores, sequences, text. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What counts as no value, and prefixes of compact ids.
SENTINELS = ["", "nan", "none", "null", "<na>"]
CURIE_PREFIXES = ["EFO", "MONDO", "HP", "OBA", "GO", "MP", "NCIT", "GSSO", "DOID", "CL", "UBERON", "Orphanet"]


def clean(c: Column) -> Column:
    """Trimmed text; null for blanks and spelled-out nulls."""
    t = F.trim(c)
    return F.when(F.lower(t).isin(SENTINELS), None).otherwise(t)


def first_present(*cols: Column) -> Column:
    """The first cleaned value that is there."""
    return F.coalesce(*(clean(c) for c in cols))


def curie(c: Column) -> Column:
    """PREFIX_id becomes PREFIX:id for known prefixes; other ids stay."""
    return F.regexp_replace(clean(c), f"^({'|'.join(CURIE_PREFIXES)})_([A-Za-z0-9]+)$", "$1:$2")


def namespace(c: Column) -> Column:
    """The namespace of an id by its prefix or shape."""
    out = F.when(clean(c).isNull(), "missing")
    for p in CURIE_PREFIXES:
        out = out.when(c.rlike(f"^{p}[:_]"), p)
    return out.when(c.rlike("^[a-z]+:[0-9]+$"), F.substring_index(c, ":", 1)).when(c.rlike("^[0-9]+$"), "numeric").otherwise("other")


def bins(c: Column, *cuts: tuple[float, int], top: int) -> Column:
    """Score to level: the first cut that the score doesn't exceed; null stays null."""
    out = F.when(c.isNull(), None)
    for at, level in cuts:
        out = out.when(c <= at, level)
    return out.otherwise(top).cast("long")


def enhancer_credibility(c: Column) -> Column:
    return bins(c, (0.5, 1), (0.9, 2), top=3)


def phase_credibility(c: Column) -> Column:
    """Trial phase: 4 and more gives 3, 3 gives 2, else 1."""
    return F.when(c >= 4, 3).when(c >= 3, 2).otherwise(1).cast("long")


def level_credibility(c: Column) -> Column:
    return F.when(c.isin("1A", "1B"), 3).when(c.isin("2A", "2B"), 2).otherwise(1).cast("long")


def codes_credibility(codes: Column) -> Column:
    """Evidence codes: traceable or published ones give 3, purely electronic ones 1, others 2."""
    return F.when(F.arrays_overlap(codes, F.array(F.lit("TAS"), F.lit("PCS"))), 3).when(F.arrays_overlap(codes, F.array(F.lit("IEA"))), 1).otherwise(2).cast("long")


def subset_of(values: Column, allowed: list[str], excluded: list[str] = ()) -> Column:
    """Every element allowed, at least one element, none excluded."""
    ok = (F.size(values) > 0) & F.forall(values, lambda x: x.isin(list(allowed)))
    return ok & ~F.exists(values, lambda x: x.isin(list(excluded))) if excluded else ok


def measured(c: Column) -> Column:
    """A number is there: zero counts, null and NaN don't."""
    return c.isNotNull() & ~F.isnan(c.cast("double"))


def first_scalar(values: Column) -> Column:
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(1))


def source_parts(c: Column) -> Column:
    """`a/b` as a struct of source and dataset; without a slash the dataset is empty."""
    p = F.split(F.coalesce(c, F.lit("")), "/", 2)
    return F.struct(p[0].alias("source"), F.coalesce(F.try_element_at(p, F.lit(2)), F.lit("")).alias("source_dataset"))


def score_token(c: Column, digits: int = 4) -> Column:
    """A number as stable text for ids."""
    return F.coalesce(F.format_string(f"%.{digits}f", c.cast("double")), F.lit("na"))


def pmids(c: Column) -> Column:
    """All PubMed ids in a text, as `PMID:n`, in order, once each."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"(?i)(?:pubmed|pmid):?\s*([0-9]+)"), F.lit(1)), lambda x: F.concat(F.lit("PMID:"), x)))


def doi(c: Column) -> Column:
    """A DOI in lower case without its resolver."""
    t = F.regexp_replace(F.lower(clean(c)), r"^(https?://(dx\.)?doi\.org/|doi:)", "")
    return F.when(t.startswith("10."), t)


def pipe_list(c: Column) -> Column:
    """Values between pipes; `-` and blanks are dropped."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: ~x.isin("", "-"))


def xref_token(c: Column) -> Column:
    """`db:id(label)` as a struct."""
    p = r"^([^:]+):([^()]+)(?:\(([^)]*)\))?$"
    return F.struct(*(F.nullif(F.regexp_extract(c, p, i), F.lit("")).alias(n) for i, n in ((1, "db"), (2, "id"), (3, "label"))))


def zero_padded(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def no_version(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[0-9]+$", "")


def chromosome(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "^(?i:chr)", "")


def row_hash(*cols: Column) -> Column:
    """SHA-256 of the columns' text, tab-separated; null counts as empty."""
    return F.sha2(F.concat_ws("\t", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)), 256)


def finite(c: Column) -> Column:
    """A double, or null where the text is no finite number."""
    d = c.try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf")), d)


def joined(values: Column, sep: str = "; ") -> Column:
    """Sorted distinct values that aren't blank, joined; null if there are none."""
    kept = F.array_sort(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (F.trim(x) != ""))))
    return F.when(F.size(kept) > 0, F.array_join(kept, sep))


def first_date(*cols: Column) -> Column:
    """The first parseable date, as ISO text."""
    return F.date_format(F.coalesce(*(F.try_to_date(c, "yyyy-MM-dd") for c in cols)), "yyyy-MM-dd")


def windows(c: Column, size: int, stride: int) -> Column:
    """Structs (start, end, part) of a sequence; the last window ends at its length. Offsets are from 0, end exclusive."""
    n = F.length(c)
    steps = F.greatest(F.lit(0), F.ceil((n - size) / stride)).cast("int")
    start = F.transform(F.sequence(F.lit(0), steps), lambda i: F.greatest(F.lit(0), F.least(i * stride, n - size)))
    return F.when(n > 0, F.transform(start, lambda s: F.struct(s.alias("start"), F.least(s + size, n).alias("end"), F.substring(c, s + 1, F.lit(size)).alias("part"))))


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGTacgt", "TGCAtgca"))


def context(c: Column, position: Column, k: int) -> Column:
    """The letters within k of a position (from 1)."""
    lo = F.greatest(F.lit(1), position - k)
    return F.substring(c, lo, position + k - lo + 1)


def invalid_letters(c: Column, alphabet: str) -> Column:
    """The first ten distinct letters outside the alphabet, sorted, as one text; null if there are none."""
    bad = F.array_sort(F.array_except(F.array_distinct(F.split(F.upper(c), "")), F.array(*(F.lit(x) for x in [*alphabet, ""]))))
    return F.when(F.size(bad) > 0, F.array_join(F.slice(bad, 1, 10), ""))


def edge_weight(credibility: Column, score: Column) -> Column:
    """Credibility factor times the score, where the score is finite and positive."""
    factor = F.when(credibility == 3, 1.5).when(credibility == 2, 1.25).otherwise(1.0)
    s = finite(score)
    return factor * F.when(s > 0, F.least(s, F.lit(1.0))).otherwise(1.0)


def bounded_text(c: Column, most: int) -> Column:
    return F.substring(F.trim(F.regexp_replace(c, r"\s+", " ")), 1, most)


def payload(**fields: Column) -> Column:
    """`field: value` lines; blank fields are skipped."""
    return F.concat_ws("\n", *(F.when(clean(c).isNotNull(), F.concat(F.lit(f"{k}: "), clean(c))) for k, c in fields.items()))


def degree_gate(degree: Column, rate: float) -> Column:
    return rate * F.exp(-rate * degree) + 0.2


# Words by which a trial's reason for stopping is classified, in order of precedence.
OUTCOMES = [("safety", "safety|toxicity|adverse|side effect"), ("business", "business|sponsor|funding|financial|strategic"), ("efficacy", "efficacy|futility|lack of effect|ineffective")]


def trial_outcome(reason: Column, status: Column) -> Column:
    t = F.lower(F.coalesce(reason, F.lit("")))
    out = F.when(t.rlike(OUTCOMES[0][1]), OUTCOMES[0][0])
    for name, words in OUTCOMES[1:]:
        out = out.when(t.rlike(words), name)
    s = F.lower(F.coalesce(status, F.lit("")))
    return out.when(s == "completed", "completed").when(s.isin("terminated", "withdrawn", "suspended"), "stopped_unknown").otherwise("unknown")
