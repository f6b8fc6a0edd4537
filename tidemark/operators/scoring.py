"""Set overlap scores, gates and integrity codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """Rounded to three decimals, halves to the even one; null over zero."""
    return F.when(whole != 0, F.bround(part / whole * 100, 3))


def compare_sets(reference: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """keys and ``side``: both, directory_only or observed_only (set semantics)."""
    left = reference.select(*keys).distinct().withColumn("_l", F.lit(True))
    right = observed.select(*keys).distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "directory_only").otherwise("observed_only")
    return left.join(right, keys, "full_outer").select(*keys, side.alias("side"))


def overlap_scores(sides: DataFrame, cell: list[str], min_coverage: float) -> DataFrame:
    """Counts, guarded ratios and the gate of each cell: NO_REFERENCE, then PASS, then FAIL."""
    n = lambda side: F.sum(F.when(F.col("side") == side, 1).otherwise(0))
    counts = sides.groupBy(*cell).agg(n("both").alias("n_both"), n("directory_only").alias("n_directory_only"), n("observed_only").alias("n_observed_only"))
    reference, observed = F.col("n_both") + F.col("n_directory_only"), F.col("n_both") + F.col("n_observed_only")
    gate = F.when(reference == 0, "NO_REFERENCE").when(F.col("n_both") >= min_coverage * reference, "PASS").otherwise("FAIL")
    return counts.withColumns({"coverage_pct": percent(F.col("n_both"), reference), "observed_pct": percent(F.col("n_both"), observed), "gate_status": gate})


def gate_failures(required: DataFrame, scores: DataFrame, cell: list[str]) -> DataFrame:
    """Required cells that are missing or didn't pass."""
    joined = required.join(scores.select(*cell, "gate_status"), cell, "left")
    return joined.select(*cell, F.coalesce("gate_status", F.lit("MISSING_CELL")).alias("reason")).filter("reason <> 'PASS'")


def issue_codes(df: DataFrame, rules: list[tuple[str, Column]], to: str = "issues") -> DataFrame:
    """Rows that break any rule, with the codes broken joined by ';' in the order given."""
    codes = F.array_compact(F.array(*(F.when(rule, code) for code, rule in rules)))
    return df.withColumn(to, F.array_join(codes, ";")).filter(F.col(to) != "")


def narrow(candidates: DataFrame, query: list[str], *tests: Column) -> DataFrame:
    """Each test in turn keeps a query's matching candidates, or all if none matches."""
    from pyspark.sql import Window

    w = Window.partitionBy(*query)
    for test in tests:
        candidates = candidates.withColumn("_t", F.coalesce(test, F.lit(False)))
        candidates = candidates.withColumn("_any", F.max("_t").over(w)).filter(F.col("_t") | ~F.col("_any")).drop("_t", "_any")
    return candidates


def narrowed_lookup(queries: DataFrame, members: DataFrame, base: list[str], tests: list[str], query: str, found: str) -> DataFrame:
    """query and the one member left, as narrow() and unique() give it for equality tests.

    Members are counted once for each level of keys that can be left; a query looks its
    levels up, best first, and never meets the single members. ``tests``: most important first.
    """
    out = queries
    levels = []
    for bits in range((1 << len(tests)) - 1, -1, -1):
        keys = [*base, *(t for i, t in enumerate(tests) if bits >> (len(tests) - 1 - i) & 1)]
        level = members.groupBy(*keys).agg(F.struct(F.min(found).alias("lo"), F.max(found).alias("hi")).alias(f"level_{bits}"))
        out = out.join(level, keys, "left")
        levels.append(F.col(f"level_{bits}"))
    return out.withColumn("left", F.coalesce(*levels)).filter("left.lo = left.hi").select(query, F.col("left.lo").alias(found))


def unique(candidates: DataFrame, query: list[str], found: str) -> DataFrame:
    """query and the candidate, for queries with exactly one distinct candidate left."""
    counts = candidates.groupBy(*query).agg(F.min(found).alias("_lo"), F.max(found).alias("_hi"))
    return counts.filter("_lo = _hi").select(*query, F.col("_lo").alias(found))
