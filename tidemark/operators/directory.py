"""Directory snapshots against replayed membership: cells, counters, gates and mismatch rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import percent

#: Codes of select and special bodies whose names don't say so.
SELECT_CODES = ["HLIG", "HSZS", "SLIN", "SLET", "SPAG"]
#: How the names of bodies begin that are not tracked on purpose, and what they hold.
UNTRACKED_STARTS = ["joint committee", "select committee", "special committee", "commission", "board"]
UNTRACKED_PARTS = [" commission", " board", " council", " task force", " advisory "]
CELL = ["congress", "day", "chamber", "scope"]


def body_scope(chamber: Column, text: Column, code: Column) -> Column:
    """joint, select_special or standing; null fields count as empty."""
    chamber, text, code = (F.coalesce(c, F.lit("")) for c in (chamber, text, code))
    special = text.rlike(r"(?i)\b(?:select|special)\b") | code.isin(SELECT_CODES)
    return F.when((F.lower(chamber) == "joint") | code.startswith("J"), "joint").when(special, "select_special").otherwise("standing")


def is_standing(chamber: Column, code: Column, name: Column, joint: Column) -> Column:
    """What a release of standing bodies keeps."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return ~(joint | (chamber == "J") | code.startswith("J") | low.contains("select") | low.contains("special") | code.isin(SELECT_CODES))


def out_of_scope(name: Column) -> Column:
    """Bodies like committees that are not tracked on purpose."""
    low = F.lower(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " ")))
    starts, parts = (F.array(*map(F.lit, words)) for words in (UNTRACKED_STARTS, UNTRACKED_PARTS))
    policy = low.endswith("policy committee") & ~low.startswith("committee on ")
    return F.exists(starts, lambda x: low.startswith(x)) | F.exists(parts, lambda x: low.contains(x)) | policy


def directory_cells(entries: DataFrame, observed: DataFrame, min_coverage: float, min_resolution: float) -> DataFrame:
    """All counters, percentages and the gate of each cell (congress, day, chamber, scope).

    ``entries``: cell, body, code (null: not mapped), member (null: not resolved), a row for each
    listed member; ``observed``: cell, code, member. An unmapped body resolves nobody. Gate:
    NO_REFERENCE without entries; PASS if enough entries are observed, enough of the mapped ones
    resolved and all bodies mapped; else FAIL.
    """
    mapped = F.col("code").isNotNull()
    counts = entries.groupBy(*CELL).agg(
        F.count("*").alias("entries"), F.count_if(mapped & F.col("member").isNull()).alias("unresolved_entries"),
        F.count_if(~mapped).alias("unmapped_entries"), F.countDistinct(F.when(~mapped, F.col("body"))).alias("unmapped_bodies"),
    )
    told = entries.filter(mapped & F.col("member").isNotNull()).select(*CELL, "code", "member").distinct().withColumn("told", F.lit(True))
    seen = observed.select(*CELL, "code", "member").distinct().withColumn("seen", F.lit(True))
    sides = told.join(seen, [*CELL, "code", "member"], "full_outer")
    sets = sides.groupBy(*CELL).agg(F.count("told").alias("resolved"), F.count("seen").alias("observed"), F.count_if(F.col("told") & F.col("seen")).alias("overlap"))
    out = counts.join(sets, CELL, "full_outer").na.fill(0, ["entries", "unresolved_entries", "unmapped_entries", "unmapped_bodies", "resolved", "observed", "overlap"])
    of_mapped = F.col("entries") - F.col("unmapped_entries")
    enough = (F.col("overlap") >= min_coverage * F.col("entries")) & ((of_mapped == 0) | (F.col("resolved") >= min_resolution * of_mapped)) & (F.col("unmapped_entries") == 0)
    return out.withColumns(
        {
            "directory_only": F.col("resolved") - F.col("overlap"), "observed_only": F.col("observed") - F.col("overlap"),
            "resolution_pct": percent(F.col("resolved"), of_mapped), "coverage_pct": percent(F.col("overlap"), F.col("entries")),
            "observed_pct": percent(F.col("overlap"), F.col("observed")),
            "gate_status": F.when(F.col("entries") == 0, "NO_REFERENCE").when(enough, "PASS").otherwise("FAIL"),
        }
    )


def mismatches(entries: DataFrame, observed: DataFrame) -> DataFrame:
    """cell, kind, body, code, member: unmapped bodies, unresolved members, and what only one side has."""
    cols = [*CELL, "kind", "body", "code", "member"]
    none = F.lit(None).cast("string")
    unmapped = entries.filter("code IS NULL").select(*CELL, "body").distinct().withColumns({"kind": F.lit("unmapped_committee"), "code": none, "member": none})
    unresolved = entries.filter("code IS NOT NULL AND member IS NULL").select(*CELL, "body", "code").withColumns({"kind": F.lit("unresolved_member"), "member": none})
    told = entries.filter("code IS NOT NULL AND member IS NOT NULL").groupBy(*CELL, "code", "member").agg(F.min("body").alias("body"))
    seen = observed.select(*CELL, "code", "member").distinct()
    on = [*CELL, "code", "member"]
    only_told = told.join(seen, on, "left_anti").withColumn("kind", F.lit("directory_only"))
    only_seen = seen.join(told, on, "left_anti").withColumns({"kind": F.lit("observed_only"), "body": none})
    return unmapped.select(cols).unionByName(unresolved.select(cols)).unionByName(only_told.select(cols)).unionByName(only_seen.select(cols))
