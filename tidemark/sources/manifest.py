"""Source manifests: classes of titles, groups, chambers, expected files and their state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Wordings of titles in upper case, tried in this order; % is anything between.
RECORD_TITLES = [
    ("committee_removal", ["%RESIGNATION AS MEMBER%", "%RESIGNATION AS A MEMBER%", "%RESIGNATIONS AS MEMBER%", "%RESIGNATIONS AS A MEMBER%"]),
    ("chamber_exit", ["%RESIGNATION FROM THE HOUSE%", "%RESIGNATION FROM THE SENATE%"]),
    ("committee_appointment", [f"%{what} MEMBER{s} TO %COMMITTEE%" for what in ("APPOINTMENT OF", "ELECTION OF", "ELECTING") for s in ("", "S")]),
    ("member_death", ["%DEATH OF%", "%PASSING OF%"]),
    ("speaker_election", ["%ELECTION OF SPEAKER%"]),
    ("role_change_only", ["%RESIGNATION AS CHAIR%"]),
]
RESOLUTION_TITLES = [
    ("committee_assignment", ["%ELECTING A %COMMITTEE%", "%ELECTING AN %COMMITTEE%", "%ELECTING CERTAIN %COMMITTEE%", "%ELECTING MEMBER%COMMITTEE%", "%TO CONSTITUTE %MEMBERSHIP ON %COMMITTEE%", "%TO CONSTITUTE %MEMBERSHIP OF %COMMITTEE%", "%APPOINTING %MEMBER%COMMITTEE%", "%APPOINTMENT OF %MEMBER%COMMITTEE%", "%REMOVING %MEMBER FROM %COMMITTEE%"]),
]


def title_class(title: Column, wordings: list[tuple[str, list[str]]]) -> Column:
    """The first class one of whose wordings the title has, else other; blanks count once, case doesn't."""
    text = F.trim(F.regexp_replace(F.upper(F.coalesce(title, F.lit(""))), r"\s+", " "))
    out = F.when(F.lit(False), "")
    for name, patterns in wordings:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | text.like(p)
        out = out.when(hit, name)
    return out.otherwise("other")


def resolution_group(package: Column) -> Column:
    """The part of a package's id that all versions of one resolution share, in lower case."""
    parts = F.regexp_extract(F.lower(package), r"^bills-\d+(?:h|s)res\d+", 0)
    return F.nullif(parts, F.lit(""))


def resolution_number(citation: Column) -> Column:
    return F.regexp_extract(F.upper(citation), r"\bRES\.?\s*(\d+)\b", 1).try_cast("int")


def granule_chamber(kind: Column, granule: Column) -> Column:
    """H or S from what a granule says of itself, else from its page; extensions are the House's."""
    said = F.upper(F.coalesce(kind, F.lit("")))
    page = F.regexp_extract(F.coalesce(granule, F.lit("")), r"-Pg([HSE])\d", 1)
    return F.when(said.contains("HOUSE"), "H").when(said.contains("SENATE"), "S").when(page.isin("H", "E"), "H").when(page == "S", "S").otherwise("")


#: Expected types whose packages speak for their group.
RESOLUTION_TYPES = ["house_resolution", "senate_resolution"]


def propagate_candidates(rows: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """A resolution one of whose versions, expected as a resolution, is a committee assignment is one in all its versions."""
    group = resolution_group(F.col("package"))
    hits = rows.filter((F.col("candidate_class") == "committee_assignment") & F.col("expected_type").isin(RESOLUTION_TYPES) & group.isNotNull()).select(group.alias("hit")).distinct()
    hits = F.broadcast(hits) if hits.limit(broadcast_rows + 1).count() <= broadcast_rows else hits
    marked = rows.join(hits, group == F.col("hit"), "left")
    return marked.withColumn("candidate_class", F.when(F.col("hit").isNotNull(), "committee_assignment").otherwise(F.col("candidate_class"))).drop("hit")


def category(expected: Column, candidate: Column, required: list[str], optional: list[str], validation: list[str], required_classes: list[str]) -> Column:
    """required (by candidate class before type), optional, validation_only or null."""
    norm = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    by_class = norm(candidate).isin(required_classes) if required_classes else F.lit(False)
    return F.when(by_class | norm(expected).isin(required), "required").when(norm(expected).isin(optional), "optional").when(norm(expected).isin(validation), "validation_only")


def retrieval_state(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` (path, sha256, size) with ``status`` against ``files`` (path, sha256, size) at hand."""
    held = files.select("path", F.col("sha256").alias("f_sha"), F.col("size").alias("f_size"))
    met = rows.join(held, "path", "left")
    status = F.when(F.col("f_sha").isNull(), "MISSING").when(F.col("sha256").isNotNull() & (F.col("sha256") != F.col("f_sha")), "HASH_MISMATCH")
    status = status.when(F.col("size").isNotNull() & (F.col("size") != F.col("f_size")), "SIZE_MISMATCH").otherwise("RETRIEVED")
    return met.withColumn("status", status).drop("f_sha", "f_size")


def manifest(found: DataFrame, specs: DataFrame) -> DataFrame:
    """``found`` once for each (collection, package, granule), newest first kept, and a FAILED row for each spec without any."""
    key = ["collection", "package", "granule"]
    whole = F.struct(*(c for c in found.columns if c not in key))
    newest = found.groupBy(*key).agg(F.max_by(whole, F.struct("modified", F.xxhash64(whole))).alias("row")).select(*key, "row.*")
    empty = specs.join(found.select("collection").distinct(), "collection", "left_anti").withColumns({"status": F.lit("FAILED"), "error": F.lit("no source was listed")})
    return newest.withColumns({"status": F.lit("LISTED"), "error": F.lit(None).cast("string")}).unionByName(empty, allowMissingColumns=True)


def policy_errors(policy: dict) -> list[str]:
    """What is wrong with a validation policy: thresholds in [0, 1], required cells whole and once each."""
    errors = [f"{k}: not a share" for k in ("minimum_directory_coverage", "minimum_member_resolution") if not isinstance(policy.get(k), (int, float)) or isinstance(policy.get(k), bool) or not 0 <= policy[k] <= 1]
    cells = policy.get("required_cells")
    if not isinstance(cells, list) or not cells:
        return [*errors, "required_cells: not a list with cells"]
    seen = set()
    for i, cell in enumerate(cells):
        cell = cell if isinstance(cell, dict) else {}
        key = (cell.get("congress"), cell.get("day"), cell.get("chamber"))
        if not isinstance(key[0], int) or not isinstance(key[1], str) or key[2] not in ("H", "S", "J"):
            errors.append(f"required_cells[{i}]: not whole")
        elif key in seen:
            errors.append(f"required_cells[{i}]: again")
        seen.add(key)
    return errors


def read_policy(path: str) -> dict:
    """A validation policy from a JSON file; raises with all its errors."""
    import json
    from pathlib import Path

    policy = json.loads(Path(path).read_text())
    errors = policy_errors(policy if isinstance(policy, dict) else {})
    if errors:
        raise ValueError("; ".join(errors))
    return policy
