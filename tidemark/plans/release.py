"""Release datasets: projections of the ledger to their published columns, order, dictionary and hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Dataset: (column, logical type) in published order, and the columns it is sorted by.
DATASETS: dict[str, tuple[list[tuple[str, str]], list[str]]] = {
    "assignments": ([("congress_no", "integer"), ("chamber", "string"), ("member", "string"), ("committee_code", "string"), ("start_date", "date"), ("last_active_date", "date"), ("termination_effective_date", "date"), ("ended_early", "boolean"), ("start_release_event_id", "string"), ("end_release_event_id", "string")], ["congress_no", "chamber", "committee_code", "member", "start_date"]),
    "events": ([("release_event_id", "string"), ("congress_no", "integer"), ("member", "string"), ("committee_code", "string"), ("action", "string"), ("decision_date", "date"), ("effective_date", "date")], ["congress_no", "effective_date", "release_event_id"]),
    "rankings": ([("congress_no", "integer"), ("committee_code", "string"), ("member", "string"), ("party", "string"), ("rank", "integer"), ("start_date", "date"), ("end_date", "date")], ["congress_no", "committee_code", "party", "rank", "start_date"]),
    "members": ([("member", "string"), ("full_name", "string"), ("state", "string"), ("party", "string")], ["member"]),
    "services": ([("member", "string"), ("congress_no", "integer"), ("chamber", "string"), ("start_date", "date"), ("last_active_date", "date")], ["member", "start_date"]),
    "committees": ([("committee_code", "string"), ("chamber", "string"), ("committee_name", "string"), ("start_date", "date"), ("last_active_date", "date")], ["committee_code", "start_date"]),
    "sources": ([("release_source_id", "string"), ("source_type", "string"), ("source_name", "string"), ("publication_date", "date")], ["release_source_id"]),
    "directory_scores": ([("congress_no", "integer"), ("snapshot_date", "date"), ("chamber", "string"), ("scope", "string"), ("coverage_pct", "decimal"), ("gate_status", "string")], ["congress_no", "snapshot_date", "chamber", "scope"]),
}

_TYPES = {"integer": "int", "string": "string", "date": "date", "boolean": "boolean", "decimal": "double"}


def boundary(effective: Column, upper: Column, period_end: Column) -> dict[str, Column]:
    """The first of an end event's day, the interval's end and the period's end, and what follows from it."""
    end = F.coalesce(effective, upper, period_end)
    return {"termination_effective_date": end, "last_active_date": F.date_sub(end, 1), "ended_early": F.date_sub(end, 1) < F.date_sub(period_end, 1)}


def project(rows: DataFrame, dataset: str, version: str) -> DataFrame:
    """``rows`` with the dataset's columns, typed and in order, behind the release's version; missing ones are null."""
    columns, _ = DATASETS[dataset]
    cells = [(F.col(c) if c in rows.columns else F.lit(None)).cast(_TYPES[t]).alias(c) for c, t in columns]
    return rows.select(F.lit(version).alias("release_version"), *cells)


def ordered(rows: DataFrame, dataset: str) -> DataFrame:
    """The published order, nulls last."""
    return rows.orderBy(*(F.col(c).asc_nulls_last() for c in DATASETS[dataset][1]))


def rendered(rows: DataFrame, dataset: str) -> Column:
    """One row as its cells' texts joined by tabs: dates as yyyy-MM-dd, true/false, three decimals, null as nothing."""
    cells = []
    for c, t in DATASETS[dataset][0]:
        text = {"date": F.date_format(c, "yyyy-MM-dd"), "boolean": F.col(c).cast("string"), "decimal": F.format_string("%.3f", F.col(c))}.get(t, F.col(c).cast("string"))
        cells.append(F.coalesce(F.when(F.col(c).isNotNull(), text), F.lit("")))
    return F.concat_ws("\t", *cells)


def semantic_hash(rows: DataFrame, dataset: str) -> DataFrame:
    """n_rows and one hash of what the dataset says, whatever its order, version and files.

    The four quarters of the rows' hashes are added up, so partial sums meet, never rows.
    """
    h = F.sha2(rendered(rows, dataset), 256)
    quarters = [F.sum(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    text = F.concat_ws("/", *(F.coalesce(q, F.lit(0)).cast("string") for q in quarters))
    return rows.agg(F.count("*").alias("n_rows"), F.sha2(text, 256).alias("hash"))


def dictionary(spark) -> DataFrame:
    """dataset, ordinal, column, logical_type of every published column."""
    rows = [(d, i + 1, c, t) for d, (columns, _) in sorted(DATASETS.items()) for i, (c, t) in enumerate(columns)]
    return spark.createDataFrame(rows, "dataset string, ordinal int, column string, logical_type string")


def utc_text(moment: Column) -> Column:
    """A timestamp as 2024-01-02T03:04:05Z, in a session whose time zone is UTC."""
    return F.date_format(F.date_trunc("second", moment), "yyyy-MM-dd'T'HH:mm:ss'Z'")
