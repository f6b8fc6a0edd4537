"""Deterministic CSV, checksums and partition-wise rebuilds."""

from __future__ import annotations

import csv
import hashlib
import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cell(df: DataFrame, name: str) -> Column:
    """A column rendered for the release CSV: ISO dates, true/false, three decimals, '' for null."""
    kind, c = dict(df.dtypes)[name], F.col(name)
    if kind == "date":
        c = F.date_format(c, "yyyy-MM-dd")
    elif kind in ("double", "float") or kind.startswith("decimal"):
        c = F.when(c.isNotNull(), F.format_string("%.3f", c.cast("double")))
    return F.coalesce(c.cast("string"), F.lit("")).alias(name)


def write_release_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """One sorted CSV file with a header, put in place when whole; rows stream through the driver."""
    rows = df.orderBy(*order).select(*(cell(df, c) for c in df.columns))
    part = Path(f"{path}.part")
    with part.open("w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(df.columns)
        for row in rows.toLocalIterator(prefetchPartitions=True):
            writer.writerow(row)
    os.replace(part, path)


def file_sha256(path: Path) -> str:
    with path.open("rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def write_metadata(folder: str, counts: dict[str, int], version: str) -> None:
    """release_metadata.json and SHA256SUMS over the files of ``folder``."""
    root = Path(folder)
    (root / "release_metadata.json").write_text(json.dumps({"row_counts": counts, "schema_version": version}, indent=2, sort_keys=True) + "\n")
    sums = [f"{file_sha256(p)}  {p.name}\n" for p in sorted(root.iterdir()) if p.is_file() and p.name != "SHA256SUMS"]
    (root / "SHA256SUMS").write_text("".join(sums))


def rebuild_partitions(df: DataFrame, path: str, column: str, requested: list) -> None:
    """Overwrite the requested partitions; one that got no rows is emptied, others stay."""
    spark = df.sparkSession
    df = df.filter(F.col(column).isin(requested))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    filled = {r[0] for r in df.select(column).distinct().collect()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for value in set(requested) - filled:
        stale = hadoop(f"{path}/{column}={value}")
        stale.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(stale, True)


def compare_folders(left: str, right: str) -> list[tuple[str, str]]:
    """(file, same | differs | left_only | right_only) by SHA-256."""
    digest = lambda d: {p.name: file_sha256(p) for p in Path(d).iterdir() if p.is_file()}
    a, b = digest(left), digest(right)
    side = lambda n: "left_only" if n not in b else "right_only" if n not in a else "same" if a[n] == b[n] else "differs"
    return [(n, side(n)) for n in sorted(a | b)]
