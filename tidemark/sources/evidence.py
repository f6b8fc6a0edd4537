"""Scans of evidence files: manifests, snapshots, proceedings and mixed-content XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a source manifest, of which congress_no is INT and size_bytes BIGINT.
MANIFEST_INTS = {"congress_no": "int", "size_bytes": "bigint"}


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest CSV; counted columns typed, blanks as null."""
    raw = spark.read.csv(path, header=True)
    return raw.select(*(F.expr(f"try_cast(nullif(trim(`{c}`), '') AS {MANIFEST_INTS[c]})").alias(c) if c in MANIFEST_INTS else F.col(f"`{c}`") for c in raw.columns))


SNAPSHOT = "name string, committee string, type string, chamber string, democrats array<string>, republicans array<string>"


def directory_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row for each printed label: file, body, chamber, party, label; both field dialects."""
    raw = spark.read.schema(SNAPSHOT).json(path, multiLine=True)
    rows = raw.select(
        F.input_file_name().alias("file"), F.coalesce("name", "committee").alias("body"), F.coalesce("type", "chamber", F.lit("House")).alias("chamber"),
        F.explode(F.array(F.struct(F.lit("D").alias("party"), F.coalesce("democrats", F.array().cast("array<string>")).alias("labels")), F.struct(F.lit("R").alias("party"), F.coalesce("republicans", F.array().cast("array<string>")).alias("labels")))).alias("side"),
    )
    return rows.select("file", "body", "chamber", "side.party", F.explode("side.labels").alias("label")).filter("trim(label) <> ''")


PROCEEDINGS = "header struct<chamber: string>, content array<struct<kind: string, speaker: string, text: string>>"


def proceedings(spark: SparkSession, path: str) -> DataFrame:
    """One row for each content item: file, day (from the file name), chamber, pos, kind, speaker, text."""
    raw = spark.read.schema(PROCEEDINGS).json(path, multiLine=True).withColumn("file", F.input_file_name())
    chamber = F.coalesce("header.chamber", F.when(F.col("file").contains("PgS"), "Senate").otherwise("House"))
    day = F.try_to_date(F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    return raw.select("file", day.alias("day"), chamber.alias("chamber"), F.posexplode("content").alias("pos", "item")).select("file", "day", "chamber", "pos", "item.*")


def resolutions(spark: SparkSession, path: str, pattern: str = "*eh.xml") -> DataFrame:
    """One row for each appointment paragraph of resolution XML: file, citation, day, header, text.

    Mixed content keeps its text order, which needs an XML tree; the files are read
    by Spark and parsed on the executors.
    """
    schema = "file string, citation string, day date, header string, text string"

    def parse(batches):
        import datetime as dt
        import xml.etree.ElementTree as ET

        import pandas as pd

        flat = lambda e: " ".join("".join(e.itertext()).split()) if e is not None else None
        for pdf in batches:
            rows = []
            for file, content in zip(pdf["path"], pdf["content"]):
                root = ET.fromstring(content)
                date = root.find(".//action-date")
                raw = (date.get("date") or "") if date is not None else ""
                day = dt.date(int(raw[:4]), int(raw[4:6]), int(raw[6:8])) if raw[:8].isdigit() and len(raw) >= 8 else None
                for p in root.iter("committee-appointment-paragraph"):
                    rows.append((file, flat(root.find(".//legis-num")), day, flat(p.find("header")), flat(p.find("text"))))
            yield pd.DataFrame(rows, columns=["file", "citation", "day", "header", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    return files.mapInPandas(parse, schema)
