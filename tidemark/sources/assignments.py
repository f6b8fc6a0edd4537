"""Assignment resolutions: XML files to blocks, blocks to ranked slots.

The tree walk is the only Python: it carries the context of enclosing sections and
gives plain text blocks. Dates, headings, names and rank instructions are columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import slots as sl
from ..functions import text as tx

_RAW = "file string, citation string, date_text string, date_attr string, removing boolean, layout string, block int, header string, parts array<string>"


def _walk(batches):
    import re
    import xml.etree.ElementTree as ET

    import pandas as pd

    says_remove = re.compile(r"\bremov(?:e|ed|ing)\b", re.I).search
    flat = lambda e: " ".join("".join(e.itertext()).split()) if e is not None else ""

    def blocks(node, removing, in_section):
        if node.tag in ("section", "subsection"):
            removing = removing or any(says_remove(flat(t)) for t in node.findall("text"))
            in_section = in_section or node.tag == "section"
        head, body = flat(node.find("header")), flat(node.find("text"))
        if node.tag == "committee-appointment-paragraph":
            yield removing, "list", head, [body]
        elif node.tag == "subsection" and head:
            yield removing, "rows", head, [flat(p.find("text")) for p in node.iter("paragraph")]
        elif node.tag == "paragraph":
            if in_section and "ommit" in head:
                yield removing, "list", head, [body]
            yield True, "prose", "", [body]
        for child in node:
            yield from blocks(child, removing, in_section)

    for pdf in batches:
        rows = []
        for file, content in zip(pdf["path"], pdf["content"]):
            root = ET.fromstring(content)
            date = root.find(".//action-date")
            title = bool(says_remove(flat(root.find(".//official-title"))))
            about = (file, flat(root.find(".//legis-num")), flat(date), date.get("date") if date is not None else None)
            rows += [(*about, removing or title, layout, i, head, parts) for i, (removing, layout, head, parts) in enumerate(blocks(root, False, False))]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _RAW.split(", ")])


def assignment_blocks(spark: SparkSession, path: str, pattern: str = "*eh.xml") -> DataFrame:
    """file, citation, day, action, layout, block, header, parts.

    Layouts: ``list`` (names in one text), ``rows`` (a name for each paragraph) and
    ``prose`` (a sentence, kept only if it removes a member). The visible date goes
    before the attribute; a file without either gives nothing.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    attr = F.when(F.col("date_attr").rlike(r"^\s*\d{8}\s*$"), F.try_to_date(F.trim("date_attr"), "yyyyMMdd"))
    action = F.when(F.col("removing"), "REMOVED").otherwise("APPOINTED")
    rows = files.mapInPandas(_walk, _RAW).withColumns({"day": F.coalesce(tx.long_date(F.col("date_text")), attr), "action": action})
    kept = F.when(F.col("layout") == "prose", sl.removed_member(F.col("parts")[0]).isNotNull()).otherwise(F.length(sl.header_body(F.col("header"))) > 0)
    return rows.filter(F.col("day").isNotNull() & kept).select("file", "citation", "day", "action", "layout", "block", "header", "parts")


def assignment_slots(blocks: DataFrame, tracked: DataFrame | None = None, max_tracked: int = 10_000) -> DataFrame:
    """file, citation, day, action, block, body, ordinal, name, rank_after: a row for each listed member.

    ``tracked`` (key): only bodies with such a ``body_key`` count, as for one chamber's
    headings; it is broadcast while it has at most ``max_tracked`` rows.
    """
    part = F.col("parts")[0]
    whole = F.filter(F.transform("parts", lambda p: F.struct(F.trim(p).alias("name"), F.lit(None).cast("string").alias("rank_after"))), lambda s: F.length(s["name"]) > 2)
    prose = F.array(F.struct(sl.removed_member(part).alias("name"), F.lit(None).cast("string").alias("rank_after")))
    found = F.when(F.col("layout") == "rows", whole).when(F.col("layout") == "prose", prose).otherwise(sl.member_slots(part))
    bodies = F.when(F.col("layout") == "prose", sl.removed_bodies(part)).otherwise(F.array(sl.header_body(F.col("header"))))
    rows = blocks.select("file", "citation", "day", "action", "block", F.explode(bodies).alias("body"), found.alias("found"))
    rows = rows.select("file", "citation", "day", "action", "block", "body", F.posexplode("found").alias("pos", "slot"))
    rows = rows.select("file", "citation", "day", "action", "block", "body", (F.col("pos") + 1).alias("ordinal"), "slot.name", "slot.rank_after")
    if tracked is None:
        return rows
    keys = tracked.select("key").distinct()
    keys = F.broadcast(keys) if keys.limit(max_tracked + 1).count() <= max_tracked else keys
    return rows.withColumn("key", tx.body_key(F.col("body"))).join(keys, "key", "left_semi").drop("key")
