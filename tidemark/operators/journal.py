"""Pages of journals in order, read as one text: a state carried from page to page.

A page is cut before its marks: dates, headings of bodies, frames that announce a list, frames that end seats,
and stops. What holds at a place is the last mark of each kind before it, on whatever page: the day, the body
(none behind a stop) and the frame. A frame lapses some pages after the one it stands on. Names count where a body is open and the
last frame appoints, so a list goes on over page breaks and under the next page's headings.

The marks of a volume are carried forward in two steps, within even parts of the sorted rows and from part
to part, so a volume is never one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cues as cu
from ..functions import pages as pg
from .spread import carried

#: Wordings of frames and stops, by chamber, in any case; % stands for anything between, in one sentence.
APPOINTS = {
    "H": ["committee election", "the speaker%appointed", "pursuant to%appointed", "appointed%the following"],
    "S": ["notwithstanding%rule xxv", "standing committees", "orders for committee service", "constitute the majority party%membership", "constitute the minority party%membership", "making minority party appointments", "ordered that the following", "committee elected"],
}
ENDS = {
    "H": ["removed from the", "resign from the committee", "resignation from the committee", "discharged from the", "stripped of", "cease to be%member of", "no longer%member of"],
    "S": ["relieved from further service", "excused from further", "resign from the committee", "resignation from the committee"],
}
STOPS = {
    "H": ["when said resolution", "a motion to reconsider", "to rank immediately", "message from"],
    "S": ["yeas ---", "nays ---", "rollcall vote", "the question being on", "on motion by", "order for consideration", "house bill read", "morning business", "message from"],
}
LONGEST = 120
_TITLE_LINE = r"(?:Permanent )?(?:Select |Special |Standing |Joint )*"


def _wording(phrases: list[str]) -> str:
    return "|".join(r"\b" + p.replace(" ", r"\s+").replace("%", r"[^.:]{0,200}?\b") for p in phrases)


def segments(text: Column, chamber: str) -> Column:
    """A mended page cut before its marks: array of (kind, value, rest).

    kind: day, body, appoints, ends, stop or text; value: the mark's own words; rest: what follows up to the next mark.
    """
    flat = pg.apart(pg.clean(text))
    heading = rf"{_TITLE_LINE}(?i:committee) (?i:on) (?:the )?{cu.CAPITALS}(?=\s*(?::|—|--))"
    marks = [("day", pg.LONG_DAY), ("ends", rf"(?i:{_wording(ENDS[chamber])})"), ("stop", rf"(?i:{_wording(STOPS[chamber])})"), ("appoints", rf"(?i:{_wording(APPOINTS[chamber])})"), ("body", heading)]
    for kind, pattern in marks:
        flat = F.regexp_replace(flat, f"({pattern})", f"\u0001{kind}\u0002$1\u0003")
    parts = F.split(flat, "\u0001", -1)

    def part(p):
        kind = F.substring_index(p, "\u0002", 1)
        body = F.substring(p, F.length(kind) + 2, F.length(p))
        # a mark inside another ends it: what was put into it goes again
        value, rest = F.substring_index(body, "\u0003", 1), F.regexp_replace(body, "^[^\u0003]*\u0003", "")
        marked = F.instr(p, "\u0002") > 0
        return F.struct(F.when(marked, kind).otherwise("text").alias("kind"), F.when(marked, value).alias("value"), F.replace(F.when(marked, rest).otherwise(p), F.lit("\u0003"), F.lit("")).alias("rest"))

    return F.transform(parts, part)


def scan(pages: DataFrame, chamber: str, lasts: int = 3) -> DataFrame:
    """volume, page, day, body, member, place of all members that a chamber's pages seat.

    ``pages``: volume, page, text. A heading opens its body, a stop closes it. A frame holds on its page and ``lasts``
    pages behind it; one that ends seats holds off the names till another appoints. Pairs that
    the chamber's gate refuses are left out, and so are the Senate's bodies with a single name, which are no lists. A pair
    that a volume repeats under one day counts at its first place. A page without text has no marks; one without a
    number or volume is left out. A day holds until the next one in its volume.
    """
    known = pages.filter("volume IS NOT NULL AND page IS NOT NULL").select("volume", "page", F.coalesce("text", F.lit("")).alias("text"))
    rows = known.select("volume", "page", F.posexplode(segments(F.col("text"), chamber)).alias("seg", "s"))
    rows = rows.select("volume", "page", "seg", "s.kind", "s.value", "s.rest")
    kind = F.col("kind")
    body = F.when(kind == "body", F.struct(F.col("value").alias("name"), F.col("page").alias("page"), F.col("seg").alias("seg"))).when(kind == "stop", F.struct(F.lit("").alias("name"), F.col("page").alias("page"), F.col("seg").alias("seg")))
    frame = F.when(kind.isin("appoints", "ends"), F.struct(kind.alias("kind"), F.col("page").alias("page")))
    day = F.when(kind == "day", pg.stated_day(F.col("value")))
    rows = carried(rows, ["volume"], ["page", "seg"], {"day": day, "body": body, "frame": frame})
    live = (F.col("body.name") != "") & (F.col("frame.kind") == "appoints") & (F.col("page") - F.col("frame.page") <= lasts)
    named = rows.filter(live).select("volume", "page", "seg", "day", "body", F.posexplode(pg.titled_members(F.col("rest"))).alias("nth", "member"))
    named = named.withColumn("heading", F.regexp_replace("body.name", r"\s+", " "))
    named = named.filter(pg.gate(F.col("heading"), F.col("member"), longest=LONGEST, chamber=chamber).isNull())
    if chamber == "S":  # one list, however many segments and pages it has
        several = named.groupBy("volume", "body").agg(F.countDistinct("member").alias("n")).filter("n > 1").drop("n")
        named = named.join(several, ["volume", "body"], "left_semi")
    first = named.groupBy("volume", "day", F.col("heading").alias("name"), "member").agg(F.min(F.struct("page", "seg", "nth")).alias("at"))
    return first.select("volume", F.col("at.page").alias("page"), "day", F.col("name").alias("body"), "member", F.concat(F.lit(chamber), F.col("at.page").cast("string")).alias("place"))
