"""Events that follow from others: removals by exits, transfers and full rosters, kept in step with the ledger.

A member's seat in a body is held or not, and each trigger acts on it by that state alone: it ends a
held seat and leaves an empty one. So one pair of member and body is folded in time by looking at
the entry before: behind an appointment a trigger removes, behind anything else it does nothing, be that a
trigger which removed or one that found nothing. Removals that depend on earlier derived ones need no rounds.

Of all triggers only the first of each kind behind an appointment can act, so a pair meets
no more triggers than three times its appointments, however many rosters its body has.

Order within a day: rosters (they replace the state of the day before), appointments, removals, transfers, exits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import piped_id
from .replay import APPOINTED

REMOVED = "REMOVED"
#: Mode of the ledger's derived events.
DERIVED = "derived"
_ORD = "struct<day:date,phase:int,rank:int,id:string>"
_COLUMNS = ["member", "body", "kind", "ord", "why", "source", "locator", "told"]


def _ord(day, phase: int, rank: int | Column, id_) -> Column:
    rank = F.lit(rank) if isinstance(rank, int) else rank
    return F.struct(F.col(day).alias("day"), F.lit(phase).alias("phase"), rank.alias("rank"), F.col(id_).cast("string").alias("id")).cast(_ORD)


def _first_after(entries: DataFrame, triggers: DataFrame, key: str, fits=None) -> DataFrame:
    """Each entry with the first trigger of its key behind it (a struct ``hit``); entries without one are left out.

    ``triggers``: key and struct t with t.ord. A key's triggers come in one row, so a key with many entries can be split.
    """
    lists = triggers.groupBy(key).agg(F.sort_array(F.collect_list("t")).alias("ts"))
    behind = lambda t: (t["ord"] > F.col("ord")) & (fits(t) if fits else F.lit(True))
    hit = F.get(F.filter("ts", behind), F.lit(0))
    return entries.join(lists, key).withColumn("hit", hit).drop("ts").filter("hit IS NOT NULL")


def _entries(df: DataFrame, kind: Column, order: Column, why: str | None, told: bool) -> DataFrame:
    return df.select("member", "body", kind.alias("kind"), order.alias("ord"), F.lit(why).cast("string").alias("why"), "source", "locator", F.lit(told).alias("told"))


def derive(ledger: DataFrame, exits: DataFrame, transfers: DataFrame, rosters: DataFrame) -> DataFrame:
    """member, body, action, day, why, source, locator, event_id of all derived events.

    ``ledger``: event_id, member, body, action, day, source, locator, mode; ``exits``: trigger, member, day,
    source, locator; ``transfers``: the same with from_body (null: all bodies but the new one) and to_body;
    ``rosters``: body, day, member, source, locator, a row for each listed member of a full roster.

    An exit removes the member from every body held then. A transfer removes and appoints. A roster removes
    who held a seat the day before and isn't listed, and appoints who is listed and holds none. Derived events of an
    earlier run are no input. What a source has removed by its own exit before (same source, locator and member) is
    told again and doesn't count as a removal before it, so a replay finds what the first run found.
    Rows with a null member, body or day say nothing. Rosters of one body and day are one.
    """
    known = lambda df, *cols: df.filter(" AND ".join(f"{c} IS NOT NULL" for c in cols))
    exits, transfers, rosters = known(exits, "member", "day"), known(transfers, "member", "day", "to_body"), known(rosters, "body", "day", "member")
    base = known(ledger, "member", "body", "day").filter(~F.col("mode").eqNullSafe(F.lit(DERIVED)))
    marks = exits.select("source", "locator", "member", F.col("day").alias("exit_day")).distinct()
    same = [base[c].eqNullSafe(marks[c]) for c in ("source", "locator")] + [base["member"] == marks["member"]]
    again = base.filter(F.col("action") == REMOVED).join(marks, same).select(base["member"], "body", F.col("exit_day").alias("day"), base["source"], base["locator"]).distinct()
    told_before = (F.col("action") == REMOVED) & F.col("_m")
    base = base.join(marks.withColumn("_m", F.lit(True)).withColumnsRenamed({"source": "_s", "locator": "_l", "member": "_p"}).drop("exit_day").distinct(), F.col("source").eqNullSafe(F.col("_s")) & F.col("locator").eqNullSafe(F.col("_l")) & (F.col("member") == F.col("_p")), "left")
    base = base.filter(~F.coalesce(told_before, F.lit(False))).drop("_m", "_s", "_l", "_p")

    listed = rosters.groupBy("body", "day", "member").agg(F.min("source").alias("source"), F.min("locator").alias("locator"))
    moved = transfers.withColumn("body", F.col("to_body"))
    appointed, rank = F.lit(APPOINTED), F.when(F.col("action") == APPOINTED, 0).otherwise(2)
    entries = _entries(base, F.col("action"), _ord("day", 1, rank, "event_id"), None, False)
    entries = entries.unionByName(_entries(listed, appointed, _ord("day", 1, 1, "locator"), "roster", True))
    entries = entries.unionByName(_entries(moved, appointed, _ord("day", 2, 0, "trigger"), "transfer", True))
    held = entries.filter(F.col("kind") == APPOINTED).select("member", "body", "ord")

    trigger = lambda df, order, *more: F.struct(order.alias("ord"), "day", "source", "locator", *more).alias("t")
    by_exit = _first_after(held, exits.select("member", trigger(exits, _ord("day", 3, 0, "trigger"))), "member")
    fits = lambda t: (t["to_body"] != F.col("body")) & (t["from_body"].isNull() | (t["from_body"] == F.col("body")))
    by_move = _first_after(held, transfers.select("member", trigger(transfers, _ord("day", 2, 0, "trigger"), "to_body", "from_body")), "member", fits)
    days = rosters.groupBy("body", "day").agg(F.min("source").alias("source"), F.min("locator").alias("locator"))
    by_roster = _first_after(held, days.select("body", trigger(days, _ord("day", 0, 0, "locator"))), "body")
    by_roster = by_roster.withColumn("day", F.col("hit.day")).join(listed.select("body", "day", "member"), ["body", "day", "member"], "left_anti").drop("day")
    for hits, why in ((by_exit, "exit"), (by_move, "transfer"), (by_roster, "roster")):
        found = hits.select("member", "body", F.lit(REMOVED).alias("kind"), F.col("hit.ord").alias("ord"), F.lit(why).alias("why"), F.col("hit.source").alias("source"), F.col("hit.locator").alias("locator"), F.lit(True).alias("told"))
        entries = entries.unionByName(found.dropDuplicates(["member", "body", "ord"]))

    last = F.lag("kind").over(Window.partitionBy("member", "body").orderBy("ord"))
    acts = F.when(F.col("kind") == APPOINTED, F.col("last").isNull() | (F.col("last") != APPOINTED)).otherwise(F.col("last") == APPOINTED)
    out = entries.withColumn("last", last).filter("told").filter(acts)
    out = out.select("member", "body", F.col("kind").alias("action"), F.col("ord.day").alias("day"), "why", "source", "locator")
    again = again.select("member", "body", F.lit(REMOVED).alias("action"), "day", F.lit("exit").alias("why"), "source", "locator")
    out = out.unionByName(again).withColumn("event_id", piped_id(*(F.col(c) for c in ("source", "locator", "member", "body", "action", "day"))))
    return out.dropDuplicates(["event_id"])


def stored_ids(ledger: DataFrame) -> DataFrame:
    """Ids of the ledger's derived events."""
    return ledger.filter(F.col("mode") == DERIVED).select("event_id")


def refreshed(ledger: DataFrame, desired: DataFrame) -> DataFrame:
    """The ledger with its derived events replaced by ``desired``: stale ones go, missing ones come, the others stay as they are."""
    kept = ledger.join(desired.select(F.col("event_id").alias("_e")), F.col("event_id") == F.col("_e"), "left")
    kept = kept.filter(~F.col("mode").eqNullSafe(F.lit(DERIVED)) | F.col("_e").isNotNull()).drop("_e")
    new = desired.join(stored_ids(ledger), "event_id", "left_anti").withColumn("mode", F.lit(DERIVED))
    return kept.unionByName(new.select(*(new[c] if c in new.columns else F.lit(None).cast(ledger.schema[c].dataType).alias(c) for c in ledger.columns)))


def service_exits(ranges: DataFrame, documents: DataFrame, keys: list[str], period_end: Column) -> DataFrame:
    """Exits out of service ranges: trigger, member, day, source, locator.

    ``ranges``: keys (member among them), range_id, valid_from, valid_to, document; ``documents``: document, hash. Ranges
    without an end are no evidence; a missing document leaves the hash null. The last range of a key is an exit if it
    ends before ``period_end``. The locator is a digest of the range and its document's hash, so it
    changes with the evidence.
    """
    bounded = ranges.filter("valid_to IS NOT NULL").join(documents.select("document", "hash"), "document", "left")
    last = bounded.groupBy(*keys).agg(F.max_by(F.struct("range_id", "valid_from", "valid_to", "hash"), F.struct("valid_to", "range_id")).alias("r"))
    last = last.select(*keys, "r.*").filter(F.col("valid_to") < period_end)
    locator = piped_id(*(F.col(c) for c in (*keys, "valid_from", "valid_to", "hash")))
    return last.select(F.col("range_id").cast("string").alias("trigger"), "member", F.col("valid_to").alias("day"), F.lit("member-service").alias("source"), locator.alias("locator"))
