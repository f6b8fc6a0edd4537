"""Event replay: an appointment ledger becomes validity intervals with one window.

After an appointment the state is always open, so the very next event of the key
closes it; one ordered window over the key gives every interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

APPOINTED, REMOVED = "APPOINTED", "REMOVED"


def order_columns(day: str, action: str, event_id: str) -> list[Column]:
    """Date, appointments before removals, id."""
    return [F.col(day), F.when(F.col(action) == APPOINTED, 0).otherwise(1), F.col(event_id)]


def replay(events: DataFrame, keys: list[str], end: Column, day: str = "day", action: str = "action", event_id: str = "event_id") -> DataFrame:
    """keys, start_event_id, valid_from, valid_to, end_event_id; ``end`` closes what stays open.

    Same-day appointment and removal cancel; intervals that would be empty or
    inverted at ``end`` are left out.
    """
    w = Window.partitionBy(*keys).orderBy(*order_columns(day, action, event_id))
    seen = events.select(*keys, day, action, event_id, *(F.lead(c).over(w).alias(f"_{c}") for c in (day, action, event_id)))
    opened = seen.filter((F.col(action) == APPOINTED) & (F.col(f"_{day}").isNull() | (F.col(f"_{day}") > F.col(day))))
    out = opened.select(
        *keys,
        F.col(event_id).alias("start_event_id"),
        F.col(day).alias("valid_from"),
        F.coalesce(F.col(f"_{day}"), end).alias("valid_to"),
        F.when(F.col(f"_{action}") == REMOVED, F.col(f"_{event_id}")).alias("end_event_id"),
    )
    return out.filter("valid_from < valid_to")


def clamp_start(intervals: DataFrame, floor: Column) -> DataFrame:
    return intervals.withColumn("valid_from", F.greatest("valid_from", floor)).filter("valid_from < valid_to")


def merge_one_day(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Merge each unterminated one-day interval with the one it touches, in pairs from the left.

    Within a run of mergeable rows the even ones absorb the odd ones: not transitive.
    """
    w = Window.partitionBy(*keys).orderBy("valid_from", "start_event_id")
    merges = (F.col("valid_to") == F.date_add("valid_from", 1)) & F.col("end_event_id").isNull() & (F.lead("valid_from").over(w) == F.col("valid_to"))
    rows = intervals.withColumn("_m", F.coalesce(merges, F.lit(False)))
    rows = rows.withColumns({"_run": F.when(F.lag("_m").over(w), 0).otherwise(1), "_to": F.lead("valid_to").over(w), "_end": F.lead("end_event_id").over(w)})
    rows = rows.withColumn("_run", F.sum("_run").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    nth = F.row_number().over(Window.partitionBy(*keys, "_run").orderBy("valid_from", "start_event_id"))
    rows = rows.withColumn("_nth", nth).filter("_nth % 2 = 1")
    rows = rows.withColumns({"valid_to": F.when(F.col("_m"), F.col("_to")).otherwise(F.col("valid_to")), "end_event_id": F.when(F.col("_m"), F.col("_end")).otherwise(F.col("end_event_id"))})
    return rows.select(intervals.columns)


def redundant_by_balance(events: DataFrame, keys: list[str], day: str = "day", action: str = "action", event_id: str = "event_id") -> DataFrame:
    """Appointments of a key whose appointments before exceed its removals before."""
    w = Window.partitionBy(*keys).orderBy(*order_columns(day, action, event_id)).rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(F.col(action) == APPOINTED, 1).otherwise(-1)
    return events.withColumn("balance", F.coalesce(F.sum(step).over(w), F.lit(0))).filter((F.col(action) == APPOINTED) & (F.col("balance") > 0))


def redundant_by_lag(events: DataFrame, keys: list[str], day: str = "day", action: str = "action", event_id: str = "event_id") -> DataFrame:
    """Appointments that follow an appointment of the same key directly."""
    w = Window.partitionBy(*keys).orderBy(*order_columns(day, action, event_id))
    return events.withColumn("_last", F.lag(action).over(w)).filter((F.col(action) == APPOINTED) & (F.col("_last") == APPOINTED)).drop("_last")
