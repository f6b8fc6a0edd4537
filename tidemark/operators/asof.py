"""State as of a date and temporal dimension lookups, set at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import contains, overlaps


def latest(events: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The first row of each key in the given order. Every operator brings its own tie-break."""
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return events.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def state_as_of(events: DataFrame, keys: list[str], day: Column, on: str = "effective", ties: tuple[str, ...] = ("decision", "event_id")) -> DataFrame:
    """Latest row of each key whose ``on`` date is at or before ``day``."""
    return latest(events.filter(F.col(on) <= day), keys, [F.col(c).desc() for c in (on, *ties)])


def held_on(events: DataFrame, keys: list[str], day: Column, **order) -> DataFrame:
    return state_as_of(events, keys, day, **order).filter("action = 'APPOINTED'")


def roster_removals(prior: DataFrame, new: DataFrame, group: list[str], member: str) -> DataFrame:
    """Members of the prior roster missing from the new one, for groups whose new roster isn't empty."""
    replaced = prior.join(new.select(*group).distinct(), group, "left_semi")
    return replaced.join(new.select(*group, member), [*group, member], "left_anti").select(*group, member).distinct()


def temporal_lookup(facts: DataFrame, dims: DataFrame, key: str, day: str, value: str, fallback: Column, dim_key: str | None = None) -> DataFrame:
    """The dimension value valid on the fact's day, the latest valid_from winning; else ``fallback``.

    Facts keep their rows: the best dimension row is picked by an ordered aggregate over key
    and day; of rows that begin on one day the greatest value counts.
    """
    dim_key = dim_key or key
    dims = dims.select(F.col(dim_key).alias("_k"), "valid_from", "valid_to", F.col(value).alias("_v"))
    fits = (F.col(key) == F.col("_k")) & contains(F.col("valid_from"), F.col("valid_to"), F.col(day))
    days = facts.select(key, day).distinct()
    best = days.join(dims, fits).groupBy(key, day).agg(F.max_by("_v", F.struct("valid_from", "_v")).alias("_best"))
    return facts.join(best, [key, day], "left").withColumn(value, F.coalesce("_best", fallback)).drop("_best")


def clip_join(a: DataFrame, b: DataFrame, on: list[str], most: int = 100_000) -> DataFrame:
    """Pairs of ranges of a and b that meet, cut to their intersection; b's columns come along.

    Without a key b is sent to every task while it has at most ``most`` rows; beyond that
    both sides meet by the years they touch, each pair in the first year they share.
    """
    b = b.withColumnsRenamed({"valid_from": "_from", "valid_to": "_to"})
    meets = overlaps(F.col("valid_from"), F.col("valid_to"), F.col("_from"), F.col("_to"))
    if on:
        joined = a.join(b, on).filter(meets)
    elif b.limit(most + 1).count() <= most:
        joined = a.join(F.broadcast(b), meets)
    else:
        ends = [df.agg(F.max(F.year(F.greatest(F.col(f), F.coalesce(t, f))))).first()[0] for df, f, t in ((a, "valid_from", "valid_to"), (b, "_from", "_to"))]
        last = max([e for e in ends if e is not None], default=0)
        touched = lambda f, t: F.explode(F.sequence(F.year(f), F.coalesce(F.year(t), F.lit(last)))).alias("_year")
        joined = a.select("*", touched("valid_from", "valid_to")).join(b.select("*", touched("_from", "_to")), "_year")
        joined = joined.filter(meets & (F.year(F.greatest("valid_from", "_from")) == F.col("_year"))).drop("_year")
    return joined.withColumns({"valid_from": F.greatest("valid_from", "_from"), "valid_to": F.least("valid_to", "_to")}).drop("_from", "_to")


def terminal_exits(ranges: DataFrame, keys: list[str], end: Column, range_id: str) -> DataFrame:
    """The last range of each key, if it ends before ``end``."""
    return latest(ranges, keys, [F.col("valid_to").desc(), F.col(range_id).desc()]).filter(F.col("valid_to") < end)


def exit_candidates(exits: DataFrame, events: DataFrame, member: str, body: str) -> DataFrame:
    """Bodies a member still holds at the exit: latest transition up to it, removals winning ties."""
    met = events.join(exits.select(member, F.col("valid_to").alias("exit_date")), member).filter("effective <= exit_date")
    order = [F.col("effective").desc(), F.col("decision").desc(), (F.col("action") == "REMOVED").desc(), F.col("event_id").desc()]
    return latest(met, [member, body], order).filter("action = 'APPOINTED'")
