"""Gaps and islands, seams, elementary boundaries and adjacent merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Column) -> DataFrame:
    """Adds ``island``: a running number that grows at rows where ``starts`` (null counts as true)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    flagged = df.withColumn("_s", F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0))
    return flagged.withColumn("island", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def close_seams(df: DataFrame, keys: list[str]) -> DataFrame:
    """A range that ends one day before the next begins is drawn out to it."""
    nxt = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from", "valid_to"))
    return df.withColumn("valid_to", F.when(F.date_add("valid_to", 1) == nxt, nxt).otherwise(F.col("valid_to")))


def boundaries(df: DataFrame, keys: list[str]) -> DataFrame:
    """Elementary ranges between neighbouring distinct boundaries of each key."""
    points = df.select(*keys, F.col("valid_from").alias("since")).union(df.select(*keys, F.col("valid_to").alias("since"))).filter("since IS NOT NULL").distinct()
    nxt = F.lead("since").over(Window.partitionBy(*keys).orderBy("since"))
    return points.withColumn("until", nxt).filter("until IS NOT NULL")


def sweep_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges active in each elementary range, by a running sum of opens and closes (no range join)."""
    steps = df.select(*keys, F.col("valid_from").alias("since"), F.lit(1).alias("step")).union(df.select(*keys, F.col("valid_to").alias("since"), F.lit(-1).alias("step")))
    by_day = steps.filter("since IS NOT NULL").groupBy(*keys, "since").agg(F.sum("step").alias("step"))
    w = Window.partitionBy(*keys).orderBy("since")
    out = by_day.withColumns({"until": F.lead("since").over(w), "active": F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    return out.filter("until IS NOT NULL").drop("step")


def merge_adjacent(df: DataFrame, keys: list[str], attributes: list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Touching rows with equal attributes become one."""
    w = Window.partitionBy(*keys).orderBy(start)
    same = F.lag(end).over(w).eqNullSafe(F.col(start))
    for a in attributes:
        same = same & F.lag(a).over(w).eqNullSafe(F.col(a))
    flagged = df.withColumn("_new", ~same)
    return islands(flagged, keys, [start], F.col("_new")).groupBy(*keys, *attributes, "island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("island")


def sole_value(df: DataFrame, group: list[str], column: str) -> DataFrame:
    """Fill nulls by the group's value where it has exactly one; groups are aggregated, then joined back."""
    names = {g: f"_{g}" for g in group}
    only = df.groupBy(*(F.col(g).alias(n) for g, n in names.items())).agg(F.min(column).alias("_only"), F.max(column).alias("_most"))
    same = reduce(Column.__and__, (F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()))
    return df.join(only.filter("_only = _most"), same, "left").withColumn(column, F.coalesce(column, "_only")).select(df.columns)


def carry_forward(df: DataFrame, keys: list[str], order: list[str], column: str, to: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(to, F.last(column, ignorenulls=True).over(w))


def neighbour_text(df: DataFrame, keys: list[str], order: list[str], column: str, radius: int, to: str) -> DataFrame:
    """Texts of the rows around each row joined by newlines, blank ones left out."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-radius, radius)
    near = F.collect_list(F.when(F.length(F.trim(column)) > 0, F.col(column))).over(w)
    return df.withColumn(to, F.array_join(near, "\n"))
