"""Running values over a key whose rows needn't fit in a task.

The rows are sorted over the whole cluster into even parts; each part runs for itself, and then takes from the parts
before it what its keys had there: one row for each key and part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settled


def _parts(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, as a second run of the sort may draw its bounds elsewhere
    return settled(df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()), "parts")


def carried(df: DataFrame, keys: list[str], order: list[str], marks: dict[str, Column]) -> DataFrame:
    """Adds to each row the last non-null value of each mark, that of the row itself included, within its keys."""
    rows = _parts(df.withColumns({f"_{m}": c for m, c in marks.items()}), keys, order)
    within = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_{m}": F.last(f"_{m}", ignorenulls=True).over(within) for m in marks}).withColumn("_n", F.row_number().over(within.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.groupBy(*keys, "_part").agg(*(F.max_by(f"_{m}", "_n").alias(f"_{m}") for m in marks))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(*keys, "_part", *(F.last(f"_{m}", ignorenulls=True).over(earlier).alias(f"_b_{m}") for m in marks))
    out = rows.join(before, [*keys, "_part"], "left")
    return out.select(*df.columns, *(F.coalesce(f"_{m}", f"_b_{m}").alias(m) for m in marks))


def numbered(df: DataFrame, keys: list[str], order: list, to: str) -> DataFrame:
    """Adds each row's number (from 1) within its keys."""
    rows = _parts(df, keys, order)
    within = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    counts = within.groupBy(*keys, "_part").agg(F.max("_n").alias("_c"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "_part", F.sum("_c").over(earlier).alias("_before"))
    return within.join(before, [*keys, "_part"], "left").select(*df.columns, (F.col("_n") + F.coalesce("_before", F.lit(0))).cast("long").alias(to))
