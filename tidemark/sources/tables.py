"""Scans of the driver's tables and literal dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly to all cores: for work on each row that takes longer than reading it, as a file's row group is read by one task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as an appointment ledger: event_id, user_id, day, action.

    signup and purchase appoint, error removes; other types are no transitions.
    """
    action = F.when(F.col("event_type").isin("signup", "purchase"), "APPOINTED").when(F.col("event_type") == "error", "REMOVED")
    rows = table(spark, folder, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), action.alias("action"))
    return rows.filter("action IS NOT NULL")


def years(spark: SparkSession, first: int, last: int) -> DataFrame:
    """period, valid_from, valid_to of calendar years."""
    y = spark.range(first, last + 1).select(F.col("id").cast("int").alias("period"))
    return y.withColumns({"valid_from": F.make_date("period", F.lit(1), F.lit(1)), "valid_to": F.make_date(F.col("period") + 1, F.lit(1), F.lit(1))})
