"""Streaming counterpart of the replay: micro-batches append to the ledger, touched keys are rebuilt.

Effective dates arrive out of order, so a batch recomputes the intervals of the
keys it touches from the whole ledger; batch recomputation stays the source of truth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ledger as led
from ..operators.replay import replay


def touched_intervals(ledger: DataFrame, batch: DataFrame, keys: list[str], end: Column) -> DataFrame:
    """Intervals of the keys of ``batch`` after its events joined the ledger."""
    whole = led.insert_ignore(ledger, batch, ["event_id"])
    return replay(whole.join(batch.select(*keys).distinct(), keys, "left_semi"), keys, end)


def start(stream: DataFrame, ledger_path: str, out_path: str, keys: list[str], end: str, checkpoint: str):
    """Run touched_intervals for every micro-batch; each batch's intervals carry its number."""

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.dropDuplicates(["event_id"])
        try:
            ledger = spark.read.schema(batch.schema).parquet(ledger_path)
        except Exception as missing:  # the first batch finds no ledger
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            ledger = spark.createDataFrame([], batch.schema)
        found = touched_intervals(ledger, batch, keys, F.lit(end).cast("date"))
        found.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        new = batch.join(ledger.select("event_id"), "event_id", "left_anti").select(batch.columns)
        new.write.mode("append").parquet(ledger_path)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
