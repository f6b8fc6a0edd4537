"""Tables written to the folder that driver and executors share, so that a loop's plan doesn't grow."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a local master gets a temporary folder, and a cluster an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return _OWN.setdefault(context.applicationId, tempfile.mkdtemp(prefix="tidemark-scratch-"))


def settled(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once and read back."""
    path = f"{folder(df.sparkSession)}/tidemark/{df.sparkSession.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
