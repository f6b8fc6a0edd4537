"""Shared folder, table cuts and word splitting for the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters other than the space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"

#: Largest table, in bytes as ``table_bytes`` counts them, that is sent to every executor.
BROADCAST_BYTES = 64 << 20

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a temporary one; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if context.applicationId not in _OWN_DIR:
        _OWN_DIR[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(_OWN_DIR[context.applicationId])
    return _OWN_DIR[context.applicationId]


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{_own_scratch(spark)}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str, *folders: str) -> DataFrame:
    """Write ``df`` once to the shared folder, in ``folders`` by these columns, and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, tag)
    df.write.partitionBy(*folders).parquet(path) if folders else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application; call it when no result is read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as rows in memory: 32 a row, 8 a column, and what strings, binaries and arrays hold."""
    held = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            held.append(F.octet_length(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            held.append(16 * F.size(f.name))
    held = [F.coalesce(F.sum(h), F.lit(0)).cast("long") for h in held]
    n, *sizes = df.agg(F.count(F.lit(1)), *held).first()
    return n * (32 + 8 * len(df.columns)) + sum(sizes)


def small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it takes at most ``max_bytes``, else as it is.

    Give it a table that is cut: without strings and arrays the count is a footer read.
    """
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df


def trimmed(run):
    """``run`` for ``mapInArrow``, giving its memory back at the end: workers live on between stages."""

    def wrapped(batches):
        yield from run(batches)
        import ctypes

        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not this C library
            pass

    return wrapped


def free_names(df: DataFrame, n: int) -> list[str]:
    """``n`` names that no column of ``df`` has, in any case."""
    taken, prefix = {c.lower() for c in df.columns}, "field_"
    while any(f"{prefix}{i}" in taken for i in range(n)):
        prefix += "_"
    return [f"{prefix}{i}" for i in range(n)]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
