"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

A run is a bucketed table of (h1, h2, docs, keeper), sorted by hash in each bucket.
Batches of documents come by descending doc_id, so the first batch that holds a line
holds its largest doc_id. The lines of a batch are merge-anti-joined with the runs:
a line that no run holds enters with its keeper, one that is known only adds its
documents. Both make a run of level 0; ``fanout`` runs of a level are merged into
one of the next. All runs share one bucketing, so only the batch itself is shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, WHITE, cut, scratch_path, small

#: Null doc_ids count as this one, below every other.
NULL_ID = -(2**63)
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, upper, upper.lower()))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Levels of sorted runs in the shared folder, each cut from its lineage."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout, self.levels = spark, fanout, {}
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[str]:
        """Names of the tables, the newest first."""
        return [run for level in sorted(self.levels) for run in reversed(self.levels[level])]

    def _write(self, lines: DataFrame) -> str:
        name = f"tidemark_line_run_{uuid.uuid4().hex}"
        out = lines.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", scratch_path(self.spark, "line-run"))
        out.saveAsTable(name, format="parquet")
        return name

    def _merge(self, names: list[str]) -> str:
        merged = self._write(self._merged([self.spark.table(name) for name in names]))
        self._drop(names)
        return merged

    def _add(self, name: str, level: int) -> None:
        self.levels.setdefault(level, []).append(name)
        if len(self.levels[level]) >= self.fanout:
            self._add(self._merge(self.levels.pop(level)), level + 1)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One merge join a run: both sides are bucketed and sorted alike (a union of bucketed scans isn't)."""
        out = runs[0]
        for run in runs[1:]:
            other = run.select(*KEY, F.col("docs").alias("more"), F.col("keeper").alias("found")).hint("merge")
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            out = out.join(other, KEY, "full_outer").select(*KEY, docs.alias("docs"), F.greatest("keeper", "found").alias("keeper"))
        return out

    def add_batch(self, lines: DataFrame) -> None:
        """``lines``: h1, h2, did, of doc_ids that no earlier batch had and below all of them."""
        # a line held by many documents meets in partial sums, never as rows of one key
        batch = lines.distinct().groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("did").alias("keeper"))
        runs = [self.spark.table(name) for name in self.runs()]
        if runs:
            batch = cut(batch, "line-batch")
        new, known = batch, []
        for run in runs:
            held = run.select(*KEY).hint("merge")
            known.append(new.join(held, KEY, "left_semi").withColumn("keeper", F.lit(None).cast("long")))
            new = new.join(held, KEY, "left_anti")
        for rows in known:
            new = new.unionByName(rows)
        self._add(self._write(new), 0)

    def frequent(self, min_docs: int) -> DataFrame:
        """h1, h2, keeper of the lines that at least ``min_docs`` documents hold; merges all runs, the small ones first."""
        names = self.runs()
        while len(names) > 1:
            names = [self._merge(names[:2]), *names[2:]]
        self.levels = {0: names}
        return self.spark.table(names[0]).filter(F.col("docs") >= min_docs).select(*KEY, "keeper")

    def drop(self) -> None:
        for names in self.levels.values():
            self._drop(names)
        self.levels = {}


def _batch_bounds(docs: DataFrame, least: int, batch_docs: int) -> list[int]:
    """The doc_ids at which batches of about ``batch_docs`` rows end, ``least`` batches at least."""
    did = F.coalesce(F.col("doc_id"), F.lit(NULL_ID))
    batches = max(least, -(-docs.count() // batch_docs))
    if batches < 2:
        return []
    found = docs.select(F.percentile_approx(did, [k / batches for k in range(1, batches)], 10 * batches).alias("b")).first()[0]
    return sorted(set(found or ()), reverse=True)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, batch_docs: int = 50_000_000, fanout: int = 2, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned, and two more: n_lines, n_dropped.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    doc_ids loses all its lines except in the largest doc_id holding it. Null and
    empty text are one empty line (null becomes ''), a null doc_id counts as the
    smallest one, rows that repeat a doc_id are judged alike. Texts of any length are
    split whole. Input columns named n_lines or n_dropped are replaced; no other name
    clashes. An empty table gives no rows. There are at least ``batches`` batches, and
    none of much more than ``batch_docs`` documents; the result doesn't depend on them.
    """
    spark = docs.sparkSession
    did, th = F.coalesce(F.col("doc_id"), F.lit(NULL_ID)), F.xxhash64("text")
    bounds = _batch_bounds(docs, batches, batch_docs)
    batch = sum((F.when(did <= b, 1).otherwise(0) for b in bounds), F.lit(0))
    lines = docs.select(did.alias("did"), th.alias("th"), batch.alias("batch"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    lines = lines.select("did", "th", "batch", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    lines = cut(lines, "lines", "batch")

    runs = LineRuns(spark, fanout)
    for k in range(len(bounds) + 1):
        runs.add_batch(lines.filter(F.col("batch") == k).select(*KEY, "did"))
    held = small(cut(runs.frequent(min_docs), "frequent-lines"), broadcast_bytes)
    runs.drop()

    gone = lines.join(held, KEY).filter("did <> keeper").groupBy("did", "th").agg(F.array_distinct(F.collect_list("pos")).alias("gone"))
    gone = small(cut(gone, "dropped-lines"), broadcast_bytes)
    # the input's columns travel in one struct, so that none can clash with the working ones
    marked = docs.select(F.struct("*").alias("row"), did.alias("did"), th.alias("th")).join(gone, ["did", "th"], "left")
    text = F.col("row")["text"]
    parts = split_lines(text)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return marked.select(
        *((kept if c == "text" else F.col("row")[c]).alias(c) for c in columns),
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
