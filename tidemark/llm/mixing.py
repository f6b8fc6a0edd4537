"""Mixing sources to target weights by Pareto order sampling.

A source's target becomes copies of its documents: whole copies are certain, and
of the fraction p a sample is drawn. Documents are ranked by random odds divided
by inclusion odds, (u / (1 - u)) / (p / (1 - p)), and the sample is the prefix of
that order whose words come nearest to what the whole copies leave of the target
(its size is fixed in words). u comes from an MD5 of doc_id and text, so reruns
agree; p differs with the document's weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, cut, n_words, small

#: Buckets of the order in [0, 1): each source's prefix is found by bucket sums first.
BUCKETS = 4096


def uniform_key(doc_id: Column, text: Column) -> Column:
    """Thirty-two hexadecimal digits that are uniform over documents."""
    of_text = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), of_text))


def _fill(rows: DataFrame, group: list[str], weight: str, cap: str, total: Column) -> DataFrame:
    """Share ``total`` in each group by ``weight`` up to ``cap``; the excess goes on by weight.

    In ascending order of cap / weight the rows that reach their cap are a prefix,
    so one ordered pass gives the level. Adds ``filled``.
    """
    order = [F.col(cap) / F.col(weight), *(F.col(c).asc_nulls_last() for c in ("source", "class"))]
    window = Window.partitionBy(*group).orderBy(*order)
    before = F.coalesce(F.sum(cap).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = F.sum(weight).over(window.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    out = rows.withColumn("_level", (total - before) / ahead)
    # the level holds from the first row that doesn't reach its cap
    free = F.when(F.col("_level") <= F.col(cap) / F.col(weight), F.col("_level"))
    out = out.withColumn("_level", F.first(free, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    filled = F.least(F.col(cap).cast("double"), F.coalesce(F.col("_level") * F.col(weight), F.col(cap).cast("double")))
    return out.withColumn("filled", filled).drop("_level")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size, target of a table (source, size)."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    sums = sums.withColumn("weight", F.get(F.array(*map(F.lit, weights)), nth))
    sums = sums.withColumn("cap", most * F.col("source_size")).withColumn("class", F.lit(0))
    total = F.sum("source_size").over(Window.partitionBy())
    return _fill(sums, [], "weight", "cap", total).select("source", "source_size", F.col("filled").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, short_words: int = 50, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All columns of ``docs`` and five more (``mix_`` prefix): size, source_size, target, copies, taken.

    Documents of under ``short_words`` words have half the weight of others, so
    half the expected copies, within their source. Null text has size 0; a null
    source is one source, the last; a source without words has target 0; rows alike in
    doc_id and text share their fate. No document is taken more than ``most`` times.
    Input columns with the new names are replaced; no other name clashes. An empty
    table gives none.
    """
    # the input's columns travel in one struct, so that none can clash with the working ones
    base = docs.select(F.struct("*").alias("row"), n_words(F.col("text")).alias("size"), uniform_key(F.col("doc_id"), F.col("text")).alias("key"), "source")
    base = base.withColumn("class", F.when(F.col("size") < short_words, 1).otherwise(2))
    sizes = cut(base.select("source", "size", "class", "key"), "mix-sizes")

    targets = source_targets(sizes, weights, most)
    groups = sizes.groupBy("source", "class").agg(F.sum("size").alias("class_size"))
    groups = groups.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    groups = groups.withColumn("weight", F.col("class") * F.col("class_size")).withColumn("cap", most * F.col("class_size"))
    groups = groups.filter("class_size > 0")
    groups = _fill(groups, ["source"], "weight", "cap", F.col("target"))
    groups = groups.withColumn("each", F.col("filled") / F.col("class_size")).withColumn("whole", F.floor("each"))
    groups = groups.withColumn("p", F.col("each") - F.col("whole"))
    rest = F.col("target") - F.sum(F.col("whole") * F.col("class_size")).over(Window.partitionBy("source"))
    groups = cut(groups.withColumn("rest", rest).select("source", "class", "source_size", "target", "whole", "p", "rest"), "mix-groups")

    match = lambda a, b: a["source"].eqNullSafe(b["source"]) & (a["class"] == b["class"])
    ranked = sizes.join(small(groups, broadcast_bytes), match(sizes, groups)).select(sizes["source"], "size", "key", "p", "rest").filter("p > 0")
    ranked = ranked.withColumn("q", _order(F.col("key"), F.col("p"))).withColumn("bucket", _bucket(F.col("q")))
    sums = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("words").over(upto))
    edge = sums.filter("upto > rest").groupBy("source").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")), "bucket").alias("e"))
    edge = cut(edge.select("source", "e.bucket", "e.before"), "mix-edges")
    near = ranked.join(small(edge.withColumnsRenamed({"source": "_s", "bucket": "_b"}), broadcast_bytes), F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    order = Window.partitionBy("source").orderBy("q", "key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    last = near.withColumn("_before", before).filter(2 * F.col("_before") + F.col("size") <= 2 * F.col("rest"))
    last = last.groupBy("source").agg(F.max(F.struct("q", "key")).alias("last"))

    join = lambda a, b: a.join(b.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    plan = join(join(groups, edge), last).select(
        F.col("source").alias("_source"), F.col("class").alias("_of"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), "whole", "p", F.coalesce("bucket", F.lit(BUCKETS)).alias("edge"), "last",
    )
    plan = small(cut(plan, "mix-plan"), broadcast_bytes)
    targets = small(cut(targets.select(F.col("source").alias("_source2"), F.col("source_size").alias("_size2"), F.col("target").alias("_target2")), "mix-targets"), broadcast_bytes)
    out = base.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_of")), "left")
    out = out.join(targets, F.col("source").eqNullSafe(F.col("_source2")), "left")
    q = F.when(F.col("p") > 0, _order(F.col("key"), F.col("p")))
    drawn = (_bucket(q) < F.col("edge")) | ((_bucket(q) == F.col("edge")) & (F.struct(q.alias("q"), F.col("key").alias("key")) <= F.col("last")))
    copies = F.coalesce(F.col("whole"), F.lit(0)) + F.when(F.coalesce(drawn, F.lit(False)), 1).otherwise(0)
    figures = {"mix_size": F.col("size"), "mix_source_size": F.col("_size2"), "mix_target": F.col("_target2"), "mix_copies": copies.cast("long"), "mix_taken": (copies * F.col("size")).cast("long")}
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in figures), *(f.alias(c) for c, f in figures.items()))


def _order(key: Column, p: Column) -> Column:
    u = (F.conv(F.substring(key, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return (u / (1 - u)) / (p / (1 - p))


def _bucket(q: Column) -> Column:
    return F.least(F.floor(q / (1 + q) * BUCKETS), F.lit(BUCKETS - 1))


def repeat_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row of mix() as often as it was taken."""
    row, copy = F.struct(*columns).alias("row"), F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("copy")
    return mixed.filter("mix_copies > 0").select(row, copy).select("row.*")
