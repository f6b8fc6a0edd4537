"""Picking, pairing and repairing rows: newest copies, preferred matches, ordinals, repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_copy(df: DataFrame, key: list[Column], order: list[str]) -> DataFrame:
    """Of the rows alike in ``key`` (nulls alike too) the greatest by ``order``; one aggregate, no sort of groups."""
    whole = F.struct(*df.columns)
    names = [f"key_{i}" for i in range(len(key))]
    return df.groupBy(*(k.alias(n) for k, n in zip(key, names))).agg(F.max_by(whole, F.struct(*order, F.xxhash64(whole))).alias("row")).select("row.*")


def prefer(df: DataFrame, key: list[str], wish: Column, order: list[str]) -> DataFrame:
    """One row a key: where ``wish`` holds before where not, where it is unknown last; then by ``order``."""
    rank = F.when(wish, 0).when(wish.isNull(), 2).otherwise(1)
    return df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), F.struct(rank, *order)).alias("row")).select("row.*")


def pair_ordinals(left: DataFrame, right: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The nth row of a key on either side; further columns of ``right`` are joined to ``left``'s."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    more = [c for c in right.columns if c not in left.columns]
    return left.withColumn("ordinal", n).join(right.withColumn("ordinal", n).select(*key, "ordinal", *more), [*key, "ordinal"])


def drop_repeats(df: DataFrame, run: list[str], order: list[str], key: list[str]) -> DataFrame:
    """Within a run the first row by ``order`` of each ``key`` stays."""
    return df.groupBy(*run, *key).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("row")).select("row.*")


def get_or_create(wanted: DataFrame, table: DataFrame, key: list[str], id_: str) -> DataFrame:
    """Every wanted key with its id: the table's, else one made of the key's digest."""
    made = F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key)), 256)
    known = table.groupBy(*key).agg(F.min(id_).alias(id_))
    met = wanted.select(*key).distinct().join(known, key, "left")
    return met.select(*key, F.coalesce(F.col(id_), made).alias(id_), F.col(id_).isNull().alias("created"))


def repair(table: DataFrame, repairs: DataFrame, key: list[str], column: str, when: Column) -> DataFrame:
    """``table`` with ``column`` from ``repairs`` where a row has one that differs and ``when`` (over ``old`` and ``new``) holds."""
    new = repairs.groupBy(*key).agg(F.max(column).alias("new"))
    met = table.withColumnRenamed(column, "old").join(new, key, "left")
    take = F.coalesce(F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("old")) & when, F.lit(False))
    out = met.withColumns({column: F.when(take, F.col("new")).otherwise(F.col("old")), "repaired": take})
    return out.select(*table.columns, "repaired")


def regroup(children: DataFrame, mapping: DataFrame, parent: str, measures: list[Column]) -> DataFrame:
    """Children by their parent's canonical id: ``mapping`` (parent, keep) names those that moved."""
    kept = mapping.select(F.col(parent).alias("moved"), "keep")
    met = children.join(kept, F.col(parent) == F.col("moved"), "left")
    return met.groupBy(F.coalesce("keep", parent).alias(parent)).agg(*measures)
