"""Upserts, reconciliation and constraint checks as whole-table operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(keys: list[str]) -> Column:
    """Each key equals its namesake with an underscore, nulls being values."""
    return reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))


def _null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    right = b.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    return a.join(right, _same(keys), how)


def insert_ignore(table: DataFrame, new: DataFrame, *keys: list[str]) -> DataFrame:
    """``table`` and the rows of ``new`` that collide on none of the key lists, first row by order of keys."""
    for key in keys:
        order = [F.col(c) for c in sorted(new.columns)]
        new = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")
        new = _null_safe(new, table, key, "left_anti")
    return table.unionByName(new)


def _one_each(new: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    """The greatest row of each key by ``order`` (else all other columns); rows with a null in the key all stay."""
    order = order or [c for c in new.columns if c not in keys]
    keyed = F.forall(F.array(*(F.col(k).isNotNull() for k in keys)), lambda x: x)
    if not order:
        return new.filter(keyed).distinct().unionByName(new.filter(~keyed))
    one = new.filter(keyed).groupBy(*keys).agg(F.max_by(F.struct(*new.columns), F.struct(*order)).alias("row"))
    return one.select("row.*").unionByName(new.filter(~keyed))


def upsert(table: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``table`` with the same key.

    Of several new rows with one key the greatest by ``order`` (all other columns, if none is
    given) counts. A key with a null matches no other row, so such rows are added.
    """
    new = _one_each(new, keys, order)
    return table.join(new.select(*keys), keys, "left_anti").select(table.columns).unionByName(new)


def upsert_fill(table: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """As upsert, but a value already there stays."""
    values = [c for c in table.columns if c not in keys]
    new = _one_each(new, keys, order).select(*keys, *(F.col(c).alias(f"_{c}") for c in values))
    return table.join(new, keys, "full_outer").select(*keys, *(F.coalesce(c, f"_{c}").alias(c) for c in values))


def replace_snapshot(table: DataFrame, new: DataFrame, *keys: list[str]) -> DataFrame:
    """Drop what shares any of the key lists with ``new``, then add ``new``."""
    for key in keys:
        table = _null_safe(table, new, key, "left_anti")
    return table.unionByName(new)


def reconcile(existing: DataFrame, desired: DataFrame, key: str) -> DataFrame:
    """key, side: ``stale`` (only in existing) or ``missing`` (only in desired)."""
    e, d = existing.select(key).distinct(), desired.select(key).distinct()
    return e.join(d, key, "left_anti").withColumn("side", F.lit("stale")).unionByName(d.join(e, key, "left_anti").withColumn("side", F.lit("missing")))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once; nulls are values."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def overlap_violations(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Ranges that reach into the next one of their key."""
    nxt = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from", *order))
    return df.withColumn("next_from", nxt).filter("next_from < valid_to OR (valid_to IS NULL AND next_from IS NOT NULL)")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows that break a CHECK rule; null passes, as in SQL."""
    return df.filter(~F.coalesce(rule, F.lit(True)))


def require_none(df: DataFrame, what: str) -> None:
    """Refuse to go on if ``df`` has a row."""
    bad = df.take(1)
    if bad:
        raise ValueError(f"{what}: {bad[0].asDict()}")


def survivors(df: DataFrame, identity: list[str], row_id: str) -> DataFrame:
    """row_id, keep_id: the smallest id of each identity, nulls being values.

    Identities are aggregated and joined back, so a much-repeated one needn't fit in a task.
    """
    keep = df.groupBy(*(F.col(k).alias(f"_{k}") for k in identity)).agg(F.min(row_id).alias("keep_id"))
    return df.join(keep, _same(identity)).select(row_id, "keep_id")


def repoint(df: DataFrame, mapping: DataFrame, column: str, row_id: str) -> DataFrame:
    """``column`` rewritten by a survivors mapping."""
    mapping = mapping.select(F.col(row_id).alias("_old"), F.col("keep_id").alias("_new"))
    return df.join(mapping, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def conflicts(df: DataFrame, identity: list[str], metadata: list[str]) -> DataFrame:
    """Identities that carry different metadata."""
    return df.groupBy(*identity).agg(F.countDistinct(F.struct(*metadata)).alias("variants")).filter("variants > 1")
