"""Dated ranks from ordered evidence.

Without predecessor instructions a list is its members' latest observations since
the last full roster, so ranks are window functions. With them every observation is an entry of a tree:
it hangs below the entry that it was put behind, else below the root. Entries that
are put behind the same one stand the later the nearer, those put last stand in the order of their coming, and
what hangs below an entry stands right behind it. So the whole list, with all entries that have left it since, is the tree in
the order of its paths, and the paths are found by doubling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settled
from .spread import carried, numbered


def rank_by_latest(observations: DataFrame, scope: list[str], member: str, order: list[str]) -> DataFrame:
    """Each member's latest observation counts; ``rank`` numbers the members of a scope by it.

    Members without an id keep their place but no name: ``unresolved_before`` counts
    them. Departed members don't renumber those after them.
    """
    latest = Window.partitionBy(*scope, member).orderBy(*(F.col(c).desc() for c in order))
    placed = observations.withColumn("_n", F.row_number().over(latest)).filter((F.col("_n") == 1) | F.col(member).isNull()).drop("_n")
    w = Window.partitionBy(*scope).orderBy(*order)
    unknown = F.sum(F.when(F.col(member).isNull(), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumns({"rank": F.row_number().over(w), "unresolved_before": unknown})


def _paths(entries: DataFrame, scope: list[str]) -> DataFrame:
    """``entries`` (scope, position, parent) with ``path``: arrays whose order is that of the list.

    In each round every entry takes over the path of the entry that its path begins below: the rounds are the logarithm of the deepest chain.
    """
    label = F.when(F.col("parent").isNull(), F.col("position")).otherwise(-F.col("position"))
    rows = settled(entries.select(*scope, "position", F.col("parent").alias("above"), F.array(label).alias("path")), "anchors")
    while not rows.filter("above IS NOT NULL").isEmpty():
        upper = rows.select(*scope, F.col("position").alias("above"), F.col("above").alias("_above"), F.col("path").alias("_path"))
        rows = rows.join(upper, [*scope, "above"], "left")
        whole = F.when(F.col("_path").isNull(), F.col("path")).otherwise(F.concat("_path", "path"))
        rows = settled(rows.select(*scope, "position", F.col("_above").alias("above"), whole.alias("path")), "anchors")
    return rows.drop("above")


def replay_anchored(observations: DataFrame, scope: list[str]) -> DataFrame:
    """scope and (seq, member): the list after all observations, ``after`` naming a predecessor.

    Columns: scope, position (order of the evidence, unique within the scope), member, after, full_roster.
    A row with full_roster empties the list first; a member is taken out wherever it stands, then put behind its
    predecessor if that is listed, else last. A member without an id stays where it was put. A list is never
    held as one group; its entries take a path as long as the chain of predecessors above them.
    """
    rows = observations.select(*scope, F.col("position").cast("long").alias("position"), "member", "after", F.coalesce("full_roster", F.lit(False)).alias("full_roster"))
    rows = carried(rows, scope, ["position"], {"era": F.when(F.col("full_roster"), F.col("position"))})
    rows = rows.withColumn("era", F.coalesce("era", F.lit(-(2**63))))
    # who is looked up stands among the observations of that member, as does the member's own next one
    own = rows.select(*scope, "era", "position", F.col("member").alias("who"), F.lit(True).alias("seen"))
    asked = rows.filter("after IS NOT NULL AND NOT after <=> member").select(*scope, "era", "position", F.col("after").alias("who"), F.lit(False).alias("seen"))
    order = Window.partitionBy(*scope, "era", "who").orderBy("position")
    met = own.filter("who IS NOT NULL").unionByName(asked)
    met = met.withColumns({"parent": F.last(F.when(F.col("seen"), F.col("position")), True).over(order.rowsBetween(Window.unboundedPreceding, -1)), "later": F.max(F.when(F.col("seen"), F.col("position"))).over(order.rowsBetween(1, Window.unboundedFollowing))})
    parents = met.filter(~F.col("seen")).select(*scope, "position", "parent")
    last_era = rows.groupBy(*scope).agg(F.max("era").alias("era"))
    now = rows.join(last_era, [*scope, "era"])
    placed = _paths(now.select(*scope, "position").join(parents, [*scope, "position"], "left"), scope)
    gone = met.filter("seen AND later IS NOT NULL").select(*scope, "position")
    listed = now.select(*scope, "position", "member").join(gone, [*scope, "position"], "left_anti").join(placed, [*scope, "position"])
    return numbered(listed, scope, ["path"], "seq").select(*scope, "seq", "member")
