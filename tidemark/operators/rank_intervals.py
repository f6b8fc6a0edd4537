"""Dated ranks of list members, replayed from ordered evidence.

A scope (one body in one period) keeps a list for each party. Evidence comes in blocks;
a full roster empties its party's list first. A named member leaves every list and is
put behind the one it is said to rank after, else last. Departed members keep their
place, so nobody below them is renumbered. Between two boundaries ranks stand still.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .islands import merge_adjacent

#: Inserted entries are linked, so that putting one behind another costs the same anywhere.
PLACES = "member string, party int, observation string, basis string, rank int, unresolved_before int, since date"
ORDER = ["day", "number", "block", "ordinal", "observation"]


class LinkedList:
    """A linked list of entries with an index by member and by plain name."""

    def __init__(self):
        self.head: dict = {"next": None}
        self.tail = self.head
        self.by_member, self.by_name = {}, {}

    def drop(self, member) -> None:
        entry = self.by_member.pop(member, None)
        if entry is not None:
            entry["prev"]["next"] = entry["next"]
            if entry["next"] is None:
                self.tail = entry["prev"]
            else:
                entry["next"]["prev"] = entry["prev"]
            entry["gone"] = True

    def put(self, entry: dict, after: dict | None) -> None:
        prev = after or self.tail
        entry.update(prev=prev, next=prev["next"], gone=False)
        prev["next"] = entry
        if entry["next"] is None:
            self.tail = entry
        else:
            entry["next"]["prev"] = entry
        if entry["member"] is not None:
            self.by_member[entry["member"]] = entry
        if entry["name"]:
            self.by_name.setdefault(entry["name"], []).append(entry)

    def anchor(self, member, name) -> dict | None:
        found = self.by_member.get(member) if member is not None else None
        if found is None and name:
            named = [e for e in self.by_name.get(name, ()) if not e["gone"]]
            if len(named) > 1:  # the one that stands first
                named = [e for e in self if any(e is n for n in named)]
            found = named[0] if named else None
        return found

    def __iter__(self):
        entry = self.head["next"]
        while entry is not None:
            yield entry
            entry = entry["next"]


def _text(value):
    return value if isinstance(value, str) and value else None


def _replay(rows):
    """(party, entry, rank, unresolved, day) of every list that a day's evidence touched, once a day."""
    lists: dict[int, LinkedList] = {}
    last, touched = None, set()

    def shown(day):
        for party in sorted(touched):
            unresolved = 0
            for rank, entry in enumerate(lists[party], 1):
                unresolved += entry["member"] is None
                yield party, entry, rank, unresolved, day
        touched.clear()

    begun = None
    for row in rows:
        if last is not None and row["day"] != last:
            yield from shown(last)
        last = row["day"]
        if (row["day"], row["number"], row["block"]) != begun:
            begun = (row["day"], row["number"], row["block"])
            for party in row["rosters"]:
                lists[int(party)] = LinkedList()
                touched.add(int(party))
        if row["party"] is None:
            continue
        party, member = int(row["party"]), _text(row["member"])
        for other, held in lists.items():
            if member in held.by_member:
                held.drop(member)
                touched.add(other)
        mine = lists.setdefault(party, LinkedList())
        after, after_name = _text(row["after"]), _text(row["after_key"])
        entry = {"member": member, "name": row["name_key"], "observation": row["observation"], "basis": "relative_instruction" if after or after_name else "resolution_order"}
        mine.put(entry, mine.anchor(after, after_name))
        touched.add(party)
    if last is not None:
        yield from shown(last)


def list_states(observations: DataFrame, scope: list[str]) -> DataFrame:
    """scope, party, member, rank, unresolved_before, basis, observation, since, until: what each list says from day to day.

    ``observations``: scope, day, number (null last), block, ordinal, observation, member (null: not
    resolved), raw, party, after, after_raw, full_roster. Scopes replay in parallel; one scope's
    evidence is one task, as each step rests on the list before it.
    """
    key = lambda c: F.regexp_replace(F.lower(F.coalesce(F.col(c), F.lit(""))), "[^a-z0-9]+", "")
    block = Window.partitionBy(*scope, "day", "number", "block")
    rows = observations.withColumns({"name_key": key("raw"), "after_key": key("after_raw"), "number": F.coalesce("number", F.lit(10**9))})
    rows = rows.withColumn("rosters", F.collect_set(F.when(F.col("full_roster"), F.col("party"))).over(block))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in observations.select(*scope).schema) + ", " + PLACES

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(ORDER, kind="stable")
        records = pdf[[*ORDER, "member", "party", "after", "after_key", "name_key", "rosters"]].astype({"party": "object"}).to_dict("records")
        for r in records:
            r["party"] = None if pd.isna(r["party"]) else r["party"]
        out = [(e["member"], party, e["observation"], e["basis"], rank, unresolved, day) for party, e, rank, unresolved, day in _replay(records)]
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in PLACES.split(", ")])
        for i, c in enumerate(scope):
            frame.insert(i, c, pdf[c].iloc[0])
        return frame

    states = rows.groupBy(*scope).applyInPandas(run, schema)
    # a list stands until the next day on which it was touched
    days = states.select(*scope, "party", "since").distinct()
    emptied = rows.select(*scope, F.explode("rosters").alias("party"), F.col("day").alias("since")).union(rows.select(*scope, "party", F.col("day").alias("since"))).filter("party IS NOT NULL").distinct()
    nxt = F.lead("since").over(Window.partitionBy(*scope, "party").orderBy("since"))
    spans = days.unionByName(emptied).distinct().withColumn("until", nxt)
    return states.join(spans, [*scope, "party", "since"])


def rank_intervals(memberships: DataFrame, parties: DataFrame, observations: DataFrame, scope: list[str]) -> DataFrame:
    """membership, member, party, rank, unresolved_before, basis, observation, valid_from, valid_to.

    ``memberships``: scope, membership, member, valid_from, valid_to; ``parties``: scope, member,
    party, valid_from, valid_to (where ranges overlap, the one that starts first counts). A member has a
    rank while it sits, is listed, and its party in force is the list's. Adjacent equal rows are one.
    """
    first = Window.partitionBy(*scope, "member").orderBy("valid_from", "valid_to", "party").rowsBetween(Window.unboundedPreceding, -1)
    parties = parties.withColumn("taken", F.max("valid_to").over(first))
    parties = parties.withColumn("valid_from", F.greatest("valid_from", F.coalesce("taken", "valid_from"))).filter("valid_from < valid_to").drop("taken")
    states = list_states(observations, scope).filter("member IS NOT NULL")
    sits = memberships.select(*scope, "membership", "member", F.col("valid_from").alias("sits_from"), F.col("valid_to").alias("sits_to"))
    sided = parties.select(*scope, "member", "party", F.col("valid_from").alias("side_from"), F.col("valid_to").alias("side_to"))
    met = states.join(sits, [*scope, "member"]).join(sided, [*scope, "member", "party"])
    met = met.withColumns({"valid_from": F.greatest("since", "sits_from", "side_from"), "valid_to": F.least("sits_to", "side_to", "until")})
    met = met.filter("valid_from < valid_to").select("membership", "member", "party", "rank", "unresolved_before", "basis", "observation", "valid_from", "valid_to")
    return merge_adjacent(met, ["membership"], ["member", "party", "rank", "unresolved_before", "basis", "observation"])
