"""Ranked slots of member lists and departures of proceedings, over texts made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clauses as cl
from ..functions import departures as dp
from ..functions import slots as sl
from ..sources.tables import table


def member_slots(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    text = F.concat(F.lit("Mr. "), "c_name", F.lit(", to rank immediately after Mrs. "), "c_mktsegment", F.lit("; Mr. "), "c_mktsegment", F.lit(", after Ms. Roe; and Ms. "), "c_name", F.lit(" (when sworn)."))
    rows = c.select("c_custkey", F.posexplode(sl.member_slots(text)).alias("pos", "slot"))
    return rows.select("c_custkey", (F.col("pos") + 1).alias("ordinal"), "slot.name", "slot.rank_after")


def prose_removals(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    text = F.concat(F.lit("Mr. "), "c_name", F.when(F.col("c_custkey") % 3 > 0, " be, and is hereby, removed from the Committee on Rules and the Committee on the Budget.").otherwise(" be thanked."))
    return c.select("c_custkey", sl.removed_member(text).alias("member"), F.array_join(sl.removed_bodies(text), "/").alias("bodies"))


def departures(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 700).cast("int")).alias("day"))
    house = F.concat(
        F.lit("The Speaker laid before the House the following resignation from the House of Representatives: Washington, DC, January 2, 2019.\nI resign, effective at the end of "),
        F.date_format("day", "MMMM d, yyyy"), F.lit(".\nSincerely,\n"), "c_name", F.lit(",\nMember of Congress.\n"),
    )
    senate = F.concat(F.lit("until the vacancy therein caused by the resignation of Senator "), "c_name", F.lit(" of New Mexico is filled"))
    speaker = F.concat(F.lit("the Honorable "), "c_name", F.lit(" of the State of Ohio, having received a majority of the votes cast, is duly elected Speaker of the House"))
    moved = F.concat(F.lit("I, "), "c_name", F.lit(", request to be relieved from the Committee on Rules and appointed to the Committee on the Budget. "), F.date_format("day", "MMMM d, yyyy"))
    branch = F.col("c_custkey") % 6
    text = F.when(branch == 0, house).when(branch == 1, senate).when(branch == 2, speaker).when(branch == 3, moved).when(branch == 4, "The Chair appoints three members to the committee.")
    return c.select("c_custkey", *(v.alias(k) for k, v in dp.departure_columns(text, F.lit("2018-05-06").cast("date")).items()))


#: Sentences put into documents; {a}, {b} and {c} are surnames made of the document's own words. The second half are traps.
SENTENCES = [
    "The Speaker appoints Mr. {a} and Mrs. {b} to the Committee on Sails, vice Mrs. {c}.",
    "The Chair appointed the following Members to the Committee on Oars and the Committee on Nets: Mr. {a}, Ms. {b} of New York, and Mr. {c}.",
    "Mr. {a} was appointed to the Committees on Tides and Winds.",
    "The Chair, Mr. {c}, appoints Mr. {a} to the Committee on Oars and Ms. {b} to the Committee on Sails during the session.",
    "The Chair appoints Ms. {a}, Jr., to the {b} Committee to fill the vacancy caused by the death of Mr. {c} of Ohio.",
    "The Speaker appoints to the Committee on Oars: Mr. {a}; to the Permanent Select Committee on Sails: Mr. {b} and Ms. {c}, Utah.",
    "It was referred to the Committee on Rules, vice President {a} presiding; Mr. {b} was disappointed.",
    "The appointment of Mr. {a} was praised. Mr. {b} of the Committee on Rules met Ms. {c}.",
]
#: What each sentence says: (sentence, place, action, name, body) with the same marks.
TOLD = [
    (0, 0, "APPOINTED", "{a}", "Committee on Sails"), (0, 1, "APPOINTED", "{b}", "Committee on Sails"), (0, 2, "REMOVED", "{c}", "Committee on Sails"),
    *((1, 2 * i + j, "APPOINTED", n, f"Committee on {b}") for i, n in enumerate(("{a}", "{b} of New York", "{c}")) for j, b in enumerate(("Oars", "Nets"))),
    (2, 0, "APPOINTED", "{a}", "Committee on Tides"), (2, 1, "APPOINTED", "{a}", "Committee on Winds"),
    (3, 0, "APPOINTED", "{a}", "Committee on Oars"), (3, 1, "APPOINTED", "{b}", "Committee on Sails"),
    (4, 0, "APPOINTED", "{a}, Jr.", "Committee on {b}"), (4, 1, "REMOVED", "{c} of Ohio", "Committee on {b}"),
    (5, 0, "APPOINTED", "{a}", "Committee on Oars"), (5, 1, "APPOINTED", "{b}", "Permanent Select Committee on Sails"), (5, 2, "APPOINTED", "{c}", "Permanent Select Committee on Sails"),
]


def _filled(pattern: str) -> str:
    """A pattern with marks as an SQL expression over the columns a, b and c."""
    parts = pattern.replace("'", "''")
    for mark in "abc":
        parts = parts.replace(f"{{{mark}}}", f"' || {mark} || '")
    return f"'{parts}'"


def appointment_events(spark, d):
    """Appointments out of every document's text, with one sentence put into its middle."""
    own = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[a-z]{5,9}"), F.lit(0))
    surname = lambda i: F.concat(F.lit("Q"), F.coalesce(F.get(own, F.lit(i)), F.lit(f"name{i}")))
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"), *(surname(i).alias(n) for i, n in enumerate("abc")))
    sentence = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN {_filled(p)}" for i, p in enumerate(SENTENCES)) + " END"
    half = "CAST(floor(char_length(t) / 2) AS INT)"
    docs = docs.select("doc_id", F.expr(f"concat(substring(t, 1, {half}), ' . ', {sentence}, ' ', substring(t, {half} + 1, char_length(t)))").alias("text"))
    item = lambda action, people, g: F.flatten(F.transform(people, lambda p: F.transform(g["bodies"], lambda b: F.struct(F.lit(action).alias("action"), cl.bare_name(p).alias("name"), b.alias("body")))))
    told = F.flatten(F.transform(cl.appointments(F.col("text")), lambda g: F.concat(item("APPOINTED", g["names"], g), item("REMOVED", g["replaced"], g))))
    return docs.select("doc_id", F.posexplode(told).alias("place", "e")).select("doc_id", "place", "e.*")


_Q = [member_slots, prose_removals, departures, appointment_events]
QUERIES = {f.__name__: f for f in _Q}

_OWN_SQL = "regexp_extract_all(coalesce(text, ''), '[a-z]{5,9}')"
_NAMES_SQL = ", ".join(f"'Q' || coalesce({_OWN_SQL}[{i + 1}], 'name{i}') AS {n}" for i, n in enumerate("abc"))
_TOLD_SQL = " UNION ALL ".join(f"SELECT doc_id, {place} AS place, '{action}' AS action, {_filled(name)} AS name, {_filled(body)} AS body FROM n WHERE doc_id % 8 = {i}" for i, place, action, name, body in TOLD)

_NO_DATE = "DATE '2018-05-06'"
SQL = {
    "appointment_events": f"WITH n AS (SELECT doc_id, {_NAMES_SQL} FROM documents) {_TOLD_SQL}",
    "member_slots": "SELECT c_custkey, 1 AS ordinal, 'Mr. ' || c_name AS name, 'Mrs. ' || c_mktsegment AS rank_after FROM customer UNION ALL SELECT c_custkey, 2, 'Mr. ' || c_mktsegment, 'Ms. Roe' FROM customer UNION ALL SELECT c_custkey, 3, 'Ms. ' || c_name, NULL FROM customer",
    "prose_removals": "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'Mr. ' || c_name END AS member, CASE WHEN c_custkey % 3 > 0 THEN 'Committee on Rules/Committee on the Budget' ELSE '' END AS bodies FROM customer",
    "departures": f"SELECT c_custkey, ['house resignation', 'senate exit', 'speaker', 'transfer', 'appointment', 'other'][c_custkey % 6 + 1] AS kind, CASE WHEN c_custkey % 6 < 4 THEN c_name END AS member, CASE WHEN c_custkey % 6 = 3 THEN 'Committee on Rules' END AS from_body, CASE WHEN c_custkey % 6 = 3 THEN 'Committee on the Budget' END AS to_body, CASE c_custkey % 6 WHEN 0 THEN DATE '2020-01-01' + CAST(c_custkey % 700 AS INTEGER) WHEN 3 THEN DATE '2020-01-01' + CAST(c_custkey % 700 AS INTEGER) WHEN 1 THEN {_NO_DATE} WHEN 2 THEN {_NO_DATE} END AS effective FROM customer",
}
