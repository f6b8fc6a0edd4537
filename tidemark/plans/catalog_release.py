"""Directory cells, integrity, release datasets, manifests, page texts and picks, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pages as pg
from ..operators import directory as dr, integrity as ig, pick
from ..sources import manifest as mf
from ..sources.tables import table
from . import release as rl

_CELL = ["CAST(113 + c_nationkey % 3 AS INT) AS congress", "DATE '2024-01-01' AS day", "CASE WHEN c_custkey % 2 = 0 THEN 'H' ELSE 'S' END AS chamber", "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'joint' ELSE 'standing' END AS scope"]


def _orders(spark, d):
    return table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def _entries(spark, d):
    return table(spark, d, "customer").filter("c_custkey % 6 > 0").selectExpr(
        *_CELL, "c_mktsegment AS body", "CASE WHEN c_mktsegment <> 'BUILDING' OR c_nationkey % 3 > 0 THEN 'C' || substring(c_mktsegment, 1, 2) END AS code", "CASE WHEN c_custkey % 13 > 0 THEN 'm' || c_custkey % 97 END AS member"
    )


def _observed(spark, d):
    return table(spark, d, "customer").filter("c_custkey % 5 > 0").selectExpr(*_CELL, "'C' || substring(c_mktsegment, 1, 2) AS code", "'m' || c_custkey % 97 AS member")


def directory_cells(spark, d):
    return dr.directory_cells(_entries(spark, d), _observed(spark, d), 0.6, 0.7)


def directory_mismatches(spark, d):
    return dr.mismatches(_entries(spark, d), _observed(spark, d))


_NAMES = ["Committee on Oars", "Select Committee on Tides", "Joint Committee on Sails", "Harbour Commission", "Moor Policy Committee", "A task force on fog", "Committee on Specials", "Board of Wrecks"]


def body_scopes(spark, d):
    name = F.get(F.array(*map(F.lit, _NAMES)), (F.col("c_custkey") % 8).cast("int"))
    code = F.get(F.array(*map(F.lit, ["HSAG", "HLIG", "JSPR", "SSFR", "HSZS"])), (F.col("c_custkey") % 5).cast("int"))
    chamber = F.when(F.col("c_custkey") % 3 == 0, "Joint").when(F.col("c_custkey") % 3 == 1, "House")
    return table(spark, d, "customer").select(
        "c_custkey", dr.body_scope(chamber, name, code).alias("scope"), dr.out_of_scope(name).alias("untracked"), dr.is_standing(F.lit("H"), code, name, F.col("c_custkey") % 7 == 0).alias("standing")
    )


def membership_issues(spark, d):
    o = _orders(spark, d)
    m = o.selectExpr(
        "o_orderkey AS membership", "o_custkey AS member", "CASE WHEN o_orderkey % 2 = 0 THEN 'HSAG' ELSE 'HSBA' END AS code", "o_orderdate AS valid_from", "CASE WHEN o_orderkey % 3 > 0 THEN date_add(o_orderdate, CAST(o_orderkey % 17 AS INT)) END AS valid_to",
        "CASE WHEN o_orderkey % 19 > 0 THEN 's' || o_orderkey END AS start_event", "CASE WHEN o_orderkey % 3 > 0 THEN 'e' || o_orderkey END AS end_event",
    )
    start = o.selectExpr(
        "'s' || o_orderkey AS event", "'H' AS chamber", "CASE WHEN o_orderkey % 7 = 0 THEN 'REMOVED' ELSE 'APPOINTED' END AS action", "CASE WHEN o_orderkey % 11 > 0 THEN o_custkey ELSE o_custkey + 1 END AS member",
        "CASE WHEN o_orderkey % 4 < 2 THEN 'HSAG' ELSE 'HSBA' END AS code", "date_add(o_orderdate, CAST(o_orderkey % 10 = 0 AS INT)) AS decision_day", "o_orderdate AS effective_day",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'elected to the Committee on the Oars; and to the committee of tides.' WHEN o_orderkey % 5 = 1 THEN 'to the Committee on Banks - Mr. X' WHEN o_orderkey % 5 = 2 THEN 'no body' END AS span", "CASE WHEN o_orderkey % 8 = 0 THEN 'journal' END AS mode",
    )
    end = o.selectExpr("'e' || o_orderkey AS event", "'H' AS chamber", "CASE WHEN o_orderkey % 13 > 0 THEN 'REMOVED' END AS action", "o_custkey AS member", "'HSAG' AS code", "o_orderdate AS decision_day", "date_add(o_orderdate, CAST(o_orderkey % 17 AS INT) + CAST(o_orderkey % 9 = 0 AS INT)) AS effective_day", "CAST(NULL AS STRING) AS span", "CAST(NULL AS STRING) AS mode")
    events = start.unionByName(end)
    names = spark.createDataFrame([("H", "oars", "HSAG"), ("H", "banks", "HSBA"), ("H", "tides", "HSTI")], "chamber string, key string, code string")
    return ig.membership_issues(m, events, ig.span_codes(events, names))


def _assignments(spark, d):
    o = _orders(spark, d).selectExpr(
        "CAST(113 + o_orderkey % 6 AS INT) AS congress_no", "'H' AS chamber", "'m' || o_custkey AS member", "'C' || o_orderpriority AS committee_code", "o_orderdate AS start_date",
        "CASE WHEN o_orderkey % 3 = 0 THEN date_add(o_orderdate, 30) END AS effective", "CASE WHEN o_orderkey % 2 = 0 THEN date_add(o_orderdate, 60) END AS upper", "DATE '1999-01-03' AS period_end", "'ev-' || o_orderkey AS start_release_event_id",
    )
    return rl.project(o.withColumns(rl.boundary(F.col("effective"), F.col("upper"), F.col("period_end"))), "assignments", "v1")


def release_assignments(spark, d):
    return _assignments(spark, d)


def release_hash(spark, d):
    return rl.semantic_hash(_assignments(spark, d), "assignments")


def release_committees(spark, d):
    n = table(spark, d, "nation").selectExpr("'N' || n_nationkey AS committee_code", "n_name AS committee_name", "make_date(2000 + CAST(n_nationkey AS INT), 1, 3) AS start_date", "CAST(NULL AS DATE) AS last_active_date")
    return rl.project(n, "committees", "v1").select(rl.rendered(rl.project(n, "committees", "v1"), "committees").alias("line"))


def data_dictionary(spark, d):
    return rl.dictionary(spark).filter("dataset = 'members'")


def utc_texts(spark, d):
    return table(spark, d, "events").select("event_id", rl.utc_text(F.col("ts")).alias("at"))


_TITLES = ["Resignations as a Member of the Committee on Oars", "RESIGNATION FROM  THE HOUSE of Representatives", "Election of Members to certain standing Committees", "Electing Member to a committee", "The passing of a friend", "Election of Speaker", "Resignation as Chairman", "Fog", "Electing certain members to the Committees", "Removing a Member from the committee on oars", "To constitute the majority party's membership on certain committees", None]


def title_classes(spark, d):
    title = F.get(F.array(*map(F.lit, _TITLES)), (F.col("c_custkey") % 12).cast("int"))
    return table(spark, d, "customer").select("c_custkey", mf.title_class(title, mf.RECORD_TITLES).alias("record"), mf.title_class(title, mf.RESOLUTION_TITLES).alias("resolution"))


_PACKAGES = "CASE WHEN o_orderkey % 4 = 0 THEN 'CREC-' || o_orderkey ELSE 'BILLS-113' || CASE WHEN o_custkey % 2 = 0 THEN 'hres' ELSE 'SRES' END || o_custkey % 40 || 'v' || o_orderkey END"


def candidate_groups(spark, d):
    o = _orders(spark, d).selectExpr("o_orderkey", f"{_PACKAGES} AS package", "CASE WHEN o_orderkey % 31 = 0 OR o_custkey % 17 = 3 AND o_orderkey % 3 = 1 THEN 'committee_assignment' ELSE 'other' END AS candidate_class", "CASE o_orderkey % 5 WHEN 0 THEN 'daily_record' WHEN 1 THEN 'house_resolution' WHEN 2 THEN NULL ELSE 'senate_resolution' END AS expected_type")
    return mf.propagate_candidates(o)


def citations(spark, d):
    c = table(spark, d, "customer")
    cite = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'H. Res. ' || c_custkey WHEN 1 THEN 's.res' || c_custkey || '?' WHEN 2 THEN 'H. RES.' END")
    granule = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'x-PgH12' WHEN 1 THEN 'x-PgS9-2' WHEN 2 THEN 'x-PgE1' END")
    kind = F.expr("CASE WHEN c_custkey % 3 = 0 THEN 'Senate page' END")
    return c.select("c_custkey", mf.resolution_number(cite).alias("number"), mf.granule_chamber(kind, granule).alias("chamber"))


def source_categories(spark, d):
    o = _orders(spark, d).selectExpr("o_orderkey", "o_orderpriority", "CASE WHEN o_orderkey % 5 = 0 THEN ' Member_Death' END AS c")
    return o.select("o_orderkey", mf.category(F.col("o_orderpriority"), F.col("c"), ["1-urgent"], ["2-high", "3-medium"], ["5-low"], ["member_death"]).alias("category"))


def retrieval_state(spark, d):
    rows = _orders(spark, d).selectExpr("o_orderkey", "'p' || o_orderkey AS path", "CASE WHEN o_orderkey % 5 > 0 THEN sha2(CAST(o_orderkey AS STRING), 256) END AS sha256", "o_orderkey % 100 AS size")
    files = _orders(spark, d).filter("o_orderkey % 7 > 0").selectExpr("'p' || o_orderkey AS path", "sha2(CAST(o_orderkey + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS STRING), 256) AS sha256", "o_orderkey % 100 + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS size")
    return mf.retrieval_state(rows, files).select("o_orderkey", "status")


def manifest_rows(spark, d):
    found = _orders(spark, d).selectExpr("o_orderpriority AS collection", "'p' || o_custkey AS package", "'g' || o_orderkey % 3 AS granule", "o_orderdate AS modified")
    specs = spark.createDataFrame([("1-URGENT",), ("9-NONE",)], "collection string")
    return mf.manifest(found, specs)


#: Forms of members and bodies, {n} being a customer's own surname, with the verdict on each.
MEMBER_FORMS = [
    ("Mr. {n} of New York", None), ("Ms. {n}", None), ("mrs. {n}-Elm of Ohio", None), ("Ms. O'{n}", None),
    ("Mr. Speaker", "member_stopword"), ("Mr. Clerk, {n}", "member_stopword"), ("{n}", "member_regex_fail"), ("Mr. {n} 12", "member_regex_fail"),
    ("Mr. {n} of", "member_regex_fail"), ("Miss {n}", "member_regex_fail"), ("", "member_regex_fail"), ("Mr. J. {n}", "member_regex_fail"),
]
BODY_FORMS = [
    ("Committee on {n}", None), ("the Committee on the Resolution Trust and {n}", None), ("Permanent Select Committee on {n}", None), ("COMMITTEE ON BILLINGS AND ORDERS OF {n}", None),
    ("{n} Committee", "committee_no_required_phrase"), ("{n}", "committee_no_required_phrase"), ("", "committee_no_required_phrase"),
    ("Committee on {n}, AYES 12", "committee_has_bill_tokens"), ("Committee on {n} S. 12", "committee_has_bill_tokens"), ("A bill of the Committee on {n}", "committee_has_bill_tokens"),
    ("Committee on {n} rule 10", "committee_has_bill_tokens"), ("Committee on H.R. 7 {n}", "committee_has_bill_tokens"), ("Committee on {n} and so on until the name is longer than any name of a body of this kind could be, whatever may stand there, or not", "committee_too_long"),
]
_SURNAME = "concat(upper(substring(c_mktsegment, 1, 1)), lower(substring(c_mktsegment, 2, {})))"


def page_gates(spark, d):
    pick_ = lambda forms, by: F.get(F.array(*(F.lit(f) for f, _ in forms)), (by % len(forms)).cast("int"))
    cut = "CAST(c_nationkey % 5 AS INT)"
    n = F.expr(_SURNAME.format(f"3 + {cut}"))
    # 'House' is a stopword, as the gate rightly says, and no surname: such a customer's has a letter more
    n = F.when(F.lower(n).isin(pg.NO_NAMES), F.expr(_SURNAME.format(f"4 + {cut}"))).otherwise(n)
    c = table(spark, d, "customer").withColumn("n", n)
    body, member = (F.replace(pick_(forms, by), F.lit("{n}"), F.col("n")) for forms, by in ((BODY_FORMS, F.col("c_custkey")), (MEMBER_FORMS, F.floor(F.col("c_custkey") / len(BODY_FORMS)))))
    senate = F.concat(body, F.when(F.col("c_nationkey") % 2 == 0, " H. R. 5").otherwise(""))
    return c.select("c_custkey", pg.gate(body, member).alias("reason"), pg.gate(senate, F.lit("Ms. Low"), chamber="S").alias("senate_reason"))


#: Scanned wordings and what they are when mended.
SCANNED = [
    ("Mr.McConnell met Ms.{n}", "Mr. McConnell met Ms. {n}"), ("Mr. {n}of Oregon,Mr. DeFazioof Ohio", "Mr. {n} of Oregon, Mr. DeFazio of Ohio"), ("Mr. MIL- LER and the com-\nmittee of {n}", "Mr. MILLER and the committee of {n}"),
    ("{n}andAshElm", "{n} and AshElm"), ("COMMITTEEELECTION of {n}", "COMMITTEE ELECTION of {n}"), ("PERMANENTSELECTCOMMITTEEON{n}", "PERMANENT SELECT COMMITTEE ON {n}"), ("a  well-known {n},\nand sand of the land", "a well-known {n}, and sand of the land"),
]


def page_texts(spark, d):
    day = F.expr("date_add(DATE '2020-01-01', CAST(c_custkey % 700 AS INT))")
    text = F.concat(F.expr("CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS STRING) || '\n' ELSE '' END"), F.lit("THE JOURNAL of "), F.when(F.col("c_custkey") % 2 == 0, F.date_format(day, "MMMM d, yyyy")).otherwise(F.date_format(day, "MMMM d")), F.lit(".\r\nMr.Poe,MrsLow S. Res. 12, on Fog\rend"))
    clean = pg.clean(text)
    scanned = F.replace(F.get(F.array(*(F.lit(s) for s, _ in SCANNED)), (F.col("c_custkey") % len(SCANNED)).cast("int")), F.lit("{n}"), F.expr(_SURNAME.format("6")))
    return table(spark, d, "customer").select(
        "c_custkey", pg.page_day(clean, F.lit(2021)).alias("day"), pg.printed_page(clean).alias("page"), F.length(clean).alias("n"), pg.span_from(clean, r"S\. Res\. \d+", 11, 7).alias("span"),
        pg.apart(scanned).alias("spaced"), pg.not_before(F.lit("2020-06-01").cast("date"), F.when(F.col("c_custkey") % 5 > 0, day)).alias("effective"),
    )


def roster_signals(spark, d):
    text = F.get(F.array(*map(F.lit, ["That they Constituted the majority  party", "reconstitutes minority membership", "constitution of the minority", "appoints"])), (F.col("c_custkey") % 5).cast("int"))
    return table(spark, d, "customer").select("c_custkey", pg.full_roster(text).alias("roster"), pg.of_one_side(text).alias("one_side"))


def newest_copy(spark, d):
    o = _orders(spark, d).selectExpr("o_custkey", "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 4 END AS district", "o_orderdate", "o_orderkey")
    return pick.newest_copy(o, [F.col("o_custkey"), F.coalesce("district", F.lit(-1))], ["o_orderdate", "o_orderkey"])


def preferred_copy(spark, d):
    o = _orders(spark, d).selectExpr("o_custkey", "o_orderkey", "CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 3 = 0 END AS same_hash")
    return pick.prefer(o, ["o_custkey"], F.col("same_hash"), ["o_orderkey"]).select("o_custkey", "o_orderkey")


def ordinal_pairs(spark, d):
    o = _orders(spark, d)
    left = o.selectExpr("o_custkey", "o_orderkey AS k", "o_orderkey AS first")
    right = o.filter("o_orderkey % 2 = 0").selectExpr("o_custkey", "-o_orderkey AS k", "o_orderkey AS second")
    return pick.pair_ordinals(left, right, ["o_custkey"], ["k"]).select("o_custkey", "ordinal", "first", "second")


def first_of_run(spark, d):
    o = _orders(spark, d).select("o_custkey", "o_orderpriority", "o_orderkey")
    return pick.drop_repeats(o, ["o_custkey"], ["o_orderkey"], ["o_orderpriority"])


def repaired_dates(spark, d):
    o = _orders(spark, d)
    repairs = o.filter("o_orderkey % 3 = 0").selectExpr("o_orderkey", "date_add(o_orderdate, CAST(o_orderkey % 5 AS INT) - 2) AS o_orderdate")
    return pick.repair(o.select("o_orderkey", "o_orderdate"), repairs, ["o_orderkey"], "o_orderdate", F.col("new") > F.col("old"))


def regrouped_children(spark, d):
    mapping = table(spark, d, "customer").filter("c_custkey % 4 = 0").selectExpr("c_custkey AS o_custkey", "c_custkey - 1 AS keep")
    return pick.regroup(_orders(spark, d), mapping, "o_custkey", [F.count("*").alias("n"), F.min("o_orderkey").alias("first")])


_Q = [
    directory_cells, directory_mismatches, body_scopes, membership_issues, release_assignments, release_hash, release_committees, data_dictionary, utc_texts, title_classes, candidate_groups, citations,
    source_categories, retrieval_state, manifest_rows, page_gates, page_texts, roster_signals, newest_copy, preferred_copy, ordinal_pairs, first_of_run, repaired_dates, regrouped_children,
]
QUERIES = {f.__name__: f for f in _Q}

_CELL_SQL = "113 + c_nationkey % 3 AS congress, DATE '2024-01-01' AS day, CASE WHEN c_custkey % 2 = 0 THEN 'H' ELSE 'S' END AS chamber, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'joint' ELSE 'standing' END AS scope"
_SIDES = f"""
WITH e AS (
  SELECT {_CELL_SQL}, c_mktsegment AS body, CASE WHEN c_mktsegment <> 'BUILDING' OR c_nationkey % 3 > 0 THEN 'C' || substr(c_mktsegment, 1, 2) END AS code, CASE WHEN c_custkey % 13 > 0 THEN 'm' || c_custkey % 97 END AS member
  FROM customer WHERE c_custkey % 6 > 0
), o AS (SELECT DISTINCT {_CELL_SQL}, 'C' || substr(c_mktsegment, 1, 2) AS code, 'm' || c_custkey % 97 AS member FROM customer WHERE c_custkey % 5 > 0),
r AS (SELECT congress, day, chamber, scope, code, member, min(body) AS body FROM e WHERE code IS NOT NULL AND member IS NOT NULL GROUP BY ALL)"""
_ASSIGNED = "coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + 30 END, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + 60 END, DATE '1999-01-03')"
_NAMES_SQL = "[" + ", ".join(f"'{n.lower()}'" for n in _NAMES) + "]"
_TITLES_SQL = "[" + ", ".join("NULL" if t is None else "'" + t.replace("'", "''") + "'" for t in _TITLES) + "]"
_reasons = lambda forms: "[" + ", ".join("NULL" if r is None else f"'{r}'" for _, r in forms) + "]"
_mended = "[" + ", ".join("'" + m.replace("'", "''") + "'" for _, m in SCANNED) + "]"
SQL = {
    "directory_cells": _SIDES + """,
a AS (SELECT congress, day, chamber, scope, count(*) AS entries, count(*) FILTER (code IS NOT NULL AND member IS NULL) AS unresolved_entries, count(*) FILTER (code IS NULL) AS unmapped_entries, count(DISTINCT body) FILTER (code IS NULL) AS unmapped_bodies FROM e GROUP BY ALL),
b AS (SELECT congress, day, chamber, scope, count(*) AS resolved FROM r GROUP BY ALL), c AS (SELECT congress, day, chamber, scope, count(*) AS observed FROM o GROUP BY ALL),
x AS (SELECT congress, day, chamber, scope, count(*) AS overlap FROM r JOIN o USING (congress, day, chamber, scope, code, member) GROUP BY ALL),
j AS (SELECT congress, day, chamber, scope, coalesce(entries, 0) AS entries, coalesce(unresolved_entries, 0) AS unresolved_entries, coalesce(unmapped_entries, 0) AS unmapped_entries, coalesce(unmapped_bodies, 0) AS unmapped_bodies, coalesce(resolved, 0) AS resolved, coalesce(observed, 0) AS observed, coalesce(overlap, 0) AS overlap
      FROM a FULL JOIN b USING (congress, day, chamber, scope) FULL JOIN c USING (congress, day, chamber, scope) LEFT JOIN x USING (congress, day, chamber, scope))
SELECT *, resolved - overlap AS directory_only, observed - overlap AS observed_only, CASE WHEN entries > unmapped_entries THEN round_even(resolved / (entries - unmapped_entries) * 100, 3) END AS resolution_pct,
       CASE WHEN entries > 0 THEN round_even(overlap / entries * 100, 3) END AS coverage_pct, CASE WHEN observed > 0 THEN round_even(overlap / observed * 100, 3) END AS observed_pct,
       CASE WHEN entries = 0 THEN 'NO_REFERENCE' WHEN overlap >= 0.6 * entries AND resolved >= 0.7 * (entries - unmapped_entries) AND unmapped_entries = 0 THEN 'PASS' ELSE 'FAIL' END AS gate_status FROM j""",
    "directory_mismatches": _SIDES + """
SELECT DISTINCT congress, day, chamber, scope, 'unmapped_committee' AS kind, body, CAST(NULL AS VARCHAR) AS code, CAST(NULL AS VARCHAR) AS member FROM e WHERE code IS NULL
UNION ALL SELECT congress, day, chamber, scope, 'unresolved_member', body, code, NULL FROM e WHERE code IS NOT NULL AND member IS NULL
UNION ALL SELECT congress, day, chamber, scope, 'directory_only', body, code, member FROM r ANTI JOIN o USING (congress, day, chamber, scope, code, member)
UNION ALL SELECT congress, day, chamber, scope, 'observed_only', NULL, code, member FROM o ANTI JOIN r USING (congress, day, chamber, scope, code, member)""",
    "body_scopes": f"""
WITH b AS (SELECT c_custkey, {_NAMES_SQL}[c_custkey % 8 + 1] AS n, ['HSAG', 'HLIG', 'JSPR', 'SSFR', 'HSZS'][c_custkey % 5 + 1] AS c FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 OR c = 'JSPR' THEN 'joint' WHEN c_custkey % 8 = 1 OR c IN ('HLIG', 'HSZS') THEN 'select_special' ELSE 'standing' END AS scope, c_custkey % 8 IN (1, 2, 3, 4, 5, 7) AS untracked,
       NOT (c_custkey % 7 = 0 OR c IN ('JSPR', 'HLIG', 'HSZS') OR c_custkey % 8 IN (1, 6)) AS standing FROM b""",
    "membership_issues": """
WITH m AS (
  SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'HSAG' ELSE 'HSBA' END AS code, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate + CAST(o_orderkey % 17 AS INTEGER) END AS valid_to, o_orderkey % 19 > 0 AS started, o_orderkey % 3 > 0 AS ended,
         CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'HSAG;HSTI' WHEN o_orderkey % 5 = 1 THEN 'HSBA' END AS named FROM orders
), i AS (
  SELECT *, started AND named IS NOT NULL AND NOT contains(named, code) AS told FROM m
), l AS (
  SELECT *, list_filter([
    CASE WHEN started AND o_orderkey % 7 = 0 THEN 'start_action_not_appointed' END, CASE WHEN started AND o_orderkey % 11 = 0 THEN 'start_event_member_mismatch' END,
    CASE WHEN started AND (o_orderkey % 4 < 2) <> (o_orderkey % 2 = 0) THEN 'start_event_committee_mismatch' END, CASE WHEN started AND o_orderkey % 10 = 0 THEN 'appointment_date_start_date_mismatch' END,
    CASE WHEN told THEN 'start_text_committee_mismatch' END, CASE WHEN ended AND o_orderkey % 13 = 0 THEN 'end_action_not_removed' END, CASE WHEN ended AND code <> 'HSAG' THEN 'end_event_committee_mismatch' END,
    CASE WHEN ended AND o_orderkey % 9 = 0 THEN 'termination_date_end_date_mismatch' END, CASE WHEN ended AND o_orderkey % 17 = 0 THEN 'empty_or_negative_interval' END], lambda x: x IS NOT NULL) AS issues FROM i
)
SELECT o_orderkey AS membership, o_custkey AS member, code, o_orderdate AS valid_from, valid_to, CASE WHEN started THEN 's' || o_orderkey END AS start_event, CASE WHEN ended THEN 'e' || o_orderkey END AS end_event,
       CASE WHEN told THEN named END AS span_codes, array_to_string(issues, ';') AS issues FROM l WHERE len(issues) > 0""",
    "release_assignments": f"""
SELECT 'v1' AS release_version, CAST(113 + o_orderkey % 6 AS INTEGER) AS congress_no, 'H' AS chamber, 'm' || o_custkey AS member, 'C' || o_orderpriority AS committee_code, o_orderdate AS start_date, {_ASSIGNED} - 1 AS last_active_date,
       {_ASSIGNED} AS termination_effective_date, {_ASSIGNED} < DATE '1999-01-03' AS ended_early, 'ev-' || o_orderkey AS start_release_event_id, CAST(NULL AS VARCHAR) AS end_release_event_id FROM orders""",
    "release_hash": f"""
WITH h AS (SELECT sha256(concat_ws(chr(9), 113 + o_orderkey % 6, 'H', 'm' || o_custkey, 'C' || o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), strftime({_ASSIGNED} - 1, '%Y-%m-%d'), strftime({_ASSIGNED}, '%Y-%m-%d'), CASE WHEN {_ASSIGNED} < DATE '1999-01-03' THEN 'true' ELSE 'false' END, 'ev-' || o_orderkey, '')) AS h FROM orders)
SELECT count(*) AS n_rows, sha256(concat_ws('/', {", ".join(f"CAST(sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4))})) AS hash FROM h""",
    "release_committees": "SELECT concat_ws(chr(9), 'N' || n_nationkey, '', n_name, (2000 + n_nationkey) || '-01-03', '') AS line FROM nation",
    "data_dictionary": "SELECT 'members' AS dataset, CAST(i AS INTEGER) AS ordinal, ['member', 'full_name', 'state', 'party'][i] AS \"column\", 'string' AS logical_type FROM range(1, 5) AS t(i)",
    "utc_texts": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events",
    "title_classes": f"""
WITH t AS (SELECT c_custkey, upper(regexp_replace(coalesce({_TITLES_SQL}[c_custkey % 12 + 1], ''), '\\s+', ' ', 'g')) AS t FROM customer)
SELECT c_custkey, CASE WHEN regexp_matches(t, 'RESIGNATIONS? AS (A )?MEMBER') THEN 'committee_removal' WHEN regexp_matches(t, 'RESIGNATION FROM THE (HOUSE|SENATE)') THEN 'chamber_exit'
         WHEN regexp_matches(t, '(APPOINTMENT OF|ELECTION OF|ELECTING) MEMBERS? TO .+COMMITTEE') THEN 'committee_appointment' WHEN regexp_matches(t, '(DEATH|PASSING) OF') THEN 'member_death' WHEN contains(t, 'ELECTION OF SPEAKER') THEN 'speaker_election'
         WHEN contains(t, 'RESIGNATION AS CHAIR') THEN 'role_change_only' ELSE 'other' END AS record,
       CASE WHEN regexp_matches(t, 'ELECTING (AN? |CERTAIN |MEMBERS? ).*COMMITTEE') OR regexp_matches(t, 'CONSTITUTE .*MEMBERSHIP (ON|OF) .*COMMITTEE') OR regexp_matches(t, 'REMOVING .*MEMBER FROM .*COMMITTEE') THEN 'committee_assignment' ELSE 'other' END AS resolution FROM t""",
    "candidate_groups": """
WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'CREC-' || o_orderkey ELSE 'BILLS-113' || CASE WHEN o_custkey % 2 = 0 THEN 'hres' ELSE 'SRES' END || o_custkey % 40 || 'v' || o_orderkey END AS package,
         CASE WHEN o_orderkey % 4 > 0 THEN o_custkey % 40 END AS g, o_orderkey % 31 = 0 OR o_custkey % 17 = 3 AND o_orderkey % 3 = 1 AS hit,
         ['daily_record', 'house_resolution', NULL, 'senate_resolution', 'senate_resolution'][o_orderkey % 5 + 1] AS expected_type FROM orders
)
SELECT o_orderkey, package, expected_type, CASE WHEN hit OR (g IS NOT NULL AND bool_or(hit AND expected_type LIKE '%_resolution') OVER (PARTITION BY g)) THEN 'committee_assignment' ELSE 'other' END AS candidate_class FROM o""",
    "citations": "SELECT c_custkey, CAST(CASE WHEN c_custkey % 4 < 2 THEN c_custkey END AS INTEGER) AS number, CASE WHEN c_custkey % 3 = 0 THEN 'S' ELSE ['H', 'S', 'H', ''][c_custkey % 4 + 1] END AS chamber FROM customer",
    "source_categories": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'required' ELSE MAP {'1': 'required', '2': 'optional', '3': 'optional', '5': 'validation_only'}[substr(o_orderpriority, 1, 1)] END AS category FROM orders",
    "retrieval_state": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'MISSING' WHEN o_orderkey % 5 > 0 AND o_orderkey % 11 = 0 THEN 'HASH_MISMATCH' WHEN o_orderkey % 13 = 0 THEN 'SIZE_MISMATCH' ELSE 'RETRIEVED' END AS status FROM orders",
    "manifest_rows": "SELECT o_orderpriority AS collection, 'p' || o_custkey AS package, 'g' || o_orderkey % 3 AS granule, max(o_orderdate) AS modified, 'LISTED' AS status, CAST(NULL AS VARCHAR) AS error FROM orders GROUP BY ALL UNION ALL SELECT '9-NONE', NULL, NULL, NULL, 'FAILED', 'no source was listed'",
    "page_gates": f"""
WITH g AS (SELECT c_custkey, c_nationkey, {_reasons(BODY_FORMS)}[c_custkey % {len(BODY_FORMS)} + 1] AS b, {_reasons(MEMBER_FORMS)}[(c_custkey // {len(BODY_FORMS)}) % {len(MEMBER_FORMS)} + 1] AS m FROM customer)
SELECT c_custkey, coalesce(b, m) AS reason,
       CASE WHEN b IN ('committee_too_long', 'committee_no_required_phrase') THEN b WHEN c_nationkey % 2 = 0 OR c_custkey % {len(BODY_FORMS)} IN (8, 9, 11) THEN 'committee_has_bill_tokens' END AS senate_reason FROM g""",
    "page_texts": f"""
WITH p AS (SELECT c_custkey, c_mktsegment, DATE '2020-01-01' + CAST(c_custkey % 700 AS INTEGER) AS d, CASE WHEN c_custkey % 3 = 0 THEN c_custkey || chr(10) ELSE '' END AS head FROM customer),
t AS (SELECT *, head || 'THE JOURNAL of ' || CASE WHEN c_custkey % 2 = 0 THEN strftime(d, '%B %-d, %Y') ELSE strftime(d, '%B %-d') END || '.' || chr(10) || 'Mr.Poe,MrsLow S. Res. 12, on Fog' || chr(10) || 'end' AS t FROM p)
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN d WHEN month(d) <> 2 OR day(d) <> 29 THEN make_date(2021, month(d), day(d)) END AS day, CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS INTEGER) AS page, CAST(length(t) AS INTEGER) AS n,
       'S. Res. 12,' AS span, replace({_mended}[c_custkey % {len(SCANNED)} + 1], '{{n}}', upper(c_mktsegment[1]) || lower(c_mktsegment[2:7])) AS spaced, greatest(DATE '2020-06-01', CASE WHEN c_custkey % 5 > 0 THEN d ELSE DATE '2020-06-01' END) AS effective FROM t""",
    "roster_signals": "SELECT c_custkey, c_custkey % 5 < 2 AS roster, c_custkey % 5 < 2 AS one_side FROM customer",
    "newest_copy": "SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 4 END AS district, o_orderdate, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 4 END, -1) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "preferred_copy": "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 3 = 0 END DESC NULLS LAST, o_orderkey) = 1",
    "ordinal_pairs": "WITH l AS (SELECT o_custkey, o_orderkey AS first, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders), r AS (SELECT o_custkey, o_orderkey AS second, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders WHERE o_orderkey % 2 = 0) SELECT o_custkey, CAST(n AS INTEGER) AS ordinal, first, second FROM l JOIN r USING (o_custkey, n)",
    "first_of_run": "SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL",
    "repaired_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 > 2 THEN o_orderdate + CAST(o_orderkey % 5 - 2 AS INTEGER) ELSE o_orderdate END AS o_orderdate, o_orderkey % 3 = 0 AND o_orderkey % 5 > 2 AS repaired FROM orders",
    "regrouped_children": "SELECT CASE WHEN o_custkey % 4 = 0 AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) THEN o_custkey - 1 ELSE o_custkey END AS o_custkey, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1",
}

_DATED = "FROM (SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders)"
SQL = {name: sql.replace("FROM orders", _DATED) for name, sql in SQL.items()}
