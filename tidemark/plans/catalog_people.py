"""Names, resolution of members and bodies, dated ranks and events of texts, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import departures as dp
from ..functions import people as pp
from ..operators import pick, rank_intervals as ri, resolve as rs
from ..sources.tables import dealt, table

_SEG = "substring(c_mktsegment, 1, 1) || lower(substring(c_mktsegment, 2))"


def person_names(spark, d):
    raw = f"""CASE c_custkey % 9 WHEN 0 THEN 'Mr. José ' || {_SEG} WHEN 1 THEN 'Ms. ' || {_SEG} || ' of New York' WHEN 2 THEN {_SEG} || ', Jr.' WHEN 3 THEN 'Señora  ' || {_SEG} || ' Ph.D.'
        WHEN 4 THEN 'Mrs.' || {_SEG} || ' of District of Columbia' WHEN 5 THEN 'the Honorable ' || {_SEG} || ',M.D.' WHEN 6 THEN 'Senator O-' || {_SEG} || ' IV of Nowhere of Ohio' WHEN 7 THEN 'the gentlewoman from ' || {_SEG} || ' , ' END"""
    c = table(spark, d, "customer").selectExpr("c_custkey", f"{raw} AS raw")
    name, state = pp.name_and_state(pp.without_suffix(pp.without_title(F.col("raw"))))
    return c.select("c_custkey", pp.person_key(name).alias("name"), state.alias("state"), pp.gender_of_title(F.col("raw")).alias("gender"))


_GIVEN = "element_at(array('Jim', 'James', 'BOB', 'Robert J.', 'Tony', 'Anne', 'Will', 'bill'), {} + 1)"


def given_names(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey", f"{_GIVEN.format('CAST(c_custkey % 8 AS INT)')} AS a", f"{_GIVEN.format('CAST(floor(c_custkey / 8) % 8 AS INT)')} AS b")
    return c.select("c_custkey", pp.same_given(F.col("a"), F.col("b")).alias("same"), pp.first_names_meet(F.col("a"), F.col("b")).alias("meet"))


def coded_people(spark, d):
    c = table(spark, d, "customer").selectExpr(
        "c_custkey", "element_at(array(100, 328, 200, 77), CAST(c_custkey % 4 AS INT) + 1) AS party",
        "element_at(array('male', ' F ', 'x', 'Female'), CAST(c_custkey % 4 AS INT) + 1) AS gender", "element_at(array('Ohio', 'tx', 'New  York', 'Puerto Rico'), CAST(c_custkey % 4 AS INT) + 1) AS state",
    )
    return c.select("c_custkey", pp.party_letter(F.col("party")).alias("party"), pp.gender_letter(F.col("gender")).alias("gender"), pp.state_code(F.col("state")).alias("state"))


def _members(spark, d):
    return table(spark, d, "supplier").selectExpr(
        "s_nationkey AS scope", "CAST(s_suppkey AS STRING) AS member", "element_at(array('James', 'Anna', 'William', 'Ruth'), CAST(s_suppkey % 4 AS INT) + 1) AS first_name", "CAST(NULL AS STRING) AS nickname",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'De Fama' WHEN s_suppkey % 3 = 1 THEN 'Famb' ELSE 'Famc' END AS last_name", "CAST(NULL AS STRING) AS full_name", "element_at(array('OH', 'TX'), CAST(s_suppkey % 2 AS INT) + 1) AS state",
        "CASE WHEN s_suppkey % 5 < 2 THEN 'D' ELSE 'R' END AS party", "CASE WHEN s_suppkey % 2 = 1 THEN 'F' ELSE 'M' END AS gender",
        "DATE '2000-01-01' AS valid_from", "CASE WHEN s_suppkey % 7 = 0 THEN DATE '2015-01-01' END AS valid_to",
    )


def _mentions(spark, d):
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS id", "c_nationkey AS scope",
        "CASE c_custkey % 4 WHEN 0 THEN 'Mr. Famb' WHEN 1 THEN 'Ms. Famc of Ohio' WHEN 2 THEN element_at(array('Jim', 'Anna', 'Bill', 'Ruth'), CAST(floor(c_custkey / 4) % 4 AS INT) + 1) || ' Q. Famc' ELSE 'Fama' END AS raw",
        "CASE WHEN c_custkey % 3 > 0 THEN make_date(2005 + CAST(c_custkey % 20 AS INT), 6, 1) END AS day", "CAST(NULL AS STRING) AS state",
        "CASE WHEN c_custkey % 5 = 0 THEN 'D' END AS party", "CASE WHEN c_custkey % 7 = 0 THEN 'F' END AS gender",
    )


def resolve_names(spark, d):
    return rs.resolve_members(_mentions(spark, d), _members(spark, d), ["scope"])


def resolve_names_retry(spark, d):
    """Rosters of three mentions; parties of those found help the others."""
    rosters = _mentions(spark, d).withColumn("block", F.floor(F.col("id") / 3))
    return rs.resolve_with_retry(rosters, _members(spark, d), ["scope"], ["block"])


def caucus_party(spark, d):
    o = table(spark, d, "orders").selectExpr("o_custkey AS member", "to_date(o_orderdate) AS valid_from", "CASE WHEN o_orderkey % 5 > 0 THEN date_add(to_date(o_orderdate), 200) END AS valid_to", "CAST(o_orderkey % 100 AS INT) AS party_code", "CASE WHEN o_orderkey % 3 = 0 THEN 900 END AS caucus_code")
    q = table(spark, d, "customer").selectExpr("c_custkey AS member", "DATE '1996-03-05' AS day")
    return rs.caucus_party(q, o, ["member"]).drop("day")


def resolve_bodies(spark, d):
    n = table(spark, d, "nation")
    index = n.selectExpr("lower(replace(n_name, ' ', '')) AS key", "element_at(array('H', 'S', 'J'), CAST(n_nationkey % 3 AS INT) + 1) || n_nationkey AS code", "CASE WHEN n_nationkey % 4 = 0 THEN array(113, 115) END AS congresses", "CASE WHEN n_nationkey % 2 = 0 THEN 2015 END AS start_year", "CASE WHEN n_nationkey % 5 = 1 THEN 2016 END AS end_year")
    index = index.unionByName(index.filter("code LIKE '%7'").withColumn("code", F.concat("code", F.lit("x"))))
    aliases = n.selectExpr("114 AS congress", "'old' || lower(replace(n_name, ' ', '')) AS key", "lower(replace(n_name, ' ', '')) AS stands_for")
    asked = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_custkey AS id", "CAST(113 + c_custkey % 4 AS INT) AS congress", "CASE WHEN c_custkey % 3 = 0 THEN 'S' ELSE 'H' END AS chamber", "CASE WHEN c_custkey % 5 = 0 THEN 'old' ELSE '' END || lower(replace(n_name, ' ', '')) AS key")
    return rs.resolve_bodies(asked, index, aliases)


def rank_intervals(spark, d):
    c = table(spark, d, "customer")
    sits = c.selectExpr("c_nationkey AS scope", "'m' || c_custkey AS membership", "CAST(c_custkey AS STRING) AS member", "date_add(DATE '2020-01-01', CAST(c_custkey % 40 AS INT)) AS valid_from", "date_add(DATE '2020-04-01', CAST(c_custkey % 50 AS INT)) AS valid_to")
    first = c.selectExpr("c_nationkey AS scope", "CAST(c_custkey AS STRING) AS member", "CAST(c_custkey % 2 AS INT) AS party", "DATE '2020-01-01' AS valid_from", "CASE WHEN c_custkey % 5 = 0 THEN DATE '2020-03-01' ELSE DATE '2021-01-01' END AS valid_to")
    then = c.filter("c_custkey % 5 = 0").selectExpr("c_nationkey AS scope", "CAST(c_custkey AS STRING) AS member", "1 - CAST(c_custkey % 2 AS INT) AS party", "DATE '2020-02-01' AS valid_from", "DATE '2021-01-01' AS valid_to")
    seen = c.selectExpr(
        "c_nationkey AS scope", "date_add(DATE '2020-01-10', CAST(c_custkey % 7 AS INT) * 10) AS day", "CAST(NULL AS INT) AS number", "1 AS block", "CAST(c_custkey AS INT) AS ordinal", "'o' || c_custkey AS observation",
        "CASE WHEN c_custkey % 11 > 0 THEN CAST(c_custkey AS STRING) END AS member", "c_name AS raw", "CAST(c_custkey % 2 AS INT) AS party", "CAST(NULL AS STRING) AS after", "CAST(NULL AS STRING) AS after_raw", "FALSE AS full_roster",
    )
    return ri.rank_intervals(sits, first.unionByName(then), seen, ["scope"])


def text_events(spark, d):
    day = "date_format(date_add(DATE '2020-01-01', CAST(c_custkey % 700 AS INT)), 'MMMM d, yyyy')"
    text = f"""CASE c_custkey % 7
        WHEN 0 THEN 'I resign from the Committee on Oars and the Committee on Nets, effective on ' || {day} || '. Regards to all.\nRespectfully,\n' || c_name
        WHEN 1 THEN 'We mourn the death of the Honorable ' || c_name || ' of Ohio on ' || {day} || '.'
        WHEN 2 THEN 'The Chair appoints Mr. Low to the Committee on Sails, vice Mrs. ' || c_name || '.'
        WHEN 3 THEN 'The gentleman from Ohio (Mr. ' || c_name || ') is transferred to the Committee on Sails.'
        WHEN 4 THEN 'The vacancy caused by the death of Senator ' || c_name || ' is filled.'
        WHEN 5 THEN 'The Committee on Sails met on ' || {day} || '.' END"""
    c = dealt(table(spark, d, "customer").select("c_custkey", "c_name")).select("c_custkey", F.expr(text).alias("text"))
    # outer, as Spark lets a plain explode filter by its array first, which would read each text's events a second time, field by field
    c = dp.with_events(c, "text", F.lit("2018-05-06").cast("date")).select("c_custkey", F.posexplode_outer("events").alias("pos", "e")).filter("pos IS NOT NULL")
    return c.select("c_custkey", "pos", "e.*")


def get_or_create(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    wanted = c.selectExpr("c_nationkey", "c_mktsegment")
    held = n.selectExpr("n_nationkey AS c_nationkey", "'BUILDING' AS c_mktsegment", "'id-' || n_nationkey AS id")
    return pick.get_or_create(wanted, held, ["c_nationkey", "c_mktsegment"], "id")


_Q = [person_names, given_names, coded_people, resolve_names, resolve_names_retry, caucus_party, resolve_bodies, rank_intervals, text_events, get_or_create]
QUERIES = {f.__name__: f for f in _Q}

_SEG_SQL = "substring(c_mktsegment, 1, 1) || lower(substring(c_mktsegment, 2))"
_DAY_SQL = "DATE '2020-01-01' + CAST(c_custkey % 700 AS INTEGER)"
_NONE = "DATE '2018-05-06'"
_PEOPLE_SQL = """m AS (
  SELECT s_nationkey AS scope, CAST(s_suppkey AS VARCHAR) AS member, ['james', 'anna', 'william', 'ruth'][s_suppkey % 4 + 1] AS given, ['fama', 'famb', 'famc'][s_suppkey % 3 + 1] AS last,
         ['OH', 'TX'][s_suppkey % 2 + 1] AS state, CASE WHEN s_suppkey % 5 < 2 THEN 'D' ELSE 'R' END AS party, CASE WHEN s_suppkey % 2 = 1 THEN 'F' ELSE 'M' END AS gender, CASE WHEN s_suppkey % 7 = 0 THEN DATE '2015-01-01' ELSE DATE '9999-01-01' END AS until
  FROM supplier
), q AS (
  SELECT c_custkey AS id, c_nationkey AS scope, c_custkey % 4 AS kind, ['famb', 'famc', 'famc', 'fama'][c_custkey % 4 + 1] AS last, ['james', 'anna', 'william', 'ruth'][(c_custkey // 4) % 4 + 1] AS given,
         CASE WHEN c_custkey % 3 > 0 THEN make_date(2005 + c_custkey % 20, 6, 1) END AS day, CASE WHEN c_custkey % 4 = 1 THEN 'OH' END AS state, CASE WHEN c_custkey % 5 = 0 THEN 'D' END AS party, CASE WHEN c_custkey % 7 = 0 THEN 'F' END AS gender
  FROM customer
)"""


def _narrowed(asked: str, tag: str) -> str:
    """CTEs from the mentions ``asked`` to f (id, n, member), all named with ``tag``."""
    return f"""met{tag} AS (
  SELECT q.id, m.member, coalesce(m.state = q.state, FALSE) AS s, coalesce(m.party = q.party, FALSE) AS p, coalesce(m.gender = q.gender, FALSE) AS g, count(*) OVER (PARTITION BY q.id) AS n, q.kind
  FROM {asked} q JOIN m ON q.scope = m.scope AND q.last = m.last AND (q.kind <> 2 OR q.given = m.given) AND (q.day IS NULL OR q.day < m.until)
), a{tag} AS (SELECT *, bool_or(s) OVER (PARTITION BY id) AS any_s FROM met{tag} WHERE kind <> 3 OR n = 1),
b{tag} AS (SELECT *, bool_or(p) OVER (PARTITION BY id) AS any_p FROM a{tag} WHERE s OR NOT any_s),
c{tag} AS (SELECT *, bool_or(g) OVER (PARTITION BY id) AS any_g FROM b{tag} WHERE p OR NOT any_p),
f{tag} AS (SELECT id, count(*) AS n, min(member) AS member FROM c{tag} WHERE g OR NOT any_g GROUP BY id)"""


SQL = {
    "person_names": f"""
WITH p AS (SELECT c_custkey, c_custkey % 9 AS k, lower(c_mktsegment) AS n FROM customer)
SELECT c_custkey, CASE WHEN k = 0 THEN 'jose ' || n WHEN k = 3 THEN 'senora ' || n WHEN k = 6 THEN 'o' || n || ' iv' WHEN k < 8 THEN n END AS name,
       CASE k WHEN 1 THEN 'NY' WHEN 4 THEN 'DC' END AS state, CASE k WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 4 THEN 'F' END AS gender FROM p""",
    "given_names": """
WITH p AS (SELECT c_custkey, ['jim', 'james', 'bob', 'robert', 'tony', 'anne', 'will', 'bill'] AS g, ['james', 'james', 'robert', 'robert', 'anthony', 'anne', 'william', 'william'] AS f, c_custkey % 8 + 1 AS i, (c_custkey // 8) % 8 + 1 AS j FROM customer)
SELECT c_custkey, f[i] = f[j] AS same, (f[i] = f[j] OR contains(g[i], g[j]) OR contains(g[j], g[i])) AS meet FROM p""",
    "coded_people": "SELECT c_custkey, CASE c_custkey % 4 WHEN 2 THEN 'R' WHEN 3 THEN NULL ELSE 'D' END AS party, CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 2 THEN NULL ELSE 'F' END AS gender, CASE c_custkey % 4 WHEN 0 THEN 'OH' WHEN 1 THEN 'TX' WHEN 3 THEN 'PR' END AS state FROM customer",
    "resolve_names": f"""
WITH {_PEOPLE_SQL}, {_narrowed("q", "")}
SELECT q.id, CASE WHEN f.n = 1 THEN f.member END AS member, CASE WHEN f.n IS NULL THEN 'unknown' WHEN f.n = 1 THEN 'resolved' ELSE 'ambiguous' END AS status FROM q LEFT JOIN f USING (id)""",
    "resolve_names_retry": f"""
WITH {_PEOPLE_SQL}, {_narrowed("q", "")},
told AS (SELECT f.id // 3 AS block, min(m.party) AS told FROM f JOIN m USING (member) WHERE f.n = 1 GROUP BY f.id // 3 HAVING min(m.party) = max(m.party)),
r AS (SELECT q.* REPLACE (told.told AS party) FROM q JOIN told ON told.block = q.id // 3 LEFT JOIN f ON f.id = q.id WHERE q.party IS NULL AND coalesce(f.n, 0) <> 1),
{_narrowed("r", "2")}
SELECT q.id, CASE WHEN f2.n = 1 THEN f2.member WHEN f.n = 1 THEN f.member END AS member,
       CASE WHEN f2.n = 1 OR f.n = 1 THEN 'resolved' WHEN f.n IS NULL THEN 'unknown' ELSE 'ambiguous' END AS status
FROM q LEFT JOIN f USING (id) LEFT JOIN f2 USING (id)""",
    "caucus_party": """
SELECT o_custkey AS member, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 900 ELSE o_orderkey % 100 END AS INTEGER) AS caucus
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate <= DATE '1996-03-05' AND (o_orderkey % 5 = 0 OR DATE '1996-03-05' < CAST(o_orderdate AS DATE) + 200)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey % 100 DESC, o_orderkey % 3) = 1""",
    "resolve_bodies": """
SELECT c_custkey AS id, ['H', 'S', 'J'][n_nationkey % 3 + 1] || n_nationkey AS code
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE (c_custkey % 5 > 0 OR c_custkey % 4 = 1) AND n_nationkey % 10 <> 7 AND (n_nationkey % 3 = 2 OR (n_nationkey % 3 = 1) = (c_custkey % 3 = 0))
  AND CASE WHEN n_nationkey % 4 = 0 THEN c_custkey % 4 IN (0, 2)
           ELSE (n_nationkey % 2 > 0 OR 2015 <= 2014 + 2 * (c_custkey % 4)) AND (n_nationkey % 5 <> 1 OR 2016 >= 2013 + 2 * (c_custkey % 4)) END""",
    "rank_intervals": """
WITH o AS (
  SELECT *, c_custkey % 2 AS party, row_number() OVER w AS rank, count(*) FILTER (c_custkey % 11 = 0) OVER w AS unresolved, DATE '2020-01-10' + CAST(c_custkey % 7 AS INTEGER) * 10 AS day
  FROM customer WINDOW w AS (PARTITION BY c_nationkey, c_custkey % 2 ORDER BY c_custkey % 7, c_custkey)
)
SELECT 'm' || c_custkey AS membership, CAST(c_custkey AS VARCHAR) AS member, CAST(party AS INTEGER) AS party, CAST(rank AS INTEGER) AS rank, CAST(unresolved AS INTEGER) AS unresolved_before, 'resolution_order' AS basis, 'o' || c_custkey AS observation,
       greatest(day, DATE '2020-01-01' + CAST(c_custkey % 40 AS INTEGER)) AS valid_from, least(DATE '2020-04-01' + CAST(c_custkey % 50 AS INTEGER), CASE WHEN c_custkey % 5 = 0 THEN DATE '2020-03-01' ELSE DATE '2021-01-01' END) AS valid_to
FROM o WHERE c_custkey % 11 > 0 AND greatest(day, DATE '2020-01-01' + CAST(c_custkey % 40 AS INTEGER)) < least(DATE '2020-04-01' + CAST(c_custkey % 50 AS INTEGER), CASE WHEN c_custkey % 5 = 0 THEN DATE '2020-03-01' ELSE DATE '2021-01-01' END)""",
    "text_events": f"""
SELECT c_custkey, 0 AS pos, 'REMOVED' AS action, c_name AS member, CASE c_custkey % 7 WHEN 0 THEN 'Committee on Oars' END AS body,
       CASE WHEN c_custkey % 7 < 2 THEN {_DAY_SQL} ELSE {_NONE} END AS effective, CASE WHEN c_custkey % 7 IN (1, 4) THEN 'chamber' WHEN c_custkey % 7 = 3 THEN 'all but new' ELSE 'committee' END AS scope FROM customer WHERE c_custkey % 7 IN (0, 1, 3, 4)
UNION ALL SELECT c_custkey, 1, 'REMOVED', c_name, 'Committee on Nets', {_DAY_SQL}, 'committee' FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT c_custkey, 0, 'APPOINTED', 'Low', 'Committee on Sails', {_NONE}, 'committee' FROM customer WHERE c_custkey % 7 = 2
UNION ALL SELECT c_custkey, 1, 'REMOVED', c_name, 'Committee on Sails', {_NONE}, 'committee' FROM customer WHERE c_custkey % 7 = 2
UNION ALL SELECT c_custkey, 1, 'APPOINTED', c_name, 'Committee on Sails', {_NONE}, 'committee' FROM customer WHERE c_custkey % 7 = 3""",
    "get_or_create": "SELECT DISTINCT c_nationkey, c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 'id-' || c_nationkey ELSE sha256(c_nationkey || '|' || c_mktsegment) END AS id, c_mktsegment <> 'BUILDING' AS created FROM customer",
}
