"""Bodies and Senators by ordered attempts, and a directory from its labels to its scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import directory as dr, fallback as fb, resolve as rs
from ..sources.tables import table

_NATION = "concat(upper(substring(n_name, 1, 1)), lower(substring(n_name, 2)))"
#: Forms in which a body is asked for; {n} is a nation's name.
FORMS = ["Committee on {n}", "House Committee on the {n}", "{n}", "Joint Committee on {n}", "Senate {n}", "Old {n}", "Committee on Nothing of {n}", "Select Committee on {n}:"]


def _index(spark, d):
    n = table(spark, d, "nation").withColumn("n", F.expr(_NATION))
    records = n.selectExpr(
        "element_at(array('H', 'S', 'J'), CAST(n_nationkey % 3 AS INT) + 1) || n_nationkey AS code", "'Committee on ' || n AS name", "array('Band ' || n, 'Committee of the ' || n) AS other_names",
        "CASE WHEN n_nationkey % 4 = 0 THEN array(113, 115) END AS congresses", "CASE WHEN n_nationkey % 5 = 1 THEN 2017 END AS start_year", "CAST(NULL AS INT) AS end_year",
    )
    second = records.filter("code LIKE '%7'").withColumn("code", F.concat("code", F.lit("x")))  # two bodies of one name
    aliases = n.select(F.lit(114).alias("congress"), F.concat(F.lit("old"), fb.index_key(F.col("n"))).alias("key"), fb.index_key(F.col("n")).alias("stands_for"))
    named = n.selectExpr("element_at(array('H', 'S', 'J', 'J'), CAST(n_nationkey % 4 AS INT) + 1) AS scope", "lower(n) AS key", "'N' || n_nationkey AS code", "CAST(n_nationkey AS INT) AS place")
    return fb.body_index(records.unionByName(second)), aliases, named


def _asked_bodies(spark, d):
    n = table(spark, d, "nation").withColumn("n", F.expr(_NATION))
    form = F.replace(F.get(F.array(*map(F.lit, FORMS)), (F.col("c_custkey") % len(FORMS)).cast("int")), F.lit("{n}"), F.col("n"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(F.col("c_custkey").alias("id"), (113 + F.floor(F.col("c_custkey") / 8) % 3).cast("int").alias("congress"), F.when(F.col("c_custkey") % 3 == 0, "S").otherwise("H").alias("chamber"), form.alias("text"))


def resolve_bodies_fallback(spark, d):
    return fb.resolve_bodies_fallback(_asked_bodies(spark, d), *_index(spark, d))


_SENATOR = "element_at(array('Vane', 'De Vane', 'Núñez', 'Oak'), CAST({} % 4 AS INT) + 1)"


def resolve_senate_names(spark, d):
    members = table(spark, d, "supplier").selectExpr(
        "s_nationkey AS congress", "'m' || s_suppkey AS member", f"{_SENATOR.format('s_suppkey')} AS last_name", "element_at(array('OH', 'TX', 'UT'), CAST(s_suppkey % 3 AS INT) + 1) AS state",
        "CASE WHEN s_suppkey % 5 < 2 THEN 'F' WHEN s_suppkey % 5 < 4 THEN 'M' END AS gender", "CASE WHEN s_suppkey % 2 = 0 THEN 100 ELSE 200 END AS party",
    )
    raw = f"concat(element_at(array('Mr. ', 'Ms. ', '', 'Senator '), CAST(floor(c_custkey / 4) % 4 AS INT) + 1), CASE WHEN c_custkey % 7 = 0 THEN 'Jo ' ELSE '' END, {_SENATOR.format('c_custkey')}, element_at(array('', ' (Chair) (OH)', ' of Texas', ' (ut) (Acting), ', ' of Nowhere'), CAST(c_custkey % 5 AS INT) + 1))"
    asked = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey AS congress", f"{raw} AS raw", "CASE WHEN c_custkey % 3 = 0 THEN array(100) WHEN c_custkey % 3 = 1 THEN array(200, 300) END AS parties")
    return fb.resolve_senators(asked, members)


_LETTERS = "translate(CAST({} AS STRING), '0123456789', 'abcdefghij')"


def directory_scores(spark, d):
    """Labels and headings of a directory, parsed and resolved, against the seats of a ledger: all counters and gates of its cells."""
    index, aliases, named = _index(spark, d)
    s = table(spark, d, "supplier")
    members = s.selectExpr(
        "1 AS scope", "'m' || s_suppkey AS member", "'Pat' AS first_name", "CAST(NULL AS STRING) AS nickname", f"'Q' || {_LETTERS.format('s_suppkey')} AS last_name", "CAST(NULL AS STRING) AS full_name", "'OH' AS state", "'D' AS party", "'F' AS gender",
        "DATE '2000-01-01' AS valid_from", "CAST(NULL AS DATE) AS valid_to",
    )
    n = table(spark, d, "nation").withColumn("n", F.expr(_NATION))
    lines = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey AS id", "113 AS congress", "DATE '2014-01-01' AS day", "'H' AS chamber", "'standing' AS scope", "CASE WHEN c_custkey % 11 = 0 THEN 'Committee on Nothing' ELSE 'House Committee on ' || n END AS body",
        f"CASE WHEN c_custkey % 2 = 0 THEN 'Pat Q' || {_LETTERS.format('c_custkey')} || ', of Ohio' ELSE 'Q' || {_LETTERS.format('c_custkey')} || ' (OH-03) CHAIR' END AS label",
    )
    name, state = tx.label_name_state(F.col("label"))
    lines = lines.withColumns({"name": name, "stated": state})
    codes = fb.resolve_bodies_fallback(lines.select("id", "congress", "chamber", F.col("body").alias("text")), index, aliases, named).select("id", "code")
    mentions = lines.select("id", F.lit(1).alias("scope"), F.col("name").alias("raw"), "day", F.col("stated").alias("state"), F.lit(None).cast("string").alias("party"), F.lit(None).cast("string").alias("gender"))
    found = rs.resolve_members(mentions, members, ["scope"]).select("id", "member")
    cell = ["congress", "day", "chamber", "scope"]
    entries = lines.select("id", *cell, "body").join(codes, "id", "left").join(found, "id", "left").drop("id")
    # what the ledger holds: every fourth supplier doesn't sit, some sit elsewhere
    sits = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).filter("s_suppkey % 4 > 0").selectExpr("113 AS congress", "DATE '2014-01-01' AS day", "'H' AS chamber", "'standing' AS scope", "'N' || s_nationkey AS code", "'m' || s_suppkey AS member")
    seats = entries.filter("code IS NOT NULL AND member IS NOT NULL").select(*cell, "code", "member").filter("length(member) % 2 = 0").unionByName(sits).distinct()
    return dr.directory_cells(entries, seats, 0.5, 0.01)


_ASKED_SQL = f"""ask AS (
  SELECT c_custkey AS id, CAST(113 + (c_custkey // 8) % 3 AS INTEGER) AS congress, CASE WHEN c_custkey % 3 = 0 THEN 'S' ELSE 'H' END AS ch, replace([{', '.join(f"'{f}'" for f in FORMS)}][c_custkey % {len(FORMS)} + 1], '{{n}}', upper(n_name[1]) || lower(n_name[2:])) AS t
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""
_PREFIX = "|".join(fb.PREFIXES)
#: Attempts one by one: the index by name, then the lists of names, for a text and for its bare form.
_FALLBACK_SQL = f"""
n AS (SELECT n_nationkey AS k, upper(n_name[1]) || lower(n_name[2:]) AS n, ['H', 'S', 'J'][n_nationkey % 3 + 1] || n_nationkey AS code FROM nation
), rec AS (SELECT k, n, code FROM n UNION ALL SELECT k, n, code || 'x' FROM n WHERE k % 10 = 7
), idx AS (SELECT DISTINCT regexp_replace(lower(unnest([n, 'Band ' || n, n])), '[^a-z0-9]', '', 'g') AS key, code, k, -1 AS lim FROM rec
), al AS (SELECT 'old' || regexp_replace(lower(n), '[^a-z0-9]', '', 'g') AS key, code, k, 114 AS lim FROM rec
), ix AS (SELECT * FROM idx UNION ALL SELECT * FROM al
), form AS (SELECT id, congress, ch, 0 AS i, t FROM ask UNION ALL SELECT id, congress, ch, 1, regexp_replace(t, '^(House|Senate) ', '') FROM ask WHERE regexp_matches(t, '^(House|Senate) ')
), a1 AS (
  SELECT id, 1 + i AS attempt, min(code) AS code FROM form JOIN ix ON ix.key = regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(t), '^committee on ', ''), '^committee of ', ''), '^the ', ''), '[^a-z0-9]', '', 'g')
  WHERE (lim = -1 OR lim = congress) AND (code[1] = ch OR code[1] = 'J') AND (CASE WHEN k % 4 = 0 THEN congress IN (113, 115) ELSE k % 5 <> 1 OR 1788 + 2 * congress >= 2017 END)
  GROUP BY id, i HAVING count(DISTINCT code) = 1
), nm AS (SELECT ['H', 'S', 'J', 'J'][k % 4 + 1] AS s, lower(n) AS key, 'N' || k AS code, k AS place FROM n
), keyed AS (SELECT *, trim(regexp_replace(lower(t), '^({_PREFIX})', ''), '.: ') AS key FROM form
), a2 AS (
  SELECT id, 3 + 4 * i + j AS attempt, arg_min(code, place) AS code FROM keyed, (VALUES (0), (1), (2), (3)) o(j)
  JOIN nm ON nm.s = CASE WHEN j % 2 = 0 THEN keyed.ch ELSE 'J' END AND CASE WHEN j < 2 THEN nm.key = keyed.key ELSE replace(nm.key, ' ', '') = replace(keyed.key, ' ', '') END GROUP BY id, i, j
), answer AS (SELECT id, arg_min(code, attempt) AS code, CAST(min(attempt) AS INTEGER) AS attempt FROM (SELECT * FROM a1 UNION ALL SELECT * FROM a2) GROUP BY id)
"""

_SEN = "['Vane', 'De Vane', 'Núñez', 'Oak']"
SQL = {
    "resolve_bodies_fallback": f"WITH {_ASKED_SQL}, {_FALLBACK_SQL} SELECT * FROM answer",
    "resolve_senate_names": f"""
WITH m AS (
  SELECT s_nationkey AS congress, 'm' || s_suppkey AS member, {_SEN}[s_suppkey % 4 + 1] AS ln, ['OH', 'TX', 'UT'][s_suppkey % 3 + 1] AS st, CASE WHEN s_suppkey % 5 < 2 THEN 'F' WHEN s_suppkey % 5 < 4 THEN 'M' END AS g, CASE WHEN s_suppkey % 2 = 0 THEN 100 ELSE 200 END AS p FROM supplier
), a AS (
  SELECT c_custkey AS id, c_nationkey AS congress, ['M', 'F', NULL, NULL][(c_custkey // 4) % 4 + 1] AS tg, [NULL, 'OH', 'TX', 'UT', NULL][c_custkey % 5 + 1] AS st, {_SEN}[c_custkey % 4 + 1] AS nm, c_custkey % 7 = 0 AS jo,
         CASE WHEN c_custkey % 3 = 0 THEN [100] WHEN c_custkey % 3 = 1 THEN [200, 300] END AS ps FROM customer
), f AS (
  SELECT *, unnest([0, 1]) AS nth, CASE WHEN nth = 0 THEN CASE WHEN jo THEN 'Jo ' ELSE '' END || nm ELSE string_split(nm, ' ')[-1] END AS form FROM a
), h AS (SELECT f.id, nth, form, tg, ps, m.* EXCLUDE (congress, st) FROM f JOIN m ON m.congress = f.congress AND m.ln = form AND (f.st IS NULL OR f.st = m.st)
), b AS (SELECT * FROM h QUALIFY nth = min(nth) OVER (PARTITION BY id)
), c AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, count(*) FILTER (g = tg) OVER (PARTITION BY id) AS ng FROM b
), l AS (SELECT *, n > 1 AND ng > 0 AND NOT coalesce(g = tg, FALSE) AS out FROM c
), s AS (SELECT *, count(*) FILTER (NOT out AND list_contains(ps, p)) OVER (PARTITION BY id) AS np FROM l
), r AS (
  SELECT id, any_value(form) AS form, CAST(any_value(n) AS INTEGER) AS candidates, CASE WHEN any_value(n) = 1 THEN 'name' WHEN any_value(ng) = 1 THEN 'gender' WHEN any_value(np) = 1 THEN 'party' END AS "by",
         CASE WHEN any_value(n) = 1 THEN min(member) WHEN any_value(ng) = 1 THEN min(member) FILTER (g = tg) WHEN any_value(np) = 1 THEN min(member) FILTER (NOT out AND list_contains(ps, p)) END AS member FROM s GROUP BY id
)
SELECT a.id, member, form, coalesce(candidates, 0) AS candidates, "by" FROM a LEFT JOIN r USING (id)""",
    "directory_scores": f"""
WITH ask AS (
  SELECT c_custkey AS id, 113 AS congress, 'H' AS ch, CASE WHEN c_custkey % 11 = 0 THEN 'Committee on Nothing' ELSE 'House Committee on ' || upper(n_name[1]) || lower(n_name[2:]) END AS t FROM customer JOIN nation ON c_nationkey = n_nationkey
), {_FALLBACK_SQL}, e AS (
  SELECT ask.id, t AS body, answer.code, CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = ask.id) THEN 'm' || ask.id END AS member FROM ask LEFT JOIN answer USING (id)
), told AS (SELECT DISTINCT code, member FROM e WHERE code IS NOT NULL AND member IS NOT NULL
), seen AS (SELECT code, member FROM told WHERE length(member) % 2 = 0 UNION SELECT 'N' || s_nationkey, 'm' || s_suppkey FROM supplier WHERE s_suppkey % 4 > 0
), c AS (
  SELECT count(*) AS entries, count(*) FILTER (code IS NOT NULL AND member IS NULL) AS unresolved_entries, count(*) FILTER (code IS NULL) AS unmapped_entries, count(DISTINCT body) FILTER (code IS NULL) AS unmapped_bodies,
         (SELECT count(*) FROM told) AS resolved, (SELECT count(*) FROM seen) AS observed, (SELECT count(*) FROM told JOIN seen USING (code, member)) AS overlap FROM e
)
SELECT 113 AS congress, DATE '2014-01-01' AS day, 'H' AS chamber, 'standing' AS scope, *, resolved - overlap AS directory_only, observed - overlap AS observed_only,
       CASE WHEN entries - unmapped_entries > 0 THEN round_even(100.0 * resolved / (entries - unmapped_entries), 3) END AS resolution_pct, CASE WHEN entries > 0 THEN round_even(100.0 * overlap / entries, 3) END AS coverage_pct,
       CASE WHEN observed > 0 THEN round_even(100.0 * overlap / observed, 3) END AS observed_pct,
       CASE WHEN entries = 0 THEN 'NO_REFERENCE' WHEN overlap >= 0.5 * entries AND (entries = unmapped_entries OR resolved >= 0.01 * (entries - unmapped_entries)) AND unmapped_entries = 0 THEN 'PASS' ELSE 'FAIL' END AS gate_status FROM c""",
}
QUERIES = {f.__name__: f for f in (resolve_bodies_fallback, resolve_senate_names, directory_scores)}
