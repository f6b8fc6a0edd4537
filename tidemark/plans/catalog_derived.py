"""Derived removals over the events table, with a day-by-day recursion as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derived, ledger as lg
from ..sources.tables import table

_LEDGER = ["CAST(event_id AS STRING) AS event_id", "user_id AS member", "CAST(event_id % 4 AS INT) AS body", "CASE event_type WHEN 'signup' THEN 'APPOINTED' ELSE 'REMOVED' END AS action", "to_date(ts) AS day", "'events' AS source", "CAST(event_id AS STRING) AS locator", "CAST(NULL AS STRING) AS mode"]


def _inputs(spark, d):
    """signup and error are the ledger; dear purchases are exits, middling ones transfers, views of every fifth day rosters."""
    e = table(spark, d, "events")
    ledger = e.filter("event_type IN ('signup', 'error')").selectExpr(*_LEDGER)
    exits = e.filter("event_type = 'purchase' AND value > 60").selectExpr("event_id AS trigger", "user_id AS member", "to_date(ts) AS day", "'exits' AS source", "CAST(event_id AS STRING) AS locator")
    transfers = e.filter("event_type = 'purchase' AND value BETWEEN 30 AND 60").selectExpr(
        "event_id AS trigger", "user_id AS member", "to_date(ts) AS day", "'transfers' AS source", "CAST(event_id AS STRING) AS locator",
        "CASE WHEN value < 45 THEN CAST((event_id + 1) % 4 AS INT) END AS from_body", "CAST(event_id % 4 AS INT) AS to_body",
    )
    rosters = e.filter("event_type = 'view' AND day(ts) % 5 = 0").selectExpr("CAST(event_id % 4 AS INT) AS body", "to_date(ts) AS day", "user_id AS member", "'rosters' AS source", "CONCAT(event_id % 4, ' ', to_date(ts)) AS locator")
    return ledger, exits, transfers, rosters


def derived_removals(spark, d):
    return derived.derive(*_inputs(spark, d)).select("member", "body", "action", "day", "why", "locator")


def derived_reconciled(spark, d):
    """The second run over a ledger that holds the first run's events, but for one body, and some that nothing supports."""
    ledger, *triggers = _inputs(spark, d)
    first = derived.derive(ledger, *triggers)
    stored = derived.refreshed(ledger, first.filter("body <> 3"))
    stray = ledger.filter("action = 'REMOVED' AND body = 2").withColumns({"event_id": F.concat(F.lit("stray "), "event_id"), "mode": F.lit(derived.DERIVED)})
    stored = stored.unionByName(stray)
    sides = lg.reconcile(derived.stored_ids(stored), derived.derive(stored, *triggers), "event_id")
    return sides.groupBy("side").agg(F.count("*").alias("n"))


_SQL = """
WITH RECURSIVE led AS (
  SELECT CAST(event_id AS VARCHAR) AS id, user_id AS m, CAST(event_id % 4 AS INTEGER) AS b, CASE event_type WHEN 'signup' THEN 'A' ELSE 'R' END AS k, CAST(ts AS DATE) AS day FROM events WHERE event_type IN ('signup', 'error')
), ex AS (SELECT CAST(event_id AS VARCHAR) AS id, user_id AS m, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase' AND value > 60
), tr AS (SELECT CAST(event_id AS VARCHAR) AS id, user_id AS m, CAST(ts AS DATE) AS day, CASE WHEN value < 45 THEN CAST((event_id + 1) % 4 AS INTEGER) END AS f, CAST(event_id % 4 AS INTEGER) AS t FROM events WHERE event_type = 'purchase' AND value BETWEEN 30 AND 60
), ro AS (SELECT DISTINCT CAST(event_id % 4 AS INTEGER) AS b, CAST(ts AS DATE) AS day, user_id AS m, (event_id % 4) || ' ' || CAST(ts AS DATE) AS id FROM events WHERE event_type = 'view' AND day(ts) % 5 = 0
), pairs AS (SELECT m, b FROM led UNION SELECT m, b FROM ro UNION SELECT m, t FROM tr
), e AS (
  SELECT m, b, day, 1 AS phase, CASE k WHEN 'A' THEN 0 ELSE 2 END AS rank, id, k, NULL AS why FROM led
  UNION ALL SELECT m, b, day, 1, 1, id, 'A', 'roster' FROM ro
  UNION ALL SELECT p.m, p.b, r.day, 0, 0, r.id, 'P', 'roster' FROM pairs p JOIN (SELECT DISTINCT b, day, id FROM ro) r ON p.b = r.b WHERE NOT EXISTS (SELECT 1 FROM ro x WHERE x.b = p.b AND x.day = r.day AND x.m = p.m)
  UNION ALL SELECT m, t, day, 2, 0, id, 'A', 'transfer' FROM tr
  UNION ALL SELECT p.m, p.b, tr.day, 2, 0, tr.id, 'P', 'transfer' FROM pairs p JOIN tr ON p.m = tr.m WHERE p.b <> tr.t AND (tr.f IS NULL OR tr.f = p.b)
  UNION ALL SELECT p.m, p.b, ex.day, 3, 0, ex.id, 'P', 'exit' FROM pairs p JOIN ex ON p.m = ex.m
), s AS (SELECT *, row_number() OVER (PARTITION BY m, b ORDER BY day, phase, rank, id) AS n FROM e
), f AS (
  SELECT s.*, k = 'A' AS held, why IS NOT NULL AND k = 'A' AS acts FROM s WHERE n = 1
  UNION ALL SELECT s.*, s.k = 'A', s.why IS NOT NULL AND CASE s.k WHEN 'A' THEN NOT f.held WHEN 'P' THEN f.held ELSE FALSE END FROM f JOIN s ON s.m = f.m AND s.b = f.b AND s.n = f.n + 1
), found AS (SELECT m AS member, b AS body, CASE k WHEN 'A' THEN 'APPOINTED' ELSE 'REMOVED' END AS action, day, why, id AS locator FROM f WHERE acts)
"""

QUERIES = {f.__name__: f for f in (derived_removals, derived_reconciled)}
SQL = {
    "derived_removals": f"{_SQL} SELECT * FROM found",
    "derived_reconciled": f"{_SQL} SELECT 'missing' AS side, count(*) AS n FROM found WHERE body = 3 UNION ALL SELECT 'stale', count(*) FROM led WHERE k = 'R' AND b = 2",
}
