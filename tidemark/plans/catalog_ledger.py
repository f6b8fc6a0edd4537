"""Replay, as-of state, intervals and ranks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.intervals import contains, last_day
from ..operators import asof, islands, ranking, replay, scoring
from ..sources.tables import ledger, table, years

END = "2024-02-01"
DAY = "2024-01-15"

LED = """led AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day,
  CASE WHEN event_type IN ('signup', 'purchase') THEN 'APPOINTED' ELSE 'REMOVED' END AS action
  FROM events WHERE event_type IN ('signup', 'purchase', 'error'))"""
ORDER = "PARTITION BY user_id ORDER BY day, CASE action WHEN 'APPOINTED' THEN 0 ELSE 1 END, event_id"
IV = f"""{LED}, iv AS (
  SELECT user_id, event_id AS start_event_id, day AS valid_from, coalesce(nd, DATE '{END}') AS valid_to,
         CASE WHEN na = 'REMOVED' THEN ni END AS end_event_id
  FROM (SELECT *, lead(day) OVER w AS nd, lead(action) OVER w AS na, lead(event_id) OVER w AS ni FROM led WINDOW w AS ({ORDER}))
  WHERE action = 'APPOINTED' AND (nd IS NULL OR nd > day) AND coalesce(nd, DATE '{END}') > day)"""
MERGED = f"""{IV}, f AS (
  SELECT *, coalesce(valid_to = valid_from + 1 AND end_event_id IS NULL AND lead(valid_from) OVER w = valid_to, false) AS m,
         lead(valid_to) OVER w AS nt, lead(end_event_id) OVER w AS ne FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY valid_from, start_event_id)
), g AS (SELECT *, CASE WHEN coalesce(lag(m) OVER (PARTITION BY user_id ORDER BY valid_from, start_event_id), false) THEN 0 ELSE 1 END AS s FROM f),
h AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY valid_from, start_event_id ROWS UNBOUNDED PRECEDING) AS run FROM g),
j AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY valid_from, start_event_id) AS nth FROM h),
mv AS (SELECT user_id, start_event_id, valid_from, CASE WHEN m THEN nt ELSE valid_to END AS valid_to,
       CASE WHEN m THEN ne ELSE end_event_id END AS end_event_id FROM j WHERE nth % 2 = 1)"""


def _intervals(spark, d):
    return replay.replay(ledger(spark, d), ["user_id"], F.lit(END).cast("date"))


def _merged(spark, d):
    floor = F.lit("1990-01-01").cast("date")
    return replay.merge_one_day(replay.clamp_start(_intervals(spark, d), floor), ["user_id"])


def _dated(spark, d):
    """The ledger with decision and effective dates and a body (the raw event type)."""
    e = table(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("effective"), F.col("event_type").alias("body"), "value")
    return e.withColumns({"decision": F.date_sub("effective", F.pmod("event_id", F.lit(3)).cast("int")), "action": F.when(F.col("value") > 20, "APPOINTED").otherwise("REMOVED")})


DATED = """dated AS (SELECT event_id, user_id, CAST(ts AS DATE) AS effective, event_type AS body,
  CAST(ts AS DATE) - CAST(event_id % 3 AS INTEGER) AS decision, CASE WHEN value > 20 THEN 'APPOINTED' ELSE 'REMOVED' END AS action FROM events)"""


def replay_intervals(spark, d):
    return _intervals(spark, d)


def replay_intervals_merged(spark, d):
    return _merged(spark, d)


def active_on_date(spark, d):
    active = _merged(spark, d).filter(contains(F.col("valid_from"), F.col("valid_to"), F.lit(DAY).cast("date")))
    return active.select("user_id", "start_event_id")


def latest_action_asof(spark, d):
    return asof.state_as_of(_dated(spark, d), ["user_id", "body"], F.lit(DAY).cast("date")).select("user_id", "body", "event_id", "action")


def tie_break_variants(spark, d):
    """The latest state of a key under four orders that differ only in ties."""
    e = _dated(spark, d).filter(F.col("effective") <= F.lit(DAY).cast("date"))
    eff, dec, eid, gone = F.col("effective").desc(), F.col("decision").desc(), F.col("event_id").desc(), (F.col("action") == "REMOVED").desc()
    orders = {"full": [eff, dec, eid], "short": [eff, eid], "removed_wins": [eff, dec, gone, eid], "replay": [eff, F.when(F.col("action") == "APPOINTED", 1).otherwise(0), eid]}
    found = [asof.latest(e, ["user_id"], order).select("user_id", F.lit(name).alias("variant"), "event_id", "action") for name, order in orders.items()]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def held_bodies(spark, d):
    return asof.held_on(_dated(spark, d), ["user_id", "body"], F.lit(DAY).cast("date"), ties=("event_id",)).select("user_id", "body")


def redundant_by_balance(spark, d):
    return replay.redundant_by_balance(ledger(spark, d), ["user_id"]).select("user_id", "event_id", "balance")


def redundant_by_lag(spark, d):
    return replay.redundant_by_lag(ledger(spark, d), ["user_id"]).select("user_id", "event_id")


def roster_diff_removals(spark, d):
    e = table(spark, d, "events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    week = lambda a, b: e.filter(F.col("day").between(a, b)).select("event_type", "user_id").distinct()
    return asof.roster_removals(week("2024-01-01", "2024-01-07"), week("2024-01-08", "2024-01-10"), ["event_type"], "user_id")


def _service(spark, d):
    """Per customer and year: order-date span as service range."""
    o = table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return o.groupBy("o_custkey").agg(F.min("day").alias("valid_from"), F.date_add(F.max("day"), 1).alias("valid_to"), F.max("o_orderkey").alias("range_id"))


SERVICE = """svc AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS valid_from, max(CAST(o_orderdate AS DATE)) + 1 AS valid_to,
  max(o_orderkey) AS range_id FROM orders GROUP BY o_custkey)"""


def terminal_service_exits(spark, d):
    return asof.terminal_exits(_service(spark, d), ["o_custkey"], F.lit("2001-06-01").cast("date"), "range_id")


def service_exit_candidates(spark, d):
    exits = asof.terminal_exits(_service(spark, d), ["o_custkey"], F.lit("2001-06-01").cast("date"), "range_id")
    day = F.to_date("o_orderdate")
    events = table(spark, d, "orders").filter(F.col("o_orderstatus").isin("O", "F")).select(
        "o_custkey", F.col("o_orderpriority").alias("body"), day.alias("effective"), day.alias("decision"),
        F.when(F.col("o_orderstatus") == "O", "APPOINTED").otherwise("REMOVED").alias("action"), F.col("o_orderkey").alias("event_id"),
    )
    return asof.exit_candidates(exits, events, "o_custkey", "body").select("o_custkey", "body", "event_id", "exit_date")


def cascade_removals(spark, d):
    """An exit removes the member from every body still held on that day."""
    e = _dated(spark, d)
    exits = e.filter("body = 'error'").groupBy("user_id").agg(F.max("effective").alias("exit_date"))
    met = e.join(exits, "user_id").filter("body <> 'error' AND effective <= exit_date")
    held = asof.latest(met, ["user_id", "body"], [F.col("effective").desc(), F.col("event_id").desc()]).filter("action = 'APPOINTED'")
    return held.select("user_id", "body", F.col("exit_date").alias("effective"), F.lit("REMOVED").alias("action"))


def temporal_name_lookup(spark, d):
    """Line items under the priority in force when they shipped, else the status."""
    o = table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.col("o_orderkey").alias("last_order"))
    dims = o.groupBy("o_custkey", "valid_from", "valid_to").agg(F.max("last_order").alias("last_order"))
    facts = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.date_add(F.to_date("o_orderdate"), -30).alias("day"))
    out = asof.temporal_lookup(facts, dims, "o_custkey", "day", "last_order", F.lit(-1).cast("long"))
    return out.select("o_orderkey", "day", "last_order")


def clip_to_periods(spark, d):
    return asof.clip_join(_service(spark, d).drop("range_id"), years(spark, 1995, 2001), []).select("o_custkey", "period", "valid_from", "valid_to")


def _daily_runs(spark, d):
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("valid_from")).distinct()
    return e.withColumn("valid_to", F.col("valid_from"))


def close_one_day_seams(spark, d):
    return islands.close_seams(_daily_runs(spark, d), ["user_id"])


def gaps_and_islands(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", "o_orderstatus", F.trunc(F.to_date("o_orderdate"), "month").alias("month"))
    months = o.groupBy("o_orderpriority", "month").agg(F.max("o_orderstatus").alias("status"))
    w = Window.partitionBy("o_orderpriority").orderBy("month")
    starts = (F.lag("status").over(w) != F.col("status")) | (F.add_months(F.lag("month").over(w), 1) != F.col("month"))
    found = islands.islands(months, ["o_orderpriority"], ["month"], starts)
    return found.groupBy("o_orderpriority", "status", "island").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def covering_range(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return o.groupBy("o_custkey").agg(F.min("day").alias("valid_from"), F.date_add(F.max("day"), 1).alias("valid_to"))


def boundary_sweep_counts(spark, d):
    return islands.sweep_counts(_intervals(spark, d), [])


def elementary_boundaries(spark, d):
    return islands.boundaries(_intervals(spark, d), ["user_id"])


def merge_adjacent(spark, d):
    return islands.merge_adjacent(_intervals(spark, d).select("user_id", "valid_from", "valid_to"), ["user_id"], [])


def rank_replay_ordered(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", F.when(F.col("l_linenumber") < 7, F.col("l_partkey")).alias("member"), F.to_date("l_shipdate").alias("day"), "l_linenumber", "l_orderkey", "l_extendedprice")
    out = ranking.rank_by_latest(li, ["l_suppkey"], "member", ["day", "l_linenumber", "l_orderkey", "l_extendedprice"])
    return out.filter("member IS NOT NULL").select("l_suppkey", "member", "rank", "unresolved_before")


def rank_replay_anchored(spark, d):
    """Line items of a supplier as evidence on a list: most are put last, some behind another, and now and then the list begins anew."""
    li = table(spark, d, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey")).select(
        "l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("position"), F.when(F.col("l_partkey") % 43 < 40, (F.col("l_partkey") % 43).cast("string")).alias("member"),
        F.when(F.col("l_orderkey") % 3 == 0, ((F.col("l_partkey") + F.col("l_linenumber")) % 40).cast("string")).alias("after"), (F.col("l_orderkey") % 211 == 0).alias("full_roster"),
    )
    return ranking.replay_anchored(li, ["l_suppkey"])


def infer_group_value(spark, d):
    c = table(spark, d, "conversations").withColumn("speaker", F.when(F.col("turn") % 2 == 0, F.col("role")))
    return islands.sole_value(c, ["conv_id"], "speaker").select("conv_id", "turn", "speaker")


def carry_forward(spark, d):
    c = table(spark, d, "conversations").withColumn("mark", F.when(F.col("turn") % 3 == 0, F.col("role")))
    return islands.carry_forward(c, ["conv_id"], ["turn"], "mark", "carried").select("conv_id", "turn", "carried")


def context_window(spark, d):
    c = islands.neighbour_text(table(spark, d, "conversations"), ["conv_id"], ["turn"], "text", 2, "near")
    return c.select("conv_id", "turn", F.sha2("near", 256).alias("near_sha256"))


def integrity_issue_codes(spark, d):
    e = ledger(spark, d).select("event_id", "user_id", "day", "action")
    iv = _intervals(spark, d)
    start = e.select(F.col("event_id").alias("start_event_id"), F.col("day").alias("start_day"), F.col("user_id").alias("start_user"))
    end = e.select(F.col("event_id").alias("end_event_id"), F.col("day").alias("end_day"), F.col("action").alias("end_action"))
    joined = iv.join(start, "start_event_id", "left").join(end, "end_event_id", "left")
    rules = [
        ("start_event_missing", F.col("start_day").isNull()),
        ("start_day_differs", F.col("start_day") != F.col("valid_from")),
        ("owner_differs", F.col("start_user") != F.col("user_id")),
        ("end_event_missing", F.col("end_event_id").isNull()),
        ("end_is_no_removal", F.col("end_action") != "REMOVED"),
        ("one_day", F.date_add("valid_from", 1) == F.col("valid_to")),
    ]
    return scoring.issue_codes(joined, rules).select("user_id", "start_event_id", "issues")


def assignment_export(spark, d):
    """Release rows: inclusive last day, exclusive boundary, whether it ended early."""
    iv = _merged(spark, d)
    early = F.col("valid_to") < F.lit(END).cast("date")
    return iv.select(
        F.lit("1.1.0").alias("schema_version"), "user_id", F.col("valid_from").alias("first_active_date"), last_day(F.col("valid_to")).alias("last_active_date"),
        F.when(early, F.col("valid_to")).alias("termination_effective_date"), early.alias("ended_early"),
    )


_Q = [replay_intervals, replay_intervals_merged, active_on_date, latest_action_asof, tie_break_variants, held_bodies, redundant_by_balance, redundant_by_lag,
      roster_diff_removals, terminal_service_exits, service_exit_candidates, cascade_removals, temporal_name_lookup, clip_to_periods, close_one_day_seams,
      gaps_and_islands, covering_range, boundary_sweep_counts, elementary_boundaries, merge_adjacent, rank_replay_ordered, rank_replay_anchored,
      infer_group_value, carry_forward, context_window, integrity_issue_codes, assignment_export]
QUERIES = {f.__name__: f for f in _Q}

_LATEST = "SELECT user_id, '{v}' AS variant, event_id, action FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {o}) AS n FROM e) WHERE n = 1"
SQL = {
    "replay_intervals": f"WITH {IV} SELECT * FROM iv",
    "replay_intervals_merged": f"WITH {MERGED} SELECT * FROM mv",
    "active_on_date": f"WITH {MERGED} SELECT user_id, start_event_id FROM mv WHERE valid_from <= DATE '{DAY}' AND DATE '{DAY}' < valid_to",
    "latest_action_asof": f"WITH {DATED} SELECT user_id, body, event_id, action FROM dated WHERE effective <= DATE '{DAY}' QUALIFY row_number() OVER (PARTITION BY user_id, body ORDER BY effective DESC, decision DESC, event_id DESC) = 1",
    "tie_break_variants": f"WITH {DATED}, e AS (SELECT * FROM dated WHERE effective <= DATE '{DAY}') " + " UNION ALL ".join(
        _LATEST.format(v=v, o=o) for v, o in (("full", "effective DESC, decision DESC, event_id DESC"), ("short", "effective DESC, event_id DESC"),
        ("removed_wins", "effective DESC, decision DESC, (action = 'REMOVED') DESC, event_id DESC"), ("replay", "effective DESC, CASE action WHEN 'APPOINTED' THEN 1 ELSE 0 END, event_id DESC"))),
    "held_bodies": f"WITH {DATED}, l AS (SELECT * FROM dated WHERE effective <= DATE '{DAY}' QUALIFY row_number() OVER (PARTITION BY user_id, body ORDER BY effective DESC, event_id DESC) = 1) SELECT user_id, body FROM l WHERE action = 'APPOINTED'",
    "redundant_by_balance": f"WITH {LED} SELECT user_id, event_id, balance FROM (SELECT *, CAST(coalesce(sum(CASE action WHEN 'APPOINTED' THEN 1 ELSE -1 END) OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS balance FROM led) WHERE action = 'APPOINTED' AND balance > 0",
    "redundant_by_lag": f"WITH {LED} SELECT user_id, event_id FROM (SELECT *, lag(action) OVER ({ORDER}) AS p FROM led) WHERE action = 'APPOINTED' AND p = 'APPOINTED'",
    "roster_diff_removals": "WITH e AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day FROM events), n AS (SELECT DISTINCT event_type, user_id FROM e WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-10') SELECT DISTINCT event_type, user_id FROM e WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-07' AND event_type IN (SELECT event_type FROM n) AND (event_type, user_id) NOT IN (SELECT event_type, user_id FROM n)",
    "terminal_service_exits": f"WITH {SERVICE} SELECT * FROM svc WHERE valid_to < DATE '2001-06-01'",
    "service_exit_candidates": f"WITH {SERVICE}, x AS (SELECT o_custkey, valid_to AS exit_date FROM svc WHERE valid_to < DATE '2001-06-01') SELECT o_custkey, body, event_id, exit_date FROM (SELECT o.o_custkey, o_orderpriority AS body, o_orderkey AS event_id, exit_date, o_orderstatus, row_number() OVER (PARTITION BY o.o_custkey, o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC, (o_orderstatus = 'F') DESC, o_orderkey DESC) AS n FROM orders o JOIN x ON o.o_custkey = x.o_custkey AND CAST(o_orderdate AS DATE) <= exit_date WHERE o_orderstatus IN ('O', 'F')) WHERE n = 1 AND o_orderstatus = 'O'",
    "cascade_removals": f"WITH {DATED}, x AS (SELECT user_id, max(effective) AS exit_date FROM dated WHERE body = 'error' GROUP BY user_id), l AS (SELECT d.*, exit_date FROM dated d JOIN x USING (user_id) WHERE body <> 'error' AND effective <= exit_date QUALIFY row_number() OVER (PARTITION BY user_id, body ORDER BY effective DESC, event_id DESC) = 1) SELECT user_id, body, exit_date AS effective, 'REMOVED' AS action FROM l WHERE action = 'APPOINTED'",
    "temporal_name_lookup": "WITH f AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) - 30 AS day FROM orders), dim AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, max(o_orderkey) AS last_order FROM orders GROUP BY ALL) SELECT o_orderkey, day, coalesce((SELECT last_order FROM dim WHERE dim.o_custkey = f.o_custkey AND dim.valid_from <= f.day ORDER BY valid_from DESC LIMIT 1), -1) AS last_order FROM f",
    "clip_to_periods": f"WITH {SERVICE}, y AS (SELECT CAST(p AS INTEGER) AS period, make_date(p, 1, 1) AS f, make_date(p + 1, 1, 1) AS t FROM range(1995, 2002) r(p)) SELECT o_custkey, period, greatest(valid_from, f) AS valid_from, least(valid_to, t) AS valid_to FROM svc JOIN y ON valid_from < t AND f < valid_to",
    "close_one_day_seams": "WITH e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS valid_from FROM events) SELECT user_id, valid_from, CASE WHEN valid_from + 1 = lead(valid_from) OVER w THEN lead(valid_from) OVER w ELSE valid_from END AS valid_to FROM e WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)",
    "gaps_and_islands": "WITH m AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, max(o_orderstatus) AS status FROM orders GROUP BY ALL), s AS (SELECT *, CASE WHEN coalesce(lag(status) OVER w <> status OR CAST(lag(month) OVER w + INTERVAL 1 MONTH AS DATE) <> month, true) THEN 1 ELSE 0 END AS s FROM m WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month)), i AS (SELECT *, CAST(sum(s) OVER (PARTITION BY o_orderpriority ORDER BY month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM s) SELECT o_orderpriority, status, island, min(month) AS first_month, max(month) AS last_month FROM i GROUP BY ALL",
    "covering_range": "SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS valid_from, max(CAST(o_orderdate AS DATE)) + 1 AS valid_to FROM orders GROUP BY o_custkey",
    "boundary_sweep_counts": f"WITH {IV}, b AS (SELECT valid_from AS since FROM iv UNION SELECT valid_to FROM iv), p AS (SELECT since, lead(since) OVER (ORDER BY since) AS until FROM b) SELECT since, until, count(*) FILTER (valid_from <= since AND since < valid_to) AS active FROM p, iv WHERE until IS NOT NULL GROUP BY since, until",
    "elementary_boundaries": f"WITH {IV}, b AS (SELECT user_id, valid_from AS since FROM iv UNION SELECT user_id, valid_to FROM iv) SELECT user_id, since, lead(since) OVER (PARTITION BY user_id ORDER BY since) AS until FROM b QUALIFY until IS NOT NULL",
    "merge_adjacent": f"WITH {IV}, s AS (SELECT *, CASE WHEN lag(valid_to) OVER w = valid_from THEN 0 ELSE 1 END AS s FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY valid_from ROWS UNBOUNDED PRECEDING) AS island FROM s) SELECT user_id, min(valid_from) AS valid_from, max(valid_to) AS valid_to FROM i GROUP BY user_id, island",
    "rank_replay_ordered": "WITH o AS (SELECT l_suppkey, CASE WHEN l_linenumber < 7 THEN l_partkey END AS member, CAST(l_shipdate AS DATE) AS day, l_linenumber, l_orderkey, l_extendedprice FROM lineitem), k AS (SELECT * FROM o QUALIFY member IS NULL OR row_number() OVER (PARTITION BY l_suppkey, member ORDER BY day DESC, l_linenumber DESC, l_orderkey DESC, l_extendedprice DESC) = 1), r AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS rank, CAST(sum(CASE WHEN member IS NULL THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS unresolved_before FROM k WINDOW w AS (PARTITION BY l_suppkey ORDER BY day, l_linenumber, l_orderkey, l_extendedprice)) SELECT l_suppkey, member, rank, unresolved_before FROM r WHERE member IS NOT NULL",
    "rank_replay_anchored": """
WITH RECURSIVE o AS (
  SELECT l_suppkey AS s, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS n, CASE WHEN l_partkey % 43 < 40 THEN CAST(l_partkey % 43 AS VARCHAR) ELSE '-' END AS m,
         CASE WHEN l_orderkey % 3 = 0 THEN CAST((l_partkey + l_linenumber) % 40 AS VARCHAR) END AS a, l_orderkey % 211 = 0 AS r FROM (SELECT l_suppkey, l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL)
), f AS (
  SELECT s, n, [m] AS l FROM o WHERE n = 1
  UNION ALL
  SELECT s, n, CASE WHEN ix > 0 THEN list_concat(list_append(rest[:ix], m), rest[ix + 1:]) ELSE list_append(rest, m) END
  FROM (SELECT *, coalesce(list_position(rest, a), 0) AS ix FROM (SELECT o.s, o.n, o.m, o.a, CASE WHEN o.r THEN [] WHEN o.m = '-' THEN f.l ELSE list_filter(f.l, lambda x: x <> o.m) END AS rest FROM f JOIN o ON o.s = f.s AND o.n = f.n + 1))
), last AS (SELECT s, arg_max(l, n) AS l FROM f GROUP BY s)
SELECT s AS l_suppkey, CAST(seq AS BIGINT) AS seq, nullif(member, '-') AS member FROM (SELECT s, unnest(l) AS member, unnest(range(1, len(l) + 1)) AS seq FROM last)""",
    "infer_group_value": "WITH c AS (SELECT *, CASE WHEN turn % 2 = 0 THEN role END AS s FROM conversations) SELECT conv_id, turn, coalesce(s, CASE WHEN min(s) OVER w = max(s) OVER w THEN min(s) OVER w END) AS speaker FROM c WINDOW w AS (PARTITION BY conv_id)",
    "carry_forward": "WITH c AS (SELECT *, CASE WHEN turn % 3 = 0 THEN role END AS m FROM conversations) SELECT conv_id, turn, last_value(m IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS carried FROM c",
    "context_window": "SELECT conv_id, turn, sha256(array_to_string(list_filter(list(text) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), lambda x: length(trim(x)) > 0), chr(10))) AS near_sha256 FROM conversations",
    "integrity_issue_codes": f"WITH {IV}, x AS (SELECT iv.user_id, start_event_id, concat_ws(';', CASE WHEN s.day IS NULL THEN 'start_event_missing' END, CASE WHEN s.day <> valid_from THEN 'start_day_differs' END, CASE WHEN s.user_id <> iv.user_id THEN 'owner_differs' END, CASE WHEN end_event_id IS NULL THEN 'end_event_missing' END, CASE WHEN e.action <> 'REMOVED' THEN 'end_is_no_removal' END, CASE WHEN valid_from + 1 = valid_to THEN 'one_day' END) AS issues FROM iv LEFT JOIN led s ON s.event_id = start_event_id LEFT JOIN led e ON e.event_id = end_event_id) SELECT * FROM x WHERE issues <> ''",
    "assignment_export": f"WITH {MERGED} SELECT '1.1.0' AS schema_version, user_id, valid_from AS first_active_date, valid_to - 1 AS last_active_date, CASE WHEN valid_to < DATE '{END}' THEN valid_to END AS termination_effective_date, valid_to < DATE '{END}' AS ended_early FROM mv",
}
