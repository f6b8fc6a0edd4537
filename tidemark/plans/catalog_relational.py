"""Provenance, constraints, upserts, scores and gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import ledger as led
from ..operators import scoring
from ..sources.tables import table


def source_survivors(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("content_hash"))
    return led.survivors(docs, ["content_hash"], "doc_id").filter("doc_id <> keep_id")


def repoint_refs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    mapping = led.survivors(docs, ["content_hash"], "doc_id").filter("doc_id <> keep_id")
    return led.repoint(table(spark, d, "labels"), mapping, "doc_id", "doc_id")


def ref_counts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    mapping = led.survivors(docs, ["content_hash"], "doc_id").filter("doc_id <> keep_id")
    refs = table(spark, d, "labels").join(mapping, "doc_id")
    return refs.groupBy("keep_id").agg(F.count("*").alias("n_refs"))


def conflicting_documents(spark, d):
    docs = table(spark, d, "documents").withColumn("content_hash", F.sha2("text", 256))
    return led.conflicts(docs, ["content_hash"], ["source", "lang"])


def nullsafe_duplicates(spark, d):
    o = table(spark, d, "orders").withColumn("k", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")))
    return led.duplicates(o, ["k", "o_orderpriority"])


def overlap_violations(spark, d):
    day = F.to_date("o_orderdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", day.alias("valid_from"), F.date_add(day, 60).alias("valid_to"))
    return led.overlap_violations(o, ["o_custkey"], ["o_orderkey"]).select("o_orderkey", "o_custkey", "valid_from", "next_from")


def fk_orphans(spark, d):
    o = table(spark, d, "orders").filter("o_orderkey % 7 <> 0")
    return led.orphans(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), o, "l_orderkey", "o_orderkey")


def vocab_violations(spark, d):
    rule = F.col("o_orderstatus").isin("O", "F") & F.col("o_orderpriority").rlike("^[1-5]-[A-Z ]+$")
    return led.violations(table(spark, d, "orders"), rule).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _halves(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    old = o.filter("o_orderkey % 3 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")))
    return old, o.filter("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lower("o_orderstatus"))


HALVES = "o AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders), old AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS o_orderstatus FROM o WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus FROM o WHERE o_orderkey % 2 = 0)"


def upsert_overwrite(spark, d):
    return led.upsert(*_halves(spark, d), ["o_orderkey"])


def upsert_fill_null(spark, d):
    return led.upsert_fill(*_halves(spark, d), ["o_orderkey"])


def insert_ignore(spark, d):
    return led.insert_ignore(*_halves(spark, d), ["o_orderkey"])


def reconcile_ids(spark, d):
    o = table(spark, d, "orders").select(ids.piped_id(F.col("o_orderkey"), F.col("o_orderstatus")).alias("id"), "o_orderkey")
    return led.reconcile(o.filter("o_orderkey % 3 <> 0"), o.filter("o_orderkey % 2 = 0"), "id")


def cascade_delete(spark, d):
    """Line items whose order was found stale go."""
    stale = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").join(stale, "l_orderkey", "left_anti").groupBy("l_returnflag").agg(F.count("*").alias("n"))


def _sides(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.col("event_type").alias("scope"), F.weekofyear("ts").alias("week"))
    cell = ["week", "scope"]
    return scoring.compare_sets(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1"), [*cell, "user_id"])


SIDES = "e AS (SELECT event_id, user_id, event_type AS scope, CAST(weekofyear(ts) AS INTEGER) AS week FROM events), l AS (SELECT DISTINCT week, scope, user_id, 1 AS x FROM e WHERE event_id % 2 = 0), r AS (SELECT DISTINCT week, scope, user_id, 1 AS y FROM e WHERE event_id % 2 = 1), sides AS (SELECT week, scope, user_id, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 'both' WHEN x IS NOT NULL THEN 'directory_only' ELSE 'observed_only' END AS side FROM l FULL JOIN r USING (week, scope, user_id))"
SCORES = SIDES + ", c AS (SELECT week, scope, count(*) FILTER (side = 'both') AS n_both, count(*) FILTER (side = 'directory_only') AS n_directory_only, count(*) FILTER (side = 'observed_only') AS n_observed_only FROM sides GROUP BY ALL), scores AS (SELECT *, CASE WHEN n_both + n_directory_only <> 0 THEN round_even(n_both::DOUBLE / (n_both + n_directory_only) * 100, 3) END AS coverage_pct, CASE WHEN n_both + n_observed_only <> 0 THEN round_even(n_both::DOUBLE / (n_both + n_observed_only) * 100, 3) END AS observed_pct, CASE WHEN n_both + n_directory_only = 0 THEN 'NO_REFERENCE' WHEN n_both >= 0.9 * (n_both + n_directory_only) THEN 'PASS' ELSE 'FAIL' END AS gate_status FROM c)"


def overlap_scores(spark, d):
    return scoring.overlap_scores(_sides(spark, d), ["week", "scope"], 0.9)


def mismatch_rows(spark, d):
    return _sides(spark, d).filter("side <> 'both'")


def gate_missing_cells(spark, d):
    scores = scoring.overlap_scores(_sides(spark, d), ["week", "scope"], 0.9)
    weeks = spark.range(1, 8).select(F.col("id").cast("int").alias("week"))
    scopes = spark.createDataFrame([(s,) for s in ("signup", "error", "click", "view", "purchase")], "scope string")
    required = weeks.crossJoin(F.broadcast(scopes))  # two literal dimensions
    return scoring.gate_failures(required, scores, ["week", "scope"])


def ordered_string_agg(spark, d):
    kinds = F.array_sort(F.collect_set("event_type"))
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(kinds, "; ").alias("kinds"))


def event_ids(spark, d):
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus"))
    return o.select("o_orderkey", ids.piped_id(F.col("o_orderkey"), F.to_date("o_orderdate"), status).alias("event_id"))


def json_ids(spark, d):
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus"))
    return o.select("o_orderkey", ids.json_id(key=F.col("o_orderkey"), status=status, cust=F.col("o_custkey")).alias("json_id"))


def release_ids(spark, d):
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus"))
    return o.select("o_orderkey", ids.release_id("evt", F.col("o_orderkey"), status).alias("release_id"))


def propagate_group_flag(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    flags = rows.groupBy(F.col("source").alias("s")).agg(F.max(F.coalesce("toxic", F.lit(0))).alias("group_flag"))
    flags = F.broadcast(flags) if flags.limit(100_001).count() <= 100_000 else flags
    return rows.join(flags, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "group_flag")


def zero_row_sources(spark, d):
    """Required sources without a row."""
    required = spark.createDataFrame([(f"src{i}",) for i in range(0, 30)], "source string")
    return required.join(table(spark, d, "documents").select("source"), "source", "left_anti")


def semi_filter_members(spark, d):
    used = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(used, "c_custkey", "left_semi").select("c_custkey", "c_name")


def observed_snapshot(spark, d):
    """Distinct members active on the day, among groups that the snapshot lists."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.to_date("l_shipdate").alias("a"))
    active = li.filter((F.col("a") <= F.lit("1998-06-01")) & (F.lit("1998-06-01").cast("date") < F.date_add("a", 90)))
    listed = table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return active.join(listed, "l_suppkey", "left_semi").select("l_suppkey", "l_partkey").distinct()


def resolve_entities(spark, d):
    """Customers by the last three digits of their name, narrowed by nation, then segment."""
    c = table(spark, d, "customer").select("c_custkey", F.substring("c_name", -3, 3).alias("last"), "c_nationkey", "c_mktsegment")
    q = c.select(F.col("c_custkey").alias("q"), "last", "c_nationkey", "c_mktsegment")
    return scoring.narrowed_lookup(q, c, ["last"], ["c_nationkey", "c_mktsegment"], "q", "c_custkey")


def snapshot_replace(spark, d):
    old, new = _halves(spark, d)
    return led.replace_snapshot(old, new, ["o_orderkey"], ["o_custkey"])


_Q = [source_survivors, repoint_refs, ref_counts, conflicting_documents, nullsafe_duplicates, overlap_violations, fk_orphans, vocab_violations, upsert_overwrite,
      upsert_fill_null, insert_ignore, reconcile_ids, cascade_delete, overlap_scores, mismatch_rows, gate_missing_cells, ordered_string_agg, event_ids, json_ids,
      release_ids, propagate_group_flag, zero_row_sources, semi_filter_members, observed_snapshot, resolve_entities, snapshot_replace]
QUERIES = {f.__name__: f for f in _Q}

_MAP = "m AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS keep_id FROM documents)"
SQL = {
    "source_survivors": f"WITH {_MAP} SELECT * FROM m WHERE doc_id <> keep_id",
    "repoint_refs": f"WITH {_MAP} SELECT coalesce(keep_id, l.doc_id) AS doc_id, quality, toxic FROM labels l LEFT JOIN m ON m.doc_id = l.doc_id AND m.doc_id <> m.keep_id",
    "ref_counts": f"WITH {_MAP} SELECT keep_id, count(*) AS n_refs FROM labels JOIN m USING (doc_id) WHERE doc_id <> keep_id GROUP BY keep_id",
    "conflicting_documents": "SELECT sha256(text) AS content_hash, count(DISTINCT (source, lang)) AS variants FROM documents GROUP BY 1 HAVING variants > 1",
    "nullsafe_duplicates": "SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS k, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING n > 1",
    "overlap_violations": "SELECT * FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS valid_from, lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS next_from FROM orders) WHERE next_from < valid_from + 60",
    "fk_orphans": "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0)",
    "vocab_violations": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE NOT (o_orderstatus IN ('O', 'F') AND regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$'))",
    "upsert_overwrite": f"WITH {HALVES} SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new",
    "upsert_fill_null": f"WITH {HALVES} SELECT o_orderkey, coalesce(old.o_custkey, new.o_custkey) AS o_custkey, coalesce(old.o_orderstatus, new.o_orderstatus) AS o_orderstatus FROM old FULL JOIN new USING (o_orderkey)",
    "insert_ignore": f"WITH {HALVES} SELECT * FROM old UNION ALL SELECT * FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)",
    "reconcile_ids": "WITH o AS (SELECT sha256(o_orderkey || '|' || o_orderstatus) AS id, o_orderkey FROM orders), e AS (SELECT id FROM o WHERE o_orderkey % 3 <> 0), w AS (SELECT id FROM o WHERE o_orderkey % 2 = 0) SELECT DISTINCT id, 'stale' AS side FROM e WHERE id NOT IN (SELECT id FROM w) UNION ALL SELECT DISTINCT id, 'missing' FROM w WHERE id NOT IN (SELECT id FROM e)",
    "cascade_delete": "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1",
    "overlap_scores": f"WITH {SCORES} SELECT * FROM scores",
    "mismatch_rows": f"WITH {SIDES} SELECT week, scope, user_id, side FROM sides WHERE side <> 'both'",
    "gate_missing_cells": f"WITH {SCORES}, need AS (SELECT CAST(w AS INTEGER) AS week, scope FROM range(1, 8) r(w), (VALUES ('signup'), ('error'), ('click'), ('view'), ('purchase')) v(scope)) SELECT week, scope, coalesce(gate_status, 'MISSING_CELL') AS reason FROM need LEFT JOIN scores USING (week, scope) WHERE coalesce(gate_status, 'MISSING_CELL') <> 'PASS'",
    "ordered_string_agg": "SELECT user_id, string_agg(DISTINCT event_type, '; ' ORDER BY event_type) AS kinds FROM events GROUP BY user_id",
    "event_ids": "SELECT o_orderkey, sha256(o_orderkey || '|' || CAST(o_orderdate AS DATE) || '|' || CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus ELSE 'None' END) AS event_id FROM orders",
    "json_ids": "SELECT o_orderkey, sha256('{\"cust\":' || o_custkey || ',\"key\":' || o_orderkey || ',\"status\":' || CASE WHEN o_orderkey % 9 <> 0 THEN '\"' || o_orderstatus || '\"' ELSE 'null' END || '}') AS json_id FROM orders",
    "release_ids": "SELECT o_orderkey, 'evt:' || substr(sha256(o_orderkey || '|' || CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus ELSE '' END), 1, 24) AS release_id FROM orders",
    "propagate_group_flag": "SELECT doc_id, max(coalesce(toxic, 0)) OVER (PARTITION BY source) AS group_flag FROM documents LEFT JOIN labels USING (doc_id)",
    "zero_row_sources": "SELECT 'src' || i AS source FROM range(0, 30) r(i) WHERE 'src' || i NOT IN (SELECT source FROM documents)",
    "semi_filter_members": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "observed_snapshot": "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '1998-06-01' AND DATE '1998-06-01' < CAST(l_shipdate AS DATE) + 90 AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
    "resolve_entities": "WITH m AS (SELECT q.c_custkey AS q, c.c_custkey, q.c_nationkey = c.c_nationkey AS a, q.c_mktsegment = c.c_mktsegment AS b FROM customer q JOIN customer c ON right(q.c_name, 3) = right(c.c_name, 3)), n1 AS (SELECT * FROM m QUALIFY a OR NOT bool_or(a) OVER (PARTITION BY q)), n2 AS (SELECT * FROM n1 QUALIFY b OR NOT bool_or(b) OVER (PARTITION BY q)) SELECT q, min(c_custkey) AS c_custkey FROM n2 GROUP BY q HAVING count(DISTINCT c_custkey) = 1",
    "snapshot_replace": f"WITH {HALVES} SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) AND o_custkey NOT IN (SELECT o_custkey FROM new) UNION ALL SELECT * FROM new",
}
