"""Keys, labels, titles, JSON and rendered cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import people as pp
from ..functions import text as tx
from ..sources.tables import table

TITLES = [("(?i)[#$%&*]{3}", "symbols"), ("!! ", "shouting"), (r" \| ", "listing"), ("(?i)^the ", "article")]


def normalize_keys(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("Committee on the "), "c_mktsegment", F.lit(" of "), "c_name").alias("name"))
    return c.select("c_custkey", tx.compact_key(F.col("name")).alias("compact"), tx.name_key(F.col("name")).alias("person"), tx.body_key(F.col("name")).alias("body"))


def strip_suffix(spark, d):
    suffix = F.element_at(F.array(*map(F.lit, (", Jr.", " III", " Sr", ""))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", pp.without_suffix(F.concat("c_name", suffix)).alias("bare"))


def split_members(spark, d):
    names = F.concat("n_name", F.lit(", "), F.lower("n_name"), F.lit("; x and "), "n_name", F.lit(","))
    return table(spark, d, "nation").select("n_nationkey", F.array_join(tx.split_members(names), "/").alias("members"), F.size(tx.split_members(names)).alias("n"))


def parse_label(spark, d):
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.col("c_custkey") % 3
    label = F.when(kind == 0, F.concat("c_name", F.lit(", of "), F.initcap(F.regexp_replace("n_name", "[^A-Za-z]", "")), F.lit("."))).when(kind == 1, F.concat("c_name", F.lit(" (OH-13) CHAIR"))).otherwise(F.lit("Vacant"))
    name, state = tx.label_name_state(label)
    return c.select("c_custkey", name.alias("name"), state.alias("state"))


def classify_titles(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.first_match(F.col("text"), TITLES).alias("kind"))


def extract_all_codes(spark, d):
    codes = F.array_distinct(F.regexp_extract_all("text", F.lit(r"\b([a-z]{4})ing\b"), 1))
    return table(spark, d, "documents").select("doc_id", F.array_join(codes, ",").alias("codes"))


def long_dates(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "'Signed on' MMMM d'th,' yyyy 'here'").alias("t"))
    return o.select("o_orderkey", tx.long_date(F.col("t")).alias("day"))


def json_props(spark, d):
    e = table(spark, d, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(-1)).alias("k"))
    return e


def csv_cells(spark, d):
    """Cells as the canonical CSV has them: ISO dates, true/false, three decimals, '' for null."""
    o = table(spark, d, "orders")
    price = F.when(F.col("o_orderkey") % 11 != 0, F.format_string("%.3f", "o_totalprice"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        (F.col("o_orderstatus") == "F").cast("string").alias("is_final"), F.coalesce(price, F.lit("")).alias("price"),
    )


def metadata_cells(spark, d):
    """A map flattened to 'k=v; ...' by key."""
    m = F.map_from_entries(F.collect_list(F.struct("event_type", F.col("n").cast("string"))))
    counts = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    flat = F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    return counts.groupBy("user_id").agg(m.alias("m")).select("user_id", flat.alias("metadata"))


def line_rules(spark, d):
    """Lines that match a rule table, with their numbers: the release-safety scan."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    hit = tx.first_match(F.col("line"), [(r"(?i)password|secret|api[_-]?key", "secret"), (r"\b\d{3}-\d{2}-\d{4}\b", "number"), (r"[\w.]+@[\w.]+", "address")], "")
    return lines.select("doc_id", (F.col("pos") + 1).alias("line_no"), hit.alias("kind")).filter("kind <> ''")


_Q = [normalize_keys, strip_suffix, split_members, parse_label, classify_titles, extract_all_codes, long_dates, json_props, csv_cells, metadata_cells, line_rules]
QUERIES = {f.__name__: f for f in _Q}

_NAME = "'Committee on the ' || c_mktsegment || ' of ' || c_name"
SQL = {
    "normalize_keys": f"SELECT c_custkey, regexp_replace(lower({_NAME}), '[^a-z0-9]+', '', 'g') AS compact, trim(regexp_replace(lower({_NAME}), '[^a-z]+', ' ', 'g')) AS person, regexp_replace(lower(c_mktsegment || ' of ' || c_name), '[^a-z0-9]+', '', 'g') AS body FROM customer",
    "strip_suffix": "SELECT c_custkey, c_name AS bare FROM customer",
    "split_members": "SELECT n_nationkey, n_name || '/' || lower(n_name) || '/x/' || n_name AS members, 4 AS n FROM nation",
    "parse_label": "SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN c_name END AS name, CASE c_custkey % 3 WHEN 0 THEN upper(n_name[1]) || lower(regexp_replace(n_name, '[^A-Za-z]', '', 'g')[2:]) WHEN 1 THEN 'OH' END AS state FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "classify_titles": r"SELECT doc_id, CASE WHEN regexp_matches(text, '[#$%&*]{3}') THEN 'symbols' WHEN contains(text, '!! ') THEN 'shouting' WHEN contains(text, ' | ') THEN 'listing' WHEN starts_with(lower(text), 'the ') THEN 'article' ELSE 'other' END AS kind FROM documents",
    "extract_all_codes": r"WITH c AS (SELECT doc_id, regexp_extract_all(text, '\b([a-z]{4})ing\b', 1) AS l FROM documents), u AS (SELECT doc_id, unnest(l) AS code, unnest(range(len(l))) AS i FROM c), f AS (SELECT doc_id, code, min(i) AS i FROM u GROUP BY ALL) SELECT c.doc_id, coalesce(string_agg(code, ',' ORDER BY f.i), '') AS codes FROM c LEFT JOIN f USING (doc_id) GROUP BY c.doc_id",
    "long_dates": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders",
    "json_props": "SELECT event_id, coalesce(CAST(props ->> '$.k' AS BIGINT), -1) AS k FROM events",
    "csv_cells": "SELECT CAST(o_orderkey AS VARCHAR) AS order_key, strftime(o_orderdate, '%Y-%m-%d') AS order_date, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS is_final, CASE WHEN o_orderkey % 11 <> 0 THEN printf('%.3f', o_totalprice) ELSE '' END AS price FROM orders",
    "metadata_cells": "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, string_agg(event_type || '=' || n, '; ' ORDER BY event_type) AS metadata FROM c GROUP BY user_id",
    "line_rules": r"WITH l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)), k AS (SELECT doc_id, CAST(n AS INTEGER) AS line_no, CASE WHEN regexp_matches(line, '(?i)password|secret|api[_-]?key') THEN 'secret' WHEN regexp_matches(line, '\b\d{3}-\d{2}-\d{4}\b') THEN 'number' WHEN regexp_matches(line, '[\w.]+@[\w.]+') THEN 'address' ELSE '' END AS kind FROM l) SELECT * FROM k WHERE kind <> ''",
}
