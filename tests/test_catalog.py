"""Every query with SQL against DuckDB on the smallest tables."""

import decimal
import os
import time

import duckdb
import pytest

from tidemark.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    expected = con.sql(catalog.SQL[name])
    columns = sorted(expected.columns)
    got = catalog.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == columns
    at = [expected.columns.index(c) for c in columns]
    assert ordered(got.select(columns).collect()) == ordered([r[i] for i in at] for r in expected.fetchall())


def test_page_gates_equal_sql_for_every_surname(spark, tmp_path):
    """Every segment, nation and form, so that surnames which are stopwords of the gate come up."""
    con = duckdb.connect()
    segments = [r[0] for r in con.sql(f"SELECT DISTINCT c_mktsegment FROM '{DATA}/customer.parquet'").fetchall()]
    rows = [(s, n) for s in sorted({*segments, "HOUSEHOLD"}) for n in range(25)]
    made = spark.range(156 * len(rows)).selectExpr("id AS c_custkey", f"CAST(floor(id / 156) AS INT) % {len(rows)} AS i")
    made = made.join(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c_mktsegment string, c_nationkey int"), "i").drop("i")
    made.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    expected = con.sql(catalog.SQL["page_gates"]).fetchall()
    assert ordered(catalog.QUERIES["page_gates"](spark, str(tmp_path)).collect()) == ordered(expected)


def test_text_events_of_many_customers_in_one_file(spark, tmp_path):
    """Each text is folded once for a row, and the rows of one row group by all cores."""
    spark.range(40000).selectExpr("id AS c_custkey", "concat('Customer#', lpad(id, 9, '0')) AS c_name").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    expected = con.sql(catalog.SQL["text_events"])
    columns, rows, began = expected.columns, expected.fetchall(), time.monotonic()
    got = catalog.QUERIES["text_events"](spark, str(tmp_path)).select(columns).collect()
    assert ordered(got) == ordered(rows)
    assert time.monotonic() - began < 80


def test_every_customer_is_resolved(spark):
    """By an own loop over all customers."""
    customers = duckdb.sql(f"SELECT c_custkey, right(c_name, 3), c_nationkey, c_mktsegment FROM '{DATA}/customer.parquet'").fetchall()
    expected = set()
    for key, last, nation, segment in customers:
        left = [c for c in customers if c[1] == last]
        left = [c for c in left if c[2] == nation] or left
        left = [c for c in left if c[3] == segment] or left
        if len({c[0] for c in left}) == 1:
            expected.add((key, left[0][0]))
    got = {(r.q, r.c_custkey) for r in catalog.QUERIES["resolve_entities"](spark, DATA).collect()}
    assert any(q % 2 for q, _ in expected) and got == expected
