"""Journal pages made of the pages table, with a page-by-page recursion as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import journal as jn
from ..sources.tables import table

#: Pages of one volume.
VOLUME = 50
#: Body of a page's heading, by page_id.
HEADINGS = ["Committee on Rules", "Committee on the Tides", "Permanent Select Committee on Signals", "Committee on Banking, Housing, and Urban Affairs"]


def journal_pages(spark, d):
    """Each page gets a date, a frame, a heading with two names or a stop, and two names that go on with a list."""
    p = table(spark, d, "pages").selectExpr("CAST(page_id AS BIGINT) AS p", "regexp_replace(coalesce(html, ''), '<[^>]*>|[^a-z ]', ' ') AS prose", "regexp_extract_all(coalesce(html, ''), '[a-z]{4,9}', 0) AS w")
    for i, n in enumerate("abcd"):
        p = p.withColumn(n, F.concat(F.lit(f"Q{n.upper()}"), F.coalesce(F.get("w", F.lit(7 * i + 9)), F.lit("name"))))
    heading = F.get(F.array(*map(F.lit, HEADINGS)), (F.col("p") % len(HEADINGS)).cast("int"))
    day = F.date_format(F.expr("date_add(DATE '2019-01-01', CAST(p % 900 AS INT))"), "MMMM d, yyyy")
    text = F.concat(
        F.when(F.col("p") % 5 == 0, F.concat(F.lit("THE JOURNAL\n"), day, F.lit("\n"))).otherwise(""),
        F.when(F.col("p") % 6 == 0, "The Speaker, on the part of the House,\nappointed these Members:\n").when(F.col("p") % 12 == 9, "They were removed from the following standing com-\nmittees:\n").otherwise(""),
        F.when(F.col("p") % 4 == 0, F.concat(heading, F.lit(": Mr."), "a", F.lit(", Mr. "), "b", F.lit("of Ohio,\n"))).when(F.col("p") % 8 == 2, "A motion to reconsider\nwas laid on the table.\n").otherwise(""),
        F.when(F.col("p") % 3 == 1, F.concat(F.lit("Ms. "), "c", F.lit(" of New York, Mr. "), "d", F.lit(".\n"))).otherwise(""),
        "prose",
    )
    pages = p.select(F.floor(F.col("p") / VOLUME).alias("volume"), F.col("p").alias("page"), text.alias("text"))
    return jn.scan(pages, "H")


_NAMES_SQL = ", ".join(f"'Q{n.upper()}' || coalesce(regexp_extract_all(coalesce(html, ''), '[a-z]{{4,9}}')[{7 * i + 10}], 'name') AS {n}" for i, n in enumerate("abcd"))
_HEADINGS_SQL = "[" + ", ".join(f"'{h}'" for h in HEADINGS) + "]"
SQL = {
    "journal_pages": f"""
WITH RECURSIVE g AS (
  SELECT page_id AS p, page_id // {VOLUME} AS v, row_number() OVER (PARTITION BY page_id // {VOLUME} ORDER BY page_id) AS n, {_NAMES_SQL} FROM pages
), s AS (
  SELECT g.*, CASE WHEN p % 5 = 0 THEN DATE '2019-01-01' + CAST(p % 900 AS INTEGER) END AS day, CASE WHEN p % 6 = 0 THEN 'A' WHEN p % 12 = 9 THEN 'E' END AS fk, CASE WHEN p % 6 = 0 OR p % 12 = 9 THEN p END AS fp,
         CASE WHEN p % 4 = 0 THEN {_HEADINGS_SQL}[p % {len(HEADINGS)} + 1] WHEN p % 8 = 2 THEN '' END AS body FROM g WHERE n = 1
  UNION ALL
  SELECT g.*, CASE WHEN g.p % 5 = 0 THEN DATE '2019-01-01' + CAST(g.p % 900 AS INTEGER) ELSE s.day END, CASE WHEN g.p % 6 = 0 THEN 'A' WHEN g.p % 12 = 9 THEN 'E' ELSE s.fk END, CASE WHEN g.p % 6 = 0 OR g.p % 12 = 9 THEN g.p ELSE s.fp END,
         CASE WHEN g.p % 4 = 0 THEN {_HEADINGS_SQL}[g.p % {len(HEADINGS)} + 1] WHEN g.p % 8 = 2 THEN '' ELSE s.body END FROM s JOIN g ON g.v = s.v AND g.n = s.n + 1
), named AS (
  SELECT v, p, day, body, unnest(list_concat(CASE WHEN p % 4 = 0 THEN ['Mr. ' || a, 'Mr. ' || b || ' of Ohio'] ELSE [] END, CASE WHEN p % 3 = 1 THEN ['Ms. ' || c || ' of New York', 'Mr. ' || d] ELSE [] END)) AS member
  FROM s WHERE body <> '' AND fk = 'A' AND p - fp <= 3
)
SELECT v AS volume, min(p) AS page, day, body, member, 'H' || min(p) AS place FROM named GROUP BY v, day, body, member
"""
}
QUERIES = {f.__name__: f for f in (journal_pages,)}
