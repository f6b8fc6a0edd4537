"""Journal pages: marks, carried state, lists over page breaks, both chambers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import pages as pg
from tidemark.operators import islands, journal, spread

KIND = "volume int, page int, text string"


@pytest.mark.parametrize(
    ("text", "members"),
    [
        ("Mr. LOW of Ohio, Ms. Ann B. FERN, Utah, Mr. Ash Mr. Elm and Mrs. LOW", ["Mr. LOW of Ohio", "Ms. FERN of Utah", "Mr. Ash", "Mr. Elm"]),
        ("the Senator from New York, Mr. Reed, and Miss. Pine", ["Mr. Reed of New York", "Ms. Pine"]),
        ("Messrs. Poe of Ohio, Vane, and Oak. A speech by Fern", ["Mr. Poe of Ohio", "Mr. Vane", "Mr. Oak"]),
        ("Mr. LOW and later Mr. Low of Ohio", ["Mr. Low of Ohio"]),
        ("no names of members", []), ("", []), (None, []),
    ],
)
def test_titled_members(spark, text, members):
    assert spark.createDataFrame([(text,)], "t string").select(pg.titled_members(F.col("t")).alias("m")).first().m == members


@pytest.mark.parametrize(
    ("text", "page"),
    [("99999\nOars", 99999), ("100000\nOars", 100000), ("Oars\n 2147483647 \n", 2147483647), ("0000123\nOars", 123), ("2147483648\nOars\n7", 7), ("12a\nOars", None), ("Oars 12\n3 4", None), ("", None), (None, None)],
)
def test_printed_page(spark, text, page):
    assert spark.createDataFrame([(text,)], "t string").select(pg.printed_page(F.col("t")).alias("p")).first().p == page


def rows(df):
    return sorted((r.volume, r.page, r.day, r.body, r.member) for r in df.collect())


def test_lists_go_on_over_pages_and_frames_lapse(spark):
    day = dt.date(2021, 3, 4)
    pages = [
        (1, 1, "March 4, 2021\nCOMMITTEE ELECTION\nCommittee on Oars: Mr.LOW, Mr. McCOY of\nOhio"), (1, 2, "Mr. ASH, and Ms. ELM. A motion to reconsider was laid. Mr. NOT"), (1, 3, "Committee on Sails: Mr. LATE"), (1, 5, "Committee on Sails: Mr. TOOLATE"),
        (2, 1, "Ms. XU was removed from the following standing committees: Committee on Oars: Mr. GONE. March 9, 2021 The Speaker, on the part of the House, appointed as follows. Committee on the Tides—Mr. INN"), (2, 2, None),
        (3, 1, "Committee on Oars: Mr. LOW"), (None, 1, "COMMITTEE ELECTION Committee on Oars: Mr. LOW"), (4, None, "COMMITTEE ELECTION Committee on Oars: Mr. LOW"),
    ]
    got = rows(journal.scan(spark.createDataFrame(pages, KIND), "H"))
    assert got == [
        (1, 1, day, "Committee on Oars", "Mr. LOW"), (1, 1, day, "Committee on Oars", "Mr. McCOY of Ohio"), (1, 2, day, "Committee on Oars", "Mr. ASH"), (1, 2, day, "Committee on Oars", "Ms. ELM"),
        (1, 3, day, "Committee on Sails", "Mr. LATE"), (2, 1, dt.date(2021, 3, 9), "Committee on the Tides", "Mr. INN"),
    ]
    assert not rows(journal.scan(spark.createDataFrame([], KIND), "H"))


def test_senate_pages(spark):
    pages = [
        (1, 1, "January 7, 2021. Resolved, That the following shall constitute the majority party's membership: Committee on Oars: Mr. LOW (Chairman), Mrs. FERN, the Senator from Utah, Mr. REED"), (1, 2, "Mr. VANE. Committee on Sails: Mr. ALONE. MORNING BUSINESS Mr. NOT"),
        (1, 3, "Mr. GONE was relieved from further service: Committee on Nets: Mr. GONE, Mr. AWAY"), (1, 4, "Orders for Committee Service. Committee on Nets: Mr. HERE, Mr. THERE, Ms. Clerk"),
    ]
    got = rows(journal.scan(spark.createDataFrame(pages, KIND), "S"))
    day = dt.date(2021, 1, 7)
    assert got == [
        *((1, 1, day, "Committee on Oars", m) for m in ("Mr. LOW", "Mr. REED of Utah", "Mrs. FERN")), (1, 2, day, "Committee on Oars", "Mr. VANE"),
        (1, 4, day, "Committee on Nets", "Mr. HERE"), (1, 4, day, "Committee on Nets", "Mr. THERE"),
    ]


def test_carried_equals_a_window_for_any_partitioning(spark):
    rng = random.Random(4)
    data = [(rng.randrange(3) if rng.random() < 0.4 else 9, i, rng.choice([None, None, i]), rng.choice([None, "x", "y"])) for i in range(400)]
    df = spark.createDataFrame(data, "k int, n int, a int, b string")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    want = islands.carry_forward(islands.carry_forward(df, ["k"], ["n"], "a", "last_a"), ["k"], ["n"], "b", "last_b")
    want = sorted(map(str, want.collect()))
    try:
        for n in ("1", "3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = spread.carried(df, ["k"], ["n"], {"last_a": F.col("a"), "last_b": F.col("b")})
            assert sorted(map(str, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
