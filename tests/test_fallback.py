"""Ordered attempts of bodies and Senators' names, by hand-made cases and against plain loops."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fallback as fb


@pytest.mark.parametrize(
    ("name", "index", "matcher"),
    [
        ("Committee on the Tides:", "tides", "tides"), ("Joint Committee on the Library", "jointcommitteeonthelibrary", "library"), ("Standing Committee on Oars", "standingcommitteeonoars", "oars"),
        ("COMMITTEE  OF THE WHOLE", "whole", "whole"), ("Select Committee on Seamen’s Aid.", "selectcommitteeonseamensaid", "seamen's aid"), ("the Oars", "oars", "the oars"), ("Committee on :", "committeeon", None), ("", "", None), (None, None, None),
    ],
)
def test_keys(spark, name, index, matcher):
    row = spark.createDataFrame([(name,)], "n string").select(fb.index_key(F.col("n")), fb.matcher_key(F.col("n"))).first()
    assert tuple(row) == (index, matcher)


RECORDS = "code string, name string, other_names array<string>, congresses array<int>, start_year int, end_year int"


def test_attempts_in_their_order(spark):
    records = [
        ("HSOA", "House Committee on Oars", ["Committee on Oars", "Rowing"], None, None, None), ("SSOA", "Committee on Oars", None, None, None, None), ("HSTI", "Committee on Tides", None, [113], None, None),
        ("HSX1", "Committee on Nets", None, None, None, None), ("HSX2", "Committee on Nets", None, None, None, None), ("JLIB", "Library", None, None, 2000, 2010), (None, "Nobody", None, None, None, None), ("HSNO", None, None, None, None, None),
    ]
    index = fb.body_index(spark.createDataFrame(records, RECORDS))
    assert {(r.key, r.code) for r in index.filter("code = 'HSOA'").collect()} == {("housecommitteeonoars", "HSOA"), ("oars", "HSOA"), ("rowing", "HSOA")}
    aliases = spark.createDataFrame([(113, "oarsmen", "rowing"), (113, "oars", "tides")], "congress int, key string, stands_for string")
    named = spark.createDataFrame([("H", "nets", "HSNE", 1), ("J", "library", "JSLB", 1), ("H", "sea, sand", "HSSS", 2), ("H", "seasand", "HSS3", 3), ("S", "tides", "SSTI", 1), ("J", "fog's end", "JSFO", 2)], "scope string, key string, code string, place int")
    asked = [
        (1, 113, "H", "Committee on Oars", ("HSOA", 1)), (2, 113, "S", "Senate Committee on Oars", ("SSOA", 2)), (3, 113, "H", "House Rowing", ("HSOA", 2)), (4, 113, "H", "Oarsmen", ("HSOA", 1)), (5, 114, "H", "Oarsmen", None),
        (6, 114, "H", "Committee on Tides", None), (7, 114, "S", "Committee on Tides", ("SSTI", 3)), (8, 113, "H", "Committee on Nets", ("HSNE", 3)), (9, 113, "H", "House Committee on Nets", ("HSNE", 7)),
        (10, 113, "H", "Library", ("JSLB", 4)), (11, 110, "H", "Library", ("JLIB", 1)), (12, 113, "H", "Committee on SeaSand", ("HSS3", 3)), (13, 113, "H", "Committee on Sea Sand", ("HSSS", 5)), (14, 113, "S", "Fogs  End", ("JSFO", 6)), (15, 113, "H", None, None), (16, 113, "H", "", None),
    ]
    rows = fb.resolve_bodies_fallback(spark.createDataFrame([a[:4] for a in asked], "id int, congress int, chamber string, text string"), index, aliases, named).collect()
    assert {r.id: (r.code, r.attempt) for r in rows} == {a[0]: a[4] for a in asked if a[4]}


@pytest.mark.parametrize(
    ("raw", "name", "state"),
    [
        ("Mr. Udall of Colorado", "Udall", "CO"), ("Ms. Van Hollen (Chair) (MD)", "Van Hollen", "MD"), ("Mr. Reed (md) (Vice Chair) (NV), ", "Reed", "NV"), ("Low (Acting)", "Low", None), ("Senator Núñez of Nowhere", "Núñez", None),
        ("Mr. Low of Ohio (TX)", "Low", "TX"), ("(OH)", "", "OH"), ("", "", None), (None, None, None),
    ],
)
def test_peeled(spark, raw, name, state):
    assert tuple(spark.createDataFrame([(raw,)], "r string").select(*fb.peeled(F.col("r"))).first()) == (name, state)


def test_senators(spark):
    members = [
        (113, "A", "Van Hollen", "MD", "M", 100), (113, "B", "Hollen", "MD", "F", 200), (113, "C", "Reed", "RI", "M", 100), (113, "D", "Reed", "NV", "M", 200), (113, "E", "Reed", "NV", "F", 200), (114, "F", "Low", "OH", "M", 100), (113, "G", "Núñez", "TX", None, 328),
    ]
    asked = [
        (1, "Mr. Van Hollen (MD)", None, ("A", 1, "name")), (2, "Ms. Ann Hollen", None, ("B", 1, "name")), (3, "Reed", None, (None, 3, None)), (4, "Ms. Reed", None, ("E", 3, "gender")), (5, "Mr. Reed", None, (None, 3, None)), (6, "Mr. Reed", [100, 328], ("C", 3, "party")),
        (7, "Mr. Reed of Nevada", None, ("D", 2, "gender")), (8, "Reed", [200], (None, 3, None)), (9, "Low", None, (None, 0, None)), (10, "Nunez", None, (None, 0, None)), (11, "reed", None, (None, 0, None)), (12, "Mrs. Núñez", [200], ("G", 1, "name")), (13, "", None, (None, 0, None)), (14, None, None, (None, 0, None)),
    ]
    got = fb.resolve_senators(
        spark.createDataFrame([(i, 113, raw, parties) for i, raw, parties, _ in asked], "id int, congress int, raw string, parties array<int>"), spark.createDataFrame(members, "congress int, member string, last_name string, state string, gender string, party int")
    )
    assert {r.id: (r.member, r.candidates, r.by) for r in got.collect()} == {i: want for i, _, _, want in asked}


def test_senators_against_a_loop(spark):
    rng = random.Random(2)
    members = [(113, f"m{i}", rng.choice(["Ash", "Elm", "De Ash", "Fern Elm"]), rng.choice(["OH", "TX"]), rng.choice(["M", "F", None]), rng.choice([100, 200])) for i in range(12)]
    asked = [(i, 113, rng.choice(["Mr. ", "Ms. ", ""]) + rng.choice(["", "Jo "]) + rng.choice(["Ash", "De Ash", "Fern Elm"]) + rng.choice(["", " (OH)", " of Texas"]), rng.choice([None, [100], [100, 200]])) for i in range(80)]
    want = {}
    for i, _, raw, parties in asked:
        gender = "M" if raw.startswith("Mr.") else "F" if raw.startswith("Ms.") else None
        state = "OH" if "(OH)" in raw else "TX" if "Texas" in raw else None
        core = raw.replace("Mr. ", "").replace("Ms. ", "").replace(" (OH)", "").replace(" of Texas", "")
        rows = []
        for form in (core, core.split()[-1]):
            rows = rows or [m for m in members if m[2] == form and state in (None, m[3])]
        member = rows[0][1] if len(rows) == 1 else None
        if len(rows) > 1:
            left = [m for m in rows if gender and m[4] == gender] or rows
            sided = [m for m in left if parties and m[5] in parties]
            alike = [m for m in rows if gender and m[4] == gender]
            member = alike[0][1] if len(alike) == 1 else sided[0][1] if len(sided) == 1 else None
        want[i] = (member, len(rows))
    got = fb.resolve_senators(spark.createDataFrame(asked, "id int, congress int, raw string, parties array<int>"), spark.createDataFrame(members, "congress int, member string, last_name string, state string, gender string, party int"))
    assert {r.id: (r.member, r.candidates) for r in got.collect()} == want


def test_senators_of_several_states_and_alike(spark):
    """A member with rows of two States is one candidate, met by either; members alike in all are still as many; rows of one question keep their ids."""
    members = [(113, "A", "Ash", "OH", "M", 100), (113, "A", "Ash", "TX", "M", 100), (113, "B", "Elm", "OH", "F", 200), (113, "C", "Elm", "OH", "F", 200), (113, "E", "Elm", None, None, 100), (113, "F", "Oak", "UT", "M", 100), (113, "F", "Oak", "UT", "M", 200)]
    asked = [
        (1, "Ash", None, ("A", 1, "name")), (2, "Ash", None, ("A", 1, "name")), (3, "Ash of Texas", None, ("A", 1, "name")), (4, "Ash (UT)", None, (None, 0, None)), (5, "Elm", [100], ("E", 3, "party")), (6, "Ms. Elm", [100], (None, 3, None)), (7, "Elm (OH)", [200], (None, 2, None)),
        (8, "Mr. Oak", None, (None, 2, None)), (9, "Mr. Oak", [200, None], ("F", 2, "party")), (10, "Mr. Elm", [100], ("E", 3, "party")),
    ]
    got = fb.resolve_senators(
        spark.createDataFrame([(i, 113, raw, parties) for i, raw, parties, _ in asked], "id int, congress int, raw string, parties array<int>"), spark.createDataFrame(members, "congress int, member string, last_name string, state string, gender string, party int")
    )
    assert {r.id: (r.member, r.candidates, r.by) for r in got.collect()} == {i: want for i, _, _, want in asked}


def test_many_senators_of_one_surname(spark):
    """40,000 rows under a surname that 3,000 members share are no 120,000,000 pairs."""
    began = time.monotonic()
    held = spark.range(3000).selectExpr("113 AS congress", "concat('m', lpad(id, 4, '0')) AS member", "'Ash' AS last_name", "IF(id % 2 = 0, 'OH', 'TX') AS state", "IF(id = 9, 'F', 'M') AS gender", "IF(id = 4, 100, 200) AS party")
    asked = spark.range(40000).selectExpr("id", "113 AS congress", "element_at(array('Ms. Ash', 'Ash (OH)', 'Mr. Jo Ash', 'Ms. Elm'), CAST(id % 4 AS INT) + 1) AS raw", "IF(id % 4 = 1, array(100), NULL) AS parties")
    got = fb.resolve_senators(asked, held).groupBy(F.col("id") % 4, "member", "form", "candidates", "by").count().collect()
    assert {tuple(r) for r in got} == {(0, "m0009", "Ash", 3000, "gender", 10000), (1, "m0004", "Ash", 1500, "party", 10000), (2, None, "Ash", 3000, None, 10000), (3, None, None, 0, None, 10000)}
    assert time.monotonic() - began < 60
