"""Names, resolution, anchored ranks, policies and pages on small made-up rows."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import pages as pg
from tidemark.functions import people as pp
from tidemark.operators import pick, resolve
from tidemark.operators import rank_intervals as ri
from tidemark.sources import manifest as mf

D = dt.date
MEMBER = "scope int, member string, first_name string, nickname string, last_name string, full_name string, state string, party string, gender string, valid_from date, valid_to date"
MENTION = "id int, scope int, raw string, day date, state string, party string, gender string"


@pytest.mark.parametrize(
    ("raw", "key", "state"),
    [("Ms. Zoë  Núñez-Rey of West Virginia", "zoe nunezrey", "WV"), ("dr. Ann Low, M.D.", "ann low", None), ("Ash III", "ash", None), ("Senator O'Hara of Nowhere", "ohara", None), ("", "", None), (None, None, None)],
)
def test_names(spark, raw, key, state):
    name, st = pp.name_and_state(pp.without_suffix(pp.without_title(F.col("n"))))
    assert tuple(spark.createDataFrame([(raw,)], "n string").select(pp.person_key(name), st).first()) == (key, state)


def test_resolution_levels(spark):
    since = D(2000, 1, 1)
    members = [
        (1, "A", "James", None, "Low", None, "OH", "D", "M", since, None), (1, "B", "Ann", "Nan", "Low", None, "TX", "R", "F", since, D(2010, 1, 1)), (1, "C", "May", None, "De Vane", "Mary De Vane", "OH", "D", "F", since, None),
        (1, "E", "Al", None, "Reed", None, "TX", "R", "M", since, None), (1, "F", "Alice", None, "Reed", None, "TX", "R", "F", since, None), (2, "G", "Ann", None, "Low", None, "NY", "D", "F", since, None),
    ]
    asked = [
        ("Mr. Low", D(2005, 1, 1), None, None, None, (None, "ambiguous")), ("Mr. Low", D(2015, 1, 1), None, None, None, ("A", "resolved")), ("Low of Texas", None, None, None, None, ("B", "resolved")),
        ("Low", None, "Ohio", None, None, ("A", "resolved")), ("Low", None, None, "R", None, ("B", "resolved")), ("Jim Low", None, None, None, None, ("A", "resolved")), ("Nan Q. Low", None, None, None, None, ("B", "resolved")),
        ("Vane", None, None, None, None, ("C", "resolved")), ("Mary De Vane", None, None, None, None, ("C", "resolved")), ("Ms. Reed", None, "TX", None, "F", ("F", "resolved")), ("Reed", None, "NY", None, None, (None, "ambiguous")),
        ("Nobody", None, "OH", None, None, (None, "unknown")), ("", None, None, None, None, (None, "unknown")), (None, None, None, None, None, (None, "unknown")),
    ]
    mentions = spark.createDataFrame([(i, 1, *a[:5]) for i, a in enumerate(asked)], MENTION)
    got = {r.id: (r.member, r.status) for r in resolve.resolve_members(mentions, spark.createDataFrame(members, MEMBER), ["scope"]).collect()}
    assert got == {i: a[5] for i, a in enumerate(asked)}


def test_second_attempt_takes_the_party_of_the_roster(spark):
    since = D(2000, 1, 1)
    members = [(1, m, first, None, last, None, "OH", party, "M", since, None) for m, first, last, party in [("A", "Al", "Low", "D"), ("B", "Bo", "Low", "R"), ("C", "Cy", "Ash", "D"), ("E", "Ed", "Fox", "R")]]
    asked = {1: ("Low", 1), 2: ("Ash", 1), 3: ("Low", 2), 4: ("Ash", 2), 5: ("Fox", 2), 6: ("Low", 3), 7: ("Nobody", 1), 8: ("Low", None), 9: ("Ash", None)}
    mentions = spark.createDataFrame([(i, 1, raw, None, None, None, None, block) for i, (raw, block) in asked.items()], MENTION + ", block int")
    got = {r.id: r.member for r in resolve.resolve_with_retry(mentions, spark.createDataFrame(members, MEMBER), ["scope"], ["block"]).collect()}
    assert got == {1: "A", 2: "C", 3: None, 4: "C", 5: "E", 6: None, 7: None, 8: None, 9: "C"}


def test_caucus_of_services_alike_in_day_and_party(spark):
    """A stated caucus goes before none, whichever row comes first; the party and the day go before it."""
    day, later = D(2020, 1, 1), D(2020, 2, 1)
    services = {
        1: [(day, None, 5, None), (day, None, 5, 900)], 2: [(day, None, 5, 900), (day, None, 5, None)], 3: [(day, None, 5, 900), (day, None, 7, None)], 4: [(day, None, 5, 900), (later, None, 5, None)],
        5: [(day, None, 5, 900), (day, None, 5, 800), (day, None, 5, None)], 6: [(day, later, 5, 900), (day, None, 5, None)], 7: [(day, None, None, None), (day, None, None, 900)],
    }
    rows = spark.createDataFrame([(m, *s) for m, held in services.items() for s in held], "member int, valid_from date, valid_to date, party_code int, caucus_code int").coalesce(1)
    asked = spark.createDataFrame([(m, D(2020, 3, 1)) for m in services], "member int, day date")
    got = {r.member: r.caucus for r in resolve.caucus_party(asked, rows, ["member"]).collect()}
    assert got == {1: 900, 2: 900, 3: 7, 4: 5, 5: 900, 6: 5, 7: 900}


def test_resolution_against_a_loop(spark):
    """Members with several rows and names, compound surnames, ranges; mentions that are asked more than once."""
    import random

    rng, day = random.Random(5), lambda y: D(y, 1, 1)
    lasts, firsts, full = ["Low", "De Low", "Ash", "Elm Ash"], ["James", "Jim", "Ann", "Anna", "Bob", None], [None, None, "Ann Low", "Jim De Low"]
    members = [
        (rng.choice([1, 2]), f"m{rng.randrange(14)}", rng.choice(firsts), rng.choice([None, None, "Nan", "Bill"]), rng.choice(lasts), rng.choice(full), rng.choice(["OH", "TX", None]), rng.choice(["D", "R", None]), rng.choice(["F", "M", None]), day(2000 + rng.randrange(4)), rng.choice([None, day(2006), day(2008)]))
        for _ in range(40)
    ]
    raws = ["Low", "Ash", "Mr. Low", "De Low", "Jim Low", "James Q. Low", "Ann Low", "Nan Elm Ash", "Robert Ash", "Bill De Low", "Jo Ash", "Low of Ohio", "Ann Ash of Texas", None]
    asked = [(i, rng.choice([1, 2, 3]), rng.choice(raws), rng.choice([None, day(2001), day(2005), day(2007)]), rng.choice([None, "OH", "Utah"]), rng.choice([None, "D", "R"]), rng.choice([None, "F", "M"])) for i in range(500)]
    formal = {"jim": "james", "bob": "robert", "bill": "william"}
    word = lambda n: (n or "").lower().split(" ")[0]
    given = lambda n: formal.get(word(n), word(n))
    meet = lambda a, b: a is not None and (word(a) in word(b) or word(b) in word(a) or given(a) == given(b))
    want = {}
    for i, scope, raw, at, state, party, gender in asked:
        name, _, of = (raw or "").removeprefix("Mr. ").partition(" of ")
        name, wanted = name.lower(), {"OH": "OH", "Utah": "UT", "Ohio": "OH", "Texas": "TX"}.get(state or of)
        words = name.split()
        levels = {1: {}, 2: {}, 3: {}, 4: {}}
        for m in members:
            last = m[4].lower()
            if m[0] != scope or not name or (at and not (m[9] <= at and (m[10] is None or at < m[10]))):
                continue
            several = len(words) > 1
            tails = [f"{given(name)}|{' '.join(words[k:])}" for k in range(1, len(words))]
            fits = {
                1: name == last, 2: not several and " " in last and name == last.split()[-1],
                3: several and ((m[5] or "").lower() == name or any(f and f"{given(f)}|{last}" in tails for f in (m[2], m[3]))), 4: several and words[-1] == last and (meet(m[2], name) or meet(m[3], name)),
            }
            for level, fit in fits.items():
                if fit:
                    levels[level].setdefault(m[1], []).append(m)
        if len(levels[2]) > 1:
            levels[2] = {}
        left = next((found for found in levels.values() if found), {})
        for at_, asks in ((6, wanted), (7, party), (8, gender)):
            held = {k: min((r[at_] for r in rows if r[at_]), default=None) for k, rows in left.items()}
            left = {k: rows for k, rows in left.items() if asks and held[k] == asks} or left
        want[i] = (next(iter(left)), "resolved") if len(left) == 1 else (None, "ambiguous" if left else "unknown")
    got = resolve.resolve_members(spark.createDataFrame(asked, MENTION), spark.createDataFrame(members, MEMBER), ["scope"]).collect()
    assert len(got) == 500 and {r.id: (r.member, r.status) for r in got} == want and len({s for _, s in want.values()}) == 3


def test_many_members_and_mentions_of_one_name(spark):
    """30,000 mentions under a surname that 3,000 members share are no 90,000,000 pairs."""
    began = time.monotonic()
    held = spark.range(3000).selectExpr(
        "1 AS scope", "concat('m', lpad(id, 4, '0')) AS member", "'Ann' AS first_name", "CAST(NULL AS STRING) AS nickname", "'Low' AS last_name", "CAST(NULL AS STRING) AS full_name", "IF(id = 7, 'UT', IF(id % 2 = 0, 'OH', 'TX')) AS state",
        "IF(id % 3 = 0, 'D', 'R') AS party", "'F' AS gender", "DATE '2000-01-01' AS valid_from", "CAST(NULL AS DATE) AS valid_to",
    )
    asked = spark.range(30000).selectExpr("CAST(id AS INT) AS id", "1 AS scope", "IF(id % 2 = 0, 'Low', 'Ann Low') AS raw", "CAST(NULL AS DATE) AS day", "IF(id % 3 = 0, 'UT', 'OH') AS state", "'D' AS party", "CAST(NULL AS STRING) AS gender")
    got = resolve.resolve_members(asked, held, ["scope"]).groupBy(F.col("id") % 3 == 0, "member", "status").count().collect()
    assert {tuple(r) for r in got} == {(True, "m0007", "resolved", 10000), (False, None, "ambiguous", 20000)}
    assert time.monotonic() - began < 100


def test_second_attempt_of_many_members_and_mentions(spark):
    """Rosters of three under the one surname of 3,000 members: the one who is found tells the party of the other two."""
    began = time.monotonic()
    held = spark.range(3000).selectExpr(
        "1 AS scope", "concat('m', lpad(id, 4, '0')) AS member", "'Ann' AS first_name", "CAST(NULL AS STRING) AS nickname", "'Low' AS last_name", "CAST(NULL AS STRING) AS full_name", "IF(id = 7, 'UT', 'OH') AS state",
        "IF(id IN (7, 8), 'D', 'R') AS party", "'F' AS gender", "DATE '2000-01-01' AS valid_from", "CAST(NULL AS DATE) AS valid_to",
    )
    asked = spark.range(30000).selectExpr(
        "CAST(id AS INT) AS id", "1 AS scope", "'Low' AS raw", "CAST(NULL AS DATE) AS day", "CASE WHEN id % 3 = 0 AND id % 2 = 0 THEN 'UT' WHEN id % 3 < 2 THEN 'OH' END AS state", "CAST(NULL AS STRING) AS party", "CAST(NULL AS STRING) AS gender", "floor(id / 3) AS block",
    )
    got = resolve.resolve_with_retry(asked, held, ["scope"], ["block"]).groupBy(F.col("id") % 3, F.floor(F.col("id") / 3) % 2 == 0, "member", "status").count().collect()
    found, two = [(0, True, "m0007", "resolved", 5000), (1, True, "m0008", "resolved", 5000)], [(2, True, None, "ambiguous", 5000)]
    assert {tuple(r) for r in got} == {*found, *two, *((i, False, None, "ambiguous", 5000) for i in range(3))}
    assert time.monotonic() - began < 100


OBS = "scope int, day date, number int, block int, ordinal int, observation string, member string, raw string, party int, after string, after_raw string, full_roster boolean"


def replayed(rows):
    """The same lists by plain Python lists."""
    lists, out, days = {}, {}, sorted({r[1] for r in rows})
    plain = lambda x: "".join(c for c in (x or "").lower() if c.isascii() and c.isalnum())
    for day in days:
        of_day = sorted((r for r in rows if r[1] == day), key=lambda r: (10**9 if r[2] is None else r[2], r[3], r[4], r[5]))
        for block in dict.fromkeys((r[2], r[3]) for r in of_day):
            held = [r for r in of_day if (r[2], r[3]) == block]
            for party in {r[8] for r in held if r[11] and r[8] is not None}:
                lists[party] = []
            for r in held:
                if r[8] is None:
                    continue
                for party in lists:
                    lists[party] = [e for e in lists[party] if r[6] is None or e[6] != r[6]]
                mine = lists.setdefault(r[8], [])
                at = next((i for i, e in enumerate(mine) if r[9] is not None and e[6] == r[9]), None)
                if at is None and r[10]:
                    at = next((i for i, e in enumerate(mine) if plain(e[7]) == plain(r[10])), None)
                mine.insert(len(mine) if at is None else at + 1, r)
        for party, held in lists.items():
            for rank, e in enumerate(held, 1):
                if e[6] is not None:
                    out[day, party, e[6]] = (rank, sum(x[6] is None for x in held[:rank]), e[5])
    return out, days


def test_anchored_ranks_equal_plain_lists(spark):
    import random

    rng, rows = random.Random(8), []
    for i in range(160):
        m = rng.choice([None, *"abcdefgh"])
        rows.append((1, D(2020, 1, 1 + rng.randrange(20)), rng.choice([None, 1, 2]), rng.randrange(2), i, f"o{i}", m, f"Mr. {m or rng.choice('xyz')}", rng.choice([100, 200, 200, None]), rng.choice([None, None, *"abcdefgh"]), rng.choice([None, "mr x", "Mr. Y"]), rng.random() < 0.06))
    want, days = replayed(rows)
    states = ri.list_states(spark.createDataFrame(rows, OBS), ["scope"]).filter("member IS NOT NULL").collect()
    for day in days:
        got = {(day, r.party, r.member): (r["rank"], r.unresolved_before, r.observation) for r in states if r.since <= day and (r.until is None or day < r.until)}
        assert got == {k: v for k, v in want.items() if k[0] == day}


def test_ranks_follow_seat_and_party(spark):
    seen = [(1, D(2020, 1, 5), 1, 1, i, f"o{i}", m, m or "x", 100, None, None, False) for i, m in enumerate(["a", None, "b", "c"])]
    sits = spark.createDataFrame([(1, f"s{m}", m, D(2020, 1, 1), D(2020, 2, 1) if m == "b" else D(2020, 6, 1)) for m in "abc"], "scope int, membership string, member string, valid_from date, valid_to date")
    sides = [(1, m, 100, D(2020, 1, 1), D(2020, 12, 1)) for m in "ab"] + [(1, "c", 100, D(2020, 1, 1), D(2020, 3, 1)), (1, "c", 200, D(2020, 2, 1), D(2020, 12, 1))]
    got = ri.rank_intervals(sits, spark.createDataFrame(sides, "scope int, member string, party int, valid_from date, valid_to date"), spark.createDataFrame(seen, OBS), ["scope"]).collect()
    assert {(r.member, r["rank"], r.unresolved_before, r.valid_from, r.valid_to) for r in got} == {("a", 1, 0, D(2020, 1, 5), D(2020, 6, 1)), ("b", 3, 1, D(2020, 1, 5), D(2020, 2, 1)), ("c", 4, 1, D(2020, 1, 5), D(2020, 3, 1))}


def test_policy():
    good = {"minimum_directory_coverage": 0.9, "minimum_member_resolution": 1, "required_cells": [{"congress": 113, "day": "2013-01-03", "chamber": "H"}]}
    assert mf.policy_errors(good) == []
    bad = good | {"minimum_directory_coverage": True, "required_cells": [*good["required_cells"] * 2, {"congress": 1}, 7]}
    assert len(mf.policy_errors(bad)) == 4 and mf.policy_errors({}) != []


def test_read_policy(tmp_path):
    (tmp_path / "p.json").write_text('{"minimum_directory_coverage": 2}')
    with pytest.raises(ValueError, match="not a share"):
        mf.read_policy(str(tmp_path / "p.json"))


def test_gates_and_pages_of_nulls(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert df.select(pg.gate(F.col("a"), F.col("b"))).first()[0] == "committee_no_required_phrase"
    assert df.select(pg.page_day(F.col("a"), F.lit(2020)), pg.printed_page(F.col("a")), pg.full_roster(F.col("a"))).first()[:] == (None, None, False)


def test_picks_of_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, 2, 1)], "k int, v int, n int")
    assert pick.newest_copy(df, [F.col("k")], ["n"]).count() == 2
    assert pick.get_or_create(df, df.selectExpr("k", "v", "'x' AS id").limit(0), ["k", "v"], "id").count() == 2
