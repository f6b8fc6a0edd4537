"""Behaviours of single operators on small own inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import islands, ledger, ranking, replay, scoring

D = dt.date


def events(spark, rows):
    return spark.createDataFrame(rows, "member string, day date, action string, event_id string")


def intervals(df):
    return sorted((r.member, r.start_event_id, r.valid_from, r.valid_to, r.end_event_id) for r in df.collect())


def test_same_day_appointment_and_removal_cancel(spark):
    rows = [("a", D(2020, 1, 1), "REMOVED", "1"), ("a", D(2020, 1, 1), "APPOINTED", "2")]
    assert intervals(replay.replay(events(spark, rows), ["member"], F.lit("2021-01-01").cast("date"))) == []


def test_replay_equals_row_wise_loop(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), D(2020, 1, 1) + dt.timedelta(rng.randrange(40)), rng.choice(["APPOINTED", "REMOVED"]), f"{i:04d}") for i in range(300)]
    end, expected = D(2020, 3, 1), []
    for member in "abc":
        own = sorted((r for r in rows if r[0] == member), key=lambda r: (r[1], r[2] != "APPOINTED", r[3]))
        opened = None
        for _, day, action, eid in own:
            if opened and day > opened[0]:
                expected.append((member, opened[1], opened[0], day, eid if action == "REMOVED" else None))
            if opened or action == "APPOINTED":
                opened = (day, eid) if action == "APPOINTED" else None
        if opened:
            expected.append((member, opened[1], opened[0], end, None))
    assert intervals(replay.replay(events(spark, rows), ["member"], F.lit(end))) == sorted(expected)


def test_one_day_merge_is_pairwise(spark):
    day = lambda n: D(2020, 1, n)
    rows = [("a", str(i), day(i), day(i + 1), None) for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "member string, start_event_id string, valid_from date, valid_to date, end_event_id string")
    assert [(r[2], r[3]) for r in intervals(replay.merge_one_day(df, ["member"]))] == [(day(1), day(3)), (day(3), day(4))]


def test_seam_of_one_day_closes(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1), D(2020, 1, 9)), ("a", D(2020, 1, 10), D(2020, 2, 1))], "k string, valid_from date, valid_to date")
    assert sorted(r.valid_to for r in islands.close_seams(df, ["k"]).collect()) == [D(2020, 1, 10), D(2020, 2, 1)]


def test_two_of_three_is_66_667_and_fails(spark):
    ref = spark.createDataFrame([("c", "a"), ("c", "b"), ("c", "x")], "cell string, m string")
    obs = spark.createDataFrame([("c", "a"), ("c", "b")], "cell string, m string")
    row = scoring.overlap_scores(scoring.compare_sets(ref, obs, ["cell", "m"]), ["cell"], 0.95).first()
    assert (row.coverage_pct, row.observed_pct, row.gate_status) == (66.667, 100.0, "FAIL")


def test_missing_cell_and_no_reference_fail_the_gate(spark):
    need = spark.createDataFrame([("a",), ("b",), ("c",)], "cell string")
    scores = spark.createDataFrame([("a", "PASS"), ("b", "NO_REFERENCE")], "cell string, gate_status string")
    assert {tuple(r) for r in scoring.gate_failures(need, scores, ["cell"]).collect()} == {("b", "NO_REFERENCE"), ("c", "MISSING_CELL")}


def test_unresolved_slot_keeps_its_rank(spark):
    rows = [("s", "a", 1), ("s", None, 2), ("s", "c", 3)]
    out = ranking.rank_by_latest(spark.createDataFrame(rows, "s string, m string, o int"), ["s"], "m", ["o"])
    assert [(r.m, r["rank"], r.unresolved_before) for r in out.filter("m IS NOT NULL").orderBy("rank").collect()] == [("a", 1, 0), ("c", 3, 1)]


def test_predecessor_inserts_and_roster_resets(spark):
    rows = [("s", 1, "a", None, False), ("s", 2, "b", None, False), ("s", 3, "x", "a", False), ("t", 1, "a", None, False), ("t", 2, "z", None, True)]
    out = ranking.replay_anchored(spark.createDataFrame(rows, "scope string, position int, member string, after string, full_roster boolean"), ["scope"])
    assert sorted((r.scope, r.seq, r.member) for r in out.collect()) == [("s", 1, "a"), ("s", 2, "x"), ("s", 3, "b"), ("t", 1, "z")]


def test_anchored_lists_against_plain_lists(spark):
    rng, rows, want = random.Random(6), [], set()
    for scope in ("s", "t", None):
        held = []
        for i in range(150):
            member, after, roster = rng.choice([*"abcdefgh", None]), rng.choice([*"abcdefgh", None, None]), rng.random() < 0.03
            rows.append((scope, 10 * i, member, after, roster))
            held = [] if roster else [m for m in held if m is None or m != member]
            at = held.index(after) + 1 if after is not None and after in held else len(held)
            held.insert(at, member)
        want |= {(scope, n, m) for n, m in enumerate(held, 1)} if scope else set()
    df = spark.createDataFrame([r for r in rows if r[0]], "scope string, position int, member string, after string, full_roster boolean").repartition(3)
    assert {(r.scope, r.seq, r.member) for r in ranking.replay_anchored(df, ["scope"]).collect()} == want
    assert not ranking.replay_anchored(df.limit(0), ["scope"]).collect()


def test_narrowing_keeps_all_when_none_matches(spark):
    c = spark.createDataFrame([(1, "a", "X"), (1, "b", "Y"), (2, "a", "X"), (2, "b", "X")], "q int, id string, st string")
    left = scoring.narrow(c, ["q"], F.col("st") == "Y")
    assert {tuple(r) for r in scoring.unique(left, ["q"], "id").collect()} == {(1, "b")}


def test_null_version_is_an_identity_value(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "v")], "id int, v string")
    assert {tuple(r) for r in ledger.survivors(df, ["v"], "id").collect()} == {(1, 1), (2, 1), (3, 3)}


def test_conflicting_metadata_is_refused(spark):
    df = spark.createDataFrame([("h", "a"), ("h", "b")], "h string, meta string")
    with pytest.raises(ValueError):
        ledger.require_none(ledger.conflicts(df, ["h"], ["meta"]), "conflicting metadata")


def test_fill_takes_one_of_repeated_rows_and_adds_null_keys(spark):
    df = lambda rows: spark.createDataFrame(rows, "k int, v int, w int")
    out = ledger.upsert_fill(df([(1, None, 5), (2, 7, None)]), df([(1, 3, 9), (1, 4, 1), (2, 8, 8), (None, 1, 1), (None, 1, 1), (3, 2, None)]), ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 4, 5), (2, 7, 8), (None, 1, 1), (None, 1, 1), (3, 2, None)], key=str)


def test_sole_value_with_null_groups(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 2, "x"), ("a", 3, "y"), ("a", 4, "z"), ("a", 5, None), ("b", 6, None)], "g string, id int, v string")
    got = {r.id: r.v for r in islands.sole_value(df, ["g"], "v").collect()}
    assert got == {1: "x", 2: "x", 3: "y", 4: "z", 5: None, 6: None}


def test_merge_adjacent_needs_equal_attributes(spark):
    rows = [("a", 1, D(2020, 1, 1), D(2020, 2, 1)), ("a", 1, D(2020, 2, 1), D(2020, 3, 1)), ("a", 2, D(2020, 3, 1), D(2020, 4, 1))]
    df = spark.createDataFrame(rows, "k string, rank int, valid_from date, valid_to date")
    assert sorted((r["rank"], r.valid_from, r.valid_to) for r in islands.merge_adjacent(df, ["k"], ["rank"]).collect()) == [(1, D(2020, 1, 1), D(2020, 3, 1)), (2, D(2020, 3, 1), D(2020, 4, 1))]
