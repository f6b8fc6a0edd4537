"""The prefix trie against plain Python over every node."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from tidemark.llm import prefix_trie, queries

KIND = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(t, key=lambda r: r[:2])] for c, t in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out = []
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        n = len(members[path])
        leaves[path] = sum(leaves[p] for p in children[path]) or 1
        saved[path] = (n - 1) * (len(path[-1][1].encode()) if path else 0) + sum(saved[p] for p in children[path])
        above = min(members[path[:-1]]) if path else None
        ids = ",".join(map(str, sorted(ends[path])))
        out.append((min(members[path]), len(path), above, n, len(children[path]), leaves[path], saved[path], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: r[:2])


def talk(rng, c, n, words=3, texts=2):
    return [(c, t, rng.choice(["user", "tool"]), " ".join(rng.choice(["é", "b"][:texts]) for _ in range(rng.randrange(1, words)))) for t in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_random_tries(spark, seed):
    rng = random.Random(seed)
    rows = [r for c in rng.sample(range(-20, 200), 120) for r in talk(rng, c, rng.randrange(1, 9))]
    rng.shuffle(rows)
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, KIND), broadcast_bytes=[0, 1 << 20][seed % 2])) == brute(rows)


def test_hot_conversation_copies_and_long_chains(spark):
    rng = random.Random(7)
    long = talk(rng, 3, 700, texts=2)  # spans many of the sorted partitions
    rows = long + [(c, t, r, x) for c in range(1000, 1400) for _, t, r, x in long[:12]]  # 400 copies
    rows += [(8, t, r, x) for _, t, r, x in long[:-1]] + [(8, 699, "user", "another end")]
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, KIND).repartition(5))) == brute(rows)


def test_registered_query_on_the_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op12_prefix_trie"](spark, path)) == brute(rows)
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet'")
    found = duckdb.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.SQL['op12_prefix_trie']})").fetchall()
    assert sorted(found, key=lambda r: r[:2]) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "a", "b"), (1, None, None, None), (1, 0, "user", ""), (2, 5, "user", "x" * 100_000), (2, None, "", ""), (3, 1, "user", "same"), (3, 1, "user", "same"), (5, 0, "user", "é"), (7, 0, "user", "é")]
    df = spark.createDataFrame(rows, KIND)
    extra = df.selectExpr("*", "1 AS pos", "2 AS k1", "'x' AS node_id", "0 AS depth", "5 AS bytes", "TRUE AS chain")
    assert got(prefix_trie.prefix_trie(df)) == got(prefix_trie.prefix_trie(extra)) == brute(rows)
    ties = spark.createDataFrame([(1, 0, "a", "x"), (1, 0, "a", "y"), (2, 0, "a", "y"), (2, 0, "a", "x")], KIND)
    assert {r.n_convs for r in prefix_trie.prefix_trie(ties, most=1).collect()} == {2}  # one order for both


def test_no_rows_and_one(spark):
    assert not prefix_trie.prefix_trie(spark.createDataFrame([], KIND)).collect()
    for rows in ([(10, 0, "user", "a")], [(c, t, "user", "a") for c in (10, 15, 20) for t in range(12)]):
        assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, KIND))) == brute(rows)


def test_long_lists_of_ends_pass_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    rows = [(5 * c, 0, "user", "same") for c in range(300)]
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, KIND))) == brute(rows)
