"""The license scan against plain Python, and odd inputs."""

import random
import re

import duckdb
import pytest

from tidemark.llm import licenses, queries, queries_tables

KIND = "doc_id long, text string"


def brute(text, notices=licenses.NOTICES, phrases=licenses.PHRASES, step=32):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(licenses.LICENSE_WORD, low)
    step = max([step, *(len(t.split()) for _, t in notices)])
    places, base, more, share = [], set(), set(), 0.0
    for phrase, label in phrases.items():
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    for lo in range(0, len(w), step):
        block = set(w[lo : lo + 2 * step])
        for label, t in notices:
            tokens = set(t.split())
            if 10 * len(tokens & block) >= 8 * len(tokens):
                more.add(label)
                share = max(share, len(tokens & block) / len(tokens))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else share)


def texts(rng, n):
    vocabulary = sorted({w for _, t in licenses.NOTICES for w in t.split()})
    out = []
    for _ in range(n):
        words = [rng.choice(vocabulary) if rng.random() < 0.4 else f"é{rng.randrange(99)}" for _ in range(rng.choice([0, 3, 40, 300]))]
        for _ in range(rng.randrange(3)):
            notice = rng.choice(licenses.NOTICES)[1].split()
            notice = [w if rng.random() > 0.12 else "other" for w in notice]
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        out.append(rng.choice([" ", "\n", ", "]).join(w.upper() if rng.random() < 0.1 else w for w in words))
    return out


def got(df):
    return {r.doc_id: tuple(r)[1:] for r in df.select("doc_id", *licenses.NEW).collect()}


def test_random_texts(spark):
    rows = list(enumerate(texts(random.Random(3), 250)))
    out = got(licenses.scan(spark.createDataFrame(rows, KIND).repartition(5)))
    want = {i: brute(t) for i, t in rows}
    assert out == want and len({w[5] for w in want.values()}) > 20


def test_registered_query_and_sql_on_the_table(spark):
    path = "/root/testdata/sf0.01"
    out = got(queries.QUERIES["op11_license_scan"](spark, path))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()}
    assert out == {i: brute(t) for i, t in docs.items()}
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    found = duckdb.sql(f"SELECT doc_id, {', '.join(licenses.NEW)} FROM ({queries_tables.OP11_SQL})").fetchall()
    assert {r[0]: r[1:] for r in found} == out


def test_order_prefix_and_needed(spark):
    notices = [("a", "x y z x"), ("b", "y z q r s")]
    docs = spark.createDataFrame([(1, "z z z"), (2, "z y"), (3, "z x y")], KIND)
    order = licenses.order_tokens(docs, notices)
    assert order == ["q", "r", "s", "x", "y", "z"]
    index = licenses.indexed(notices, order, 8, 10)
    assert [(n.tokens, n.needed, n.prefix) for n in index] == [(("x", "y", "z"), 3, ("x",)), (("q", "r", "s", "y", "z"), 4, ("q", "r"))]


def test_odd_rows(spark):
    line = "Released under the MIT License."
    rows = [(1, None), (2, ""), (None, line), (3, line), (3, line), (4, "w " * 50_000 + line), (5, "gnu general\npublic, license"), (6, "mit  license mit license"), (7, "Cc-By"), (8, "ÀPACHE license")]
    df = spark.createDataFrame(rows, KIND)
    names = ["row", "w", "anchors", "rare", "uid", "found", "base", "blocks", "block", "j", "token", "key", "i", "needed", "tokens", "label", "share", "more"]
    out = licenses.scan(df.selectExpr("*", *(f"'own' AS `{c}`" for c in names), "'old' AS Labels"))
    assert out.columns == ["doc_id", *names, *licenses.NEW]
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, *(r[c] for c in licenses.NEW)) for r in out.collect()), key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)
    assert all(r[c] == "own" for r in out.collect() for c in names)
    assert not licenses.scan(df.limit(0)).collect()
    assert {r.labels for r in licenses.scan(df, notices=[]).collect()} == {"", "mit", "gpl", "cc-by"}


@pytest.mark.parametrize("words", ["is in of", "a"])
def test_short_notices(spark, words):
    docs = spark.createDataFrame([(1, "is in"), (2, "of is x in"), (3, "A")], KIND)
    want = {i: brute(t, [("own", words)], {}) for i, t in ((1, "is in"), (2, "of is x in"), (3, "A"))}
    assert got(licenses.scan(docs, notices=[("own", words)], phrases={})) == want
