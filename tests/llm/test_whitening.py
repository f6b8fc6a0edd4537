"""Whitening against numpy on the whole table, and odd vectors."""

import numpy as np
import pytest

from tidemark.llm import queries, whitening

KIND = "vec_id long, embedding array<float>"


def expected(vectors):
    """Distinct x, n, S and covariance by object arithmetic and one matrix product."""
    dims = max(map(len, vectors))
    x = np.array([[int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in [*v, *[0.0] * (dims - len(v))]] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    z = ((fit * n - s) / n).astype(float)
    return x, n, s, z.T @ z / n


def check(rows, vectors, most=16):
    x, n, s, v = expected([e for _, e in vectors])
    values, vecs = np.linalg.eigh(v)
    values, vecs = values[::-1][:most], vecs[:, ::-1][:, :most]
    out = {(r.vec_id, r.component): r for r in rows}
    assert len(out) == len(rows) == len(vectors) * min(most, len(values))
    off = x * n - s
    for k in range(len(values)):
        white = np.array([out[i, k + 1].whitened for i, _ in vectors])
        want = (off / n).astype(float) @ vecs[:, k] / np.sqrt(values[k])
        sign = 1 if np.dot(white, want) >= 0 else -1
        assert np.allclose(white, sign * want, atol=1e-7)
        assert all(abs(out[i, k + 1].explained - values[k] / np.trace(v)) < 1e-9 for i, _ in vectors)
    for (i, _), d in zip(vectors, off):
        row = out[i, 1]
        assert row.n == n and row.deviation == sum(int(e) ** 2 for e in d) and row.identity_error < 1e-6


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, (rng.normal(size=6) * [9, 4, 3, 2, 1, 0.5] + 2).astype(np.float32).tolist()) for i in range(400)]
    vectors += [(1000 + i, vectors[3][1]) for i in range(300)]  # one vector holds nearly half the rows and counts once
    check(whitening.whiten(spark.createDataFrame(vectors, KIND).repartition(7), most=4).collect(), vectors, most=4)


def test_registered_query_on_the_table(spark):
    path = "/root/testdata/sf0.01"
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    check(queries.QUERIES["op13_embedding_whitening"](spark, path).collect(), vectors)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (None, [0.5, -4.0]), (2, [3.0, 1.0]), (4, [7.0]), (5, [])]
    bad = [(6, None), (7, [None, 1.0]), (8, [inf, 1.0]), (9, [nan, 2.0])]
    df = spark.createDataFrame(good + bad, KIND).selectExpr("*", "'own' AS x", "'old' AS N", "1 AS field_0")
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "x", "field_0", *whitening.NAMES]
    rows = out.collect()
    assert len(rows) == 12 and {r.n for r in rows} == {5} and {r.x for r in rows} == {"own"}
    x, n, s, _ = expected([e for _, e in good])
    assert sorted(r.deviation for r in rows if r.component == 1) == sorted(sum(int(e) ** 2 for e in d) for d in x * n - s)


def test_no_variance_and_no_rows(spark):
    assert not whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], KIND)).collect()
    assert not whitening.whiten(spark.createDataFrame([], KIND)).collect()
    flat = [(i, [float(i), 5.0]) for i in range(9)]  # the second dimension never varies
    assert {r.component for r in whitening.whiten(spark.createDataFrame(flat, KIND)).collect()} == {1}


@pytest.mark.parametrize("size", [1e6, 1e30])
def test_large_entries_stay_exact(spark, size):
    vectors = [(1, [size, 1.0]), (2, [-size, 2.0]), (3, [0.0, 7.0])]
    rows = whitening.whiten(spark.createDataFrame(vectors, KIND)).collect()
    x = np.array([[int(max(min(np.floor(64 * float(np.float32(c))), 2.0**52), -(2.0**52))) + 1_000_000 for c in v] for _, v in vectors], dtype=object)
    off = x * 3 - x.sum(axis=0)
    want = [min(sum(int(e) ** 2 for e in d), 2**63 - 1) for d in off]
    assert [next(r.deviation for r in rows if r.vec_id == i) for i in (1, 2, 3)] == want
