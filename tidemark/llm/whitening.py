"""Whitening of embeddings: two-pass covariance, eigenvectors and projection.

The first pass sums the integer vectors exactly, which gives the mean; the second
sums the centred vectors' outer products, a matrix product for each Arrow batch. The
partial sums of the tasks meet in ``treeAggregate``, so that the driver gets a few
matrices of dims x dims, whatever the rows. LAPACK's symmetric solver gives
the components there, and the projection is broadcast (dims x components).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, free_names, trimmed

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this many steps are clipped to it.
MOST_STEPS = 2**52
LOW = 32
NAMES = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def steps(embedding: str):
    """The array of an embedding's entries as longs."""
    return F.transform(embedding, lambda c: (F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(MOST_STEPS)), F.lit(-MOST_STEPS)) + SHIFT).cast("long"))


def usable(embeddings: DataFrame) -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.filter(F.col("embedding").isNotNull()).filter(~bad)


def matrix(column, dims: int) -> np.ndarray:
    """Lists of longs as rows; shorter ones are filled up with what the entry 0 becomes."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.full((len(lengths), dims), SHIFT, dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


@dataclass
class Moments:
    """Rows of the fit list and their sum in each dimension, exact."""

    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as longs where they and their squares' sum fit, else as Python integers."""
        top = max(1, int(np.abs(x).max(initial=0)), max(map(abs, self.sums), default=0) // max(self.n, 1) + 1)
        sums = np.array(self.sums, dtype=object)
        if 2 * self.n * top >= 2**62:
            return x.astype(object) * self.n - sums
        out = x * self.n - sums.astype(np.int64)
        peak = int(np.abs(out).max(initial=0))
        return out if peak * peak * max(1, x.shape[1]) < 2**62 else out.astype(object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def _tree_sum(partials: DataFrame, width: int, kind: str, depth: int) -> np.ndarray:
    """Sum of the tasks' rows (bytes of ``width`` numbers) by treeAggregate."""

    def add(total, row):
        return total + np.frombuffer(row[0], dtype=kind)

    return partials.rdd.treeAggregate(np.zeros(width, dtype=kind), add, lambda a, b: a + b, depth)


def _summed(fit: DataFrame, dims: int, width: int, kind: str, of, depth: int) -> np.ndarray:
    """``of`` gives the numbers of a batch's matrix; one row leaves each task."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(width, dtype=kind)
        for batch in batches:
            if batch.num_rows:
                total += of(matrix(batch.column(0), dims)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return _tree_sum(fit.select("x").mapInArrow(trimmed(run), "sums binary"), width, kind, depth)


def moments(fit: DataFrame, dims: int, depth: int = 2) -> Moments:
    """First pass. High and low halves of the entries are summed apart: no long can overflow."""

    def of(x):
        return np.concatenate([[len(x)], (x >> LOW).sum(axis=0), (x & ((1 << LOW) - 1)).sum(axis=0)])

    n, *halves = map(int, _summed(fit, dims, 1 + 2 * dims, "<i8", of, depth))
    return Moments(n, [(hi << LOW) + lo for hi, lo in zip(halves[:dims], halves[dims:])])


@dataclass
class Whitening:
    """Mean, unit components by falling eigenvalue, and what they explain."""

    mean: Moments
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.mean.centred(x) @ (self.components / np.sqrt(self.values))


def fit(x_rows: DataFrame, dims: int, most: int = 16, depth: int = 2) -> Whitening | None:
    """Fit on the distinct vectors of ``x_rows`` (column x). None without a component of positive variance."""
    known = cut(x_rows.select("x").distinct(), "whitening-fit")
    mean = moments(known, dims, depth)
    if not mean.n or not dims:
        return None
    v = _summed(known, dims, dims * dims, "<f8", lambda x: (z := mean.centred(x)).T @ z, depth).reshape(dims, dims) / mean.n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(values.max(), 0) * dims * np.finfo(np.float64).eps]
    if not len(order):
        return None
    model = Whitening(mean, vectors[:, order], values[order], values[order] / np.trace(v))
    k = len(order)
    # the projections of the fit list have mean 0 by construction: the vectors are centred
    white = _summed(known, dims, k * k, "<f8", lambda x: (w := model.project(x)).T @ w, depth).reshape(k, k) / mean.n
    model.identity_error = float(np.abs(white - np.eye(k)).max())
    return model


def whiten(embeddings: DataFrame, most: int = 16, depth: int = 2) -> DataFrame:
    """All columns of ``embeddings`` but ``embedding``, and those of NAMES: a row for each component.

    Rows whose vector is null or holds a null or non-finite entry are left out; a null
    vec_id stays. Rows alike count once in the fit and each have their result. Shorter
    vectors are filled up with zeros to the longest one; entries beyond 2^52 / 64 are
    clipped; a deviation beyond a long is the largest long. Components whose variance is 0 (beyond
    rounding) can't be whitened and are not given, so one vector alone, and an empty table,
    give no rows. Input columns with the new names are replaced; no other name clashes.
    The driver and each task hold dims x dims doubles.
    """
    rows = usable(embeddings)
    kept = [c for c in embeddings.columns if c != "embedding" and c.lower() not in NAMES]
    schema = rows.select(*kept, *(F.lit(0).cast(t).alias(c) for c, t in zip(NAMES, ("int", "long", "long", "double", "double", "double")))).schema
    x_rows = rows.select(steps("embedding").alias("x"))
    dims = rows.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]
    spark = embeddings.sparkSession
    model = fit(x_rows, dims, most, depth)
    if model is None:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(model)  # dims x ``most`` numbers

    def run(batches):
        import pyarrow as pa

        model = sent.value
        k = len(model.values)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = matrix(part.column(0), dims)
                off = model.mean.deviations(x)
                deviation = [min(int(d), 2**63 - 1) for d in (off * off).sum(axis=1)]
                row, m = np.repeat(np.arange(len(x)), k), len(x) * k
                new = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(m, model.mean.n), np.repeat(np.array(deviation, dtype=np.int64), k), model.project(x).ravel(), np.tile(model.explained, len(x)), np.full(m, model.identity_error)]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in part.columns[1:]), *map(pa.array, new)], names=schema.names)

    (first,) = free_names(embeddings, 1)
    return rows.select(steps("embedding").alias(first), *kept).mapInArrow(trimmed(run), schema)
