"""Exact top-k inner products by dual-tree search over cover trees.

Queries are taken in chunks of a bounded size. A chunk's cover tree is built once and sent to
the tasks, and every task walks its own rows block by block: a cover tree of the block and
the tree of the queries together. A pair of nodes is pruned when no inner product under it can reach
the worst k-th score of the query node; these scores are carried from block to block. The bound comes
from the two centres and the covering radii: <q, r> + |q| R_r + |r| R_q + R_q R_r. No row is
copied or shuffled; a task gives out k rows for each query.

Scores are exact integers throughout: doubles where products and sums stay below 2^53, longs below 2^62,
Python integers beyond, and the ends of a long beyond those.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, trimmed

#: Most children of a node.
FAN = 16
#: Data points that are compared with a leaf of queries at once, at first and at most, before the bounds of the next nodes are looked at.
FIRST, GROUP = 32, 2048
#: No score: below all that are given out.
LOWEST = -(2**63)


@dataclass
class CoverTree:
    """Balls of points by number, the root first: centres, covering radii, and children or points."""

    centres: np.ndarray
    norms: np.ndarray
    radii: np.ndarray
    children: list[np.ndarray]
    points: list[np.ndarray]

    @property
    def inner(self) -> np.ndarray:
        return np.array([len(c) > 0 for c in self.children])


def cover_tree(x: np.ndarray, leaf: int = 128) -> CoverTree:
    """Cover tree of the rows of ``x``, split until a node has at most ``leaf`` points or one place.

    Children's centres are picked farthest first until all points are within half the node's radius
    of one, or FAN are picked; so they are farther apart than the widest child's radius.
    """
    if not len(x):
        raise ValueError("no points")
    x = x.astype(np.float64)
    centres, radii, children, points = [], [], [], []
    todo = [(np.arange(len(x)), int(np.linalg.norm(x - x.mean(axis=0), axis=1).argmin()), None)]
    while todo:
        own, centre, parent = todo.pop()
        node = len(centres)
        if parent is not None:
            children[parent].append(node)
        away = np.linalg.norm(x[own] - x[centre], axis=1)
        radius = float(away.max(initial=0.0))
        centres.append(centre), radii.append(radius), children.append([]), points.append(own)
        if len(own) <= leaf or radius == 0 or not np.isfinite(radius):
            continue
        owner, picked = np.zeros(len(own), dtype=np.int64), [centre]
        while away.max() > radius / 2 and len(picked) < FAN:
            far = int(own[away.argmax()])
            dist = np.linalg.norm(x[own] - x[far], axis=1)
            closer = dist < away
            away[closer], owner[closer] = dist[closer], len(picked)
            picked.append(far)
        todo += [(own[owner == j], c, node) for j, c in enumerate(picked)]
    at = x[centres]
    return CoverTree(at, np.linalg.norm(at, axis=1), np.array(radii), [np.array(c, dtype=np.int64) for c in children], points)


def query_tree(x: np.ndarray) -> CoverTree:
    """The queries' tree: finer than the data's, as a group's worst k-th score speaks for all of it."""
    return cover_tree(x, max(8, len(x) // 256))


class DualTree:
    """k best data rows of every query, ties to the smaller id; ``compared`` counts scores.

    ``queries`` are integers (longs or Python's); ``add`` searches one block of data after the other.
    """

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, k: int, tree: CoverTree | None = None):
        self.q, self.qid, self.k, self.compared = queries, query_ids, k, 0
        self.tree = tree if tree is not None or not len(queries) else query_tree(queries)
        self.peak = int(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
        self.best = np.full((len(queries), k), LOWEST, dtype=np.int64)
        self.best_id = np.zeros((len(queries), k), dtype=np.int64)

    def add(self, data: np.ndarray, data_ids: np.ndarray) -> "DualTree":
        if not len(self.q) or not len(data):
            return self
        order = np.argsort(data_ids, kind="stable")
        self.x, self.xid = data[order], data_ids[order]
        peak = self.peak * int(np.abs(data).max(initial=0))
        self.kind = "double" if peak < 2**53 else "long" if peak < 2**62 else "object"
        if self.kind == "double":
            self.qf, self.xf = self.q.astype(np.float64), self.x.astype(np.float64)
        self._walk(cover_tree(self.x))
        return self

    def _bounds(self, a: int, tree: CoverTree, nodes: np.ndarray) -> np.ndarray:
        """What no score of query node ``a`` with a point under each of ``nodes`` can exceed."""
        norm, radius, r = self.tree.norms[a], self.tree.radii[a], tree.radii[nodes]
        with np.errstate(all="ignore"):
            top = tree.centres[nodes] @ self.tree.centres[a] + norm * r + tree.norms[nodes] * radius + radius * r
            return top + 1e-9 * (norm + radius) * (tree.norms[nodes] + r) + 1.0

    def _walk(self, tree: CoverTree) -> None:
        """Query nodes from the root down, each with the data nodes that it can't do without."""
        inner, stack = tree.inner, [(0, np.zeros(1, dtype=np.int64))]
        while stack:
            a, nodes = stack.pop()
            own, leaf = self.tree.points[a], not len(self.tree.children[a])
            while True:
                bounds = self._bounds(a, tree, nodes)
                kept = ~(bounds < self.best[own, -1].min())
                nodes, bounds = nodes[kept], bounds[kept]
                wide = inner[nodes] & (leaf | (tree.radii[nodes] >= self.tree.radii[a]))
                if not wide.any():
                    break
                nodes = np.concatenate([nodes[~wide], *(tree.children[n] for n in nodes[wide])])
            if not leaf:
                stack += [(c, nodes) for c in self.tree.children[a]]
                continue
            order = np.argsort(-bounds, kind="stable")  # the most promising first
            nodes, bounds = nodes[order], bounds[order]
            sizes = np.cumsum([len(tree.points[n]) for n in nodes])
            lo, group = 0, FIRST
            while lo < len(nodes) and not bounds[lo] < self.best[own, -1].min():
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + group)))
                self._compare(own, np.sort(np.concatenate([tree.points[n] for n in nodes[lo:hi]])))
                lo, group = hi, min(2 * group, GROUP)

    def _scores(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        if self.kind == "double":
            return (self.qf[rows] @ self.xf[cols].T).astype(np.int64)
        if self.kind == "long":
            return self.q[rows] @ self.x[cols].T
        whole = self.q[rows].astype(object) @ self.x[cols].T.astype(object)
        return np.maximum(np.minimum(whole, 2**63 - 1), LOWEST + 1).astype(np.int64)

    def _compare(self, rows: np.ndarray, cols: np.ndarray) -> None:
        self.compared += len(rows) * len(cols)
        s = self._scores(rows, cols)
        s[self.qid[rows][:, None] == self.xid[cols][None, :]] = LOWEST
        floor = self.best[rows, -1]
        if len(cols) > self.k:
            floor = np.maximum(floor, np.partition(s, len(cols) - self.k, axis=1)[:, len(cols) - self.k])
        i, j = np.nonzero((s >= floor[:, None]) & (s > LOWEST))
        oi, oj = np.nonzero(self.best[rows] > LOWEST)
        row = np.concatenate([i, oi])
        score = np.concatenate([s[i, j], self.best[rows][oi, oj]])
        ids = np.concatenate([self.xid[cols][j], self.best_id[rows][oi, oj]])
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        best, best_id = np.full((len(rows), self.k), LOWEST, dtype=np.int64), np.zeros((len(rows), self.k), dtype=np.int64)
        best[row[keep], rank[keep]], best_id[row[keep], rank[keep]] = score[keep], ids[keep]
        self.best[rows], self.best_id[rows] = best, best_id


def _matrix(column, dims: int) -> np.ndarray:
    """Rows of floor(256 * x) as longs, or as Python integers where a long is too small; shorter vectors filled with zeros."""
    lists = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(x).max(initial=0) < 2.0**53:
        flat = np.floor(256.0 * x).astype(np.int64)
    else:  # doubles from 2^53 on are whole
        flat = np.array([math.floor(256 * v) if abs(v) < 2**53 else 256 * int(v) for v in x.tolist()], dtype=object)
    out = np.zeros((len(lengths), dims), dtype=flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part: an id, and no null or non-finite component."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.select("vec_id", "embedding").filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(~bad)


def _found(rows: DataFrame, queries: np.ndarray, query_ids: np.ndarray, dims: int, k: int, block_rows: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each task's rows for each query of a chunk."""
    sent = rows.sparkSession.sparkContext.broadcast((queries, query_ids, query_tree(queries)))

    def run(batches):
        import pyarrow as pa

        q, qid, tree = sent.value
        search = DualTree(q, qid, k, tree)
        for batch in batches:
            for lo in range(0, batch.num_rows, block_rows):
                part = batch.slice(lo, block_rows)
                search.add(_matrix(part.column(1), dims), part.column(0).to_numpy())
        i, j = np.nonzero(search.best > LOWEST)
        for at in range(0, len(i), 8192):
            cut_ = slice(at, at + 8192)
            yield pa.RecordBatch.from_arrays([pa.array(qid[i[cut_]]), pa.array(search.best_id[i[cut_], j[cut_]]), pa.array(search.best[i[cut_], j[cut_]])], names=["query_id", "vec_id", "score"])

    return rows.select("vec_id", "embedding").mapInArrow(trimmed(run), "query_id long, vec_id long, score long")


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, block_rows: int = 8192, chunk_queries: int = 65536) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by ``every``.

    Scores are integer inner products of floor(256 * x), exact while they fit a long; beyond it they count
    as the long next to them, ties to the smaller id. Vectors of unequal length
    count as filled up with zeros. A query's own vec_id is no candidate; a vec_id that
    repeats is one candidate for each of its rows, and one query (its smallest vector). No vector that takes part, no row.

    The rows are read once for each chunk of about ``chunk_queries`` queries, which passes through the driver.
    """
    rows = cut(usable(embeddings), "vectors")
    n_queries, dims = rows.agg(F.count_if(F.col("vec_id") % every == 0), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    chunks = max(1, math.ceil(n_queries / chunk_queries))
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = cut(asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")), "queries", "chunk")
    best = None
    for c in range(chunks):
        table = asked.filter(F.col("chunk") == c).select("vec_id", "embedding").toArrow()
        if table.num_rows:
            found = _found(rows, _matrix(table.column("embedding"), dims), table.column("vec_id").to_numpy(), dims, k, block_rows)
            best = found if best is None else best.unionByName(found)
    if best is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
