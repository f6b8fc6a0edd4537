"""Quality classifier by co-training of a text view and a metadata view.

The text view sees hashed byte trigrams and shape figures of the text; the
metadata view sees source, language and length. Both are logistic regressions,
each calibrated on held-out labels (Platt scaling) whenever it was fitted.
Over some rounds each view labels the documents it is surest of by its calibrated
probability, out of all that have no label, in the proportion of the labelled classes.
They join the other view's training rows, at a lower weight, if neither the other view's calibrated
loss on the held-out labels nor that of both views together rises by it. A view that knows no more about held-out rows than the
share of each class hands over nothing. At last the held-out labels weigh the two
calibrated views; no slope or weight is negative.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, free_names, trimmed
from .features import SHAPE, shape, trigram_counts

GRAMS, META = 1024, 64


def pack_text(text: str | None) -> bytes:
    """The text view in ``GRAMS`` + 4 bytes a shape figure: roots of the trigram counts in 256 steps, then the figures."""
    text = text or ""
    counts = np.sqrt(trigram_counts(text.encode("utf-8", "surrogatepass"), GRAMS))
    grams = np.rint(counts * (255 / max(counts.max(), 1e-9))).astype(np.uint8)
    return grams.tobytes() + np.array(shape(text), dtype="<f4").tobytes()


def unpack_texts(packed: list[bytes]) -> np.ndarray:
    """A row for each packed text: its grams to length 1, then its figures."""
    raw = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1)
    grams = raw[:, :GRAMS].astype(np.float32)
    norm = np.linalg.norm(grams, axis=1, keepdims=True)
    return np.concatenate([grams / np.where(norm > 0, norm, 1), np.ascontiguousarray(raw[:, GRAMS:]).view("<f4")], axis=1)


def text_view(text: str | None) -> np.ndarray:
    return unpack_texts([pack_text(text)])[0]


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META + 2, dtype=np.float32)
    size = int(4 * np.log2(1 + max(n_chars or 0, 0)))  # a length counts by its band too
    for name, value in (("source", source), ("lang", lang), ("size", size)):
        out[zlib.crc32(f"{name}={value}".encode("utf-8", "surrogatepass")) % META] += 1
    out[META] = np.log1p(max(n_chars or 0, 0)) / 10
    out[META + 1] = n_chars is None
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Logistic:
    """Logistic regression on standardised columns, by damped gradient steps with momentum."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-3, steps: int = 150, rate: float = 0.5) -> "Logistic":
        """``weight`` of each row; rows of weight 0 count for nothing."""
        weight = np.ones(len(y)) if weight is None else weight
        weight = (weight / weight.sum()).astype(np.float32)
        mean = weight @ x
        scale = np.sqrt(np.maximum(weight @ (x - mean) ** 2, 0))
        scale = np.where(scale > 1e-6, scale, 1.0) * np.sqrt(x.shape[1])
        z = ((x - mean) / scale).astype(np.float32)
        share = float(np.clip(weight @ y, 0.01, 0.99))
        w, b, vw, vb = np.zeros(x.shape[1], dtype=np.float32), float(np.log(share / (1 - share))), 0.0, 0.0
        for _ in range(steps):
            gap = weight * (_sigmoid(z @ w + b) - y).astype(np.float32)
            vw = 0.9 * vw - rate * 4 * (z.T @ gap + l2 * w)
            vb = 0.9 * vb - rate * float(gap.sum())
            w, b = w + vw, b + vb
        return cls(mean, scale, w, b)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w + self.b


def _log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0.5, -logits, logits)).mean())


@dataclass
class Platt:
    """A view's logit to a calibrated one: slope (not negative) and offset."""

    slope: float
    offset: float

    @classmethod
    def fit(cls, logits: np.ndarray, y: np.ndarray) -> "Platt":
        one = Logistic.fit(logits[:, None], y, l2=1e-2, steps=300)
        slope = float(one.w[0] / one.scale[0])
        if slope <= 0:  # the view says nothing about held-out rows: its prior remains
            share = float(np.clip(y.mean(), 0.01, 0.99))
            return cls(0.0, float(np.log(share / (1 - share))))
        return cls(slope, float(one.b - slope * one.mean[0]))

    def __call__(self, logits: np.ndarray) -> np.ndarray:
        return self.slope * logits + self.offset


@dataclass
class View:
    """One view's training rows, and the view fitted and calibrated on them."""

    x: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    held_x: np.ndarray
    truth: np.ndarray

    def __post_init__(self):
        self.model = Logistic.fit(self.x, self.y, self.weight)
        self.platt = Platt.fit(self.model.logit(self.held_x), self.truth)
        self.loss = _log_loss(self.platt(self.model.logit(self.held_x)), self.truth)
        share = float(np.clip(self.truth.mean(), 0.01, 0.99))
        #: Better than the class shares alone by a tenth: else it has nothing to teach.
        self.knows = self.platt.slope > 0 and self.loss < 0.9 * _log_loss(np.full(len(self.truth), np.log(share / (1 - share))), self.truth)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.platt(self.model.logit(x)))

    def taught(self, x: np.ndarray, y: np.ndarray, part: float) -> "View":
        """The same view with more rows, which together weigh ``part`` of the labelled ones."""
        own = np.where(self.weight == 1, 1.0, 0.0)
        weight = np.concatenate([own, np.zeros(len(self.weight) - len(own)), np.ones(len(x))])
        handed = np.concatenate([self.weight != 1, np.ones(len(x), dtype=bool)])
        weight[handed] = part * own.sum() / handed.sum()
        return View(np.concatenate([self.x, x]), np.concatenate([self.y, y]), weight, self.held_x, self.truth)


#: Weights that are tried for each calibrated view.
WEIGHTS = np.arange(0, 1.51, 0.25)
#: Labels, and labels of each class, that calibration needs.
LEAST_LABELS, LEAST_OF_CLASS = 30, 5


@dataclass
class CoTrained:
    """Both views, the calibration of each and how much each counts.

    ``state``: "co-trained"; "shrunk" where labels are too few to hold any out (the text view alone,
    drawn to the class shares); "unfitted" without labels of both classes: then everything is kept.
    """

    text: Logistic | None = None
    meta: Logistic | None = None
    platts: tuple[Platt, ...] = ()
    weights: tuple[float, ...] = ()
    prior: float = 0.0
    exchanged: tuple[int, ...] = ()
    state: str = "unfitted"

    def views(self, text_x: np.ndarray, meta_x: np.ndarray) -> np.ndarray:
        """Calibrated logits of the text view and the metadata view."""
        return np.stack([c(v.logit(x)) for c, v, x in zip(self.platts, (self.text, self.meta), (text_x, meta_x))], axis=1)

    def score(self, text_x: np.ndarray, meta_x: np.ndarray) -> np.ndarray:
        if self.text is None:
            return np.ones(len(text_x))
        return _sigmoid(self.prior + (self.views(text_x, meta_x) - self.prior) @ np.array(self.weights))


def surest(views: list[View], xs, keys, taken: list[set[int]], most: list[int], sure: float) -> list[tuple]:
    """(giver, label, certainty, row): what each view hands to the other, of label i at most ``most[i]`` rows."""
    out = []
    for giver, (view, x) in enumerate(zip(views, xs)):
        if not view.knows:
            continue
        p = view.probability(x)
        free = np.array([k not in taken[1 - giver] for k in keys], dtype=bool)
        for label, certain in ((1, p), (0, 1 - p)):
            rows = np.flatnonzero(free & (certain >= sure))
            rows = rows[np.argsort(-certain[rows], kind="stable")[: most[label]]]
            out += [(giver, label, float(certain[i]), int(i)) for i in rows]
    return out


def _train(text_x, meta_x, y, hand, rounds: int, part: float = 0.5) -> CoTrained:
    """``hand(views, taken)`` gives (giver, label, key, text row, metadata row) of the documents handed over."""
    least = min(y.sum(), len(y) - y.sum()) if len(y) else 0
    if least < 1:
        return CoTrained()
    share = float(np.clip(y.mean(), 0.01, 0.99))
    prior = float(np.log(share / (1 - share)))
    if len(y) < LEAST_LABELS or least < LEAST_OF_CLASS:
        one, same = Logistic.fit(text_x, y, l2=1.0), Platt(1.0, 0.0)
        return CoTrained(one, Logistic.fit(meta_x, y, l2=1.0), (same, same), (1.0, 0.0), prior, (), "shrunk")
    held = np.arange(len(y)) % 3 == 2
    truth = y[held].astype(float)
    views = [View(x[~held], y[~held], np.ones((~held).sum()), x[held], truth) for x in (text_x, meta_x)]
    taken, exchanged = [set(), set()], []
    for _ in range(rounds):
        rows, new = hand(views, taken), list(views)
        for taker in (0, 1):
            if given := [r for r in rows if r[0] == 1 - taker]:
                taken[taker].update(r[2] for r in given)
                tried = views[taker].taught(np.stack([r[3 + taker] for r in given]), np.array([float(r[1]) for r in given]), part)
                both = [*new[:taker], tried, *new[taker + 1 :]]
                if tried.loss <= new[taker].loss and _combined(both)[0] <= _combined(new)[0]:
                    new = both
        exchanged.append(sum(len(n.y) - len(v.y) for n, v in zip(new, views)))
        if not rows:
            break
        views = new
    text, meta = views
    _, weights, prior = _combined(views)
    return CoTrained(text.model, meta.model, (text.platt, meta.platt), weights, prior, tuple(exchanged), "co-trained")


def _combined(views: list[View]) -> tuple[float, tuple[float, float], float]:
    """Held-out loss, weights and prior of the two calibrated views taken together."""
    truth = views[0].truth
    share = float(np.clip(truth.mean(), 0.01, 0.99))
    prior = float(np.log(share / (1 - share)))
    beyond = np.stack([v.platt(v.model.logit(v.held_x)) for v in views], axis=1) - prior
    tried = [(_log_loss(prior + beyond @ np.array([a, b]), truth), abs(a - 1) + abs(b - 1), float(a), float(b)) for a in WEIGHTS for b in WEIGHTS]
    best = min(tried)
    return best[0], best[2:], prior


def _shares(y: np.ndarray, most: int) -> list[int]:
    """``most`` rows in the proportion of the labels' classes (0, 1), one of each at least."""
    good = float(np.mean(y)) if len(y) else 0.5
    return [max(1, round(most * (1 - good))), max(1, round(most * good))]


def co_train(text_x, meta_x, y, pool_text, pool_meta, rounds: int = 3, share: float = 0.2, sure: float = 0.95) -> CoTrained:
    """Co-training over arrays. A third of the labelled rows is held out for calibration; the rest starts both views.

    In each round a view hands over at most ``share`` of the pool, its surest documents,
    in the classes' proportion and only those at ``sure`` or beyond.
    """
    most = _shares(y, max(1, int(share * len(pool_text))))

    def hand(views, taken):
        if not len(pool_text):
            return []
        picked = surest(views, (pool_text, pool_meta), range(len(pool_text)), taken, most, sure)
        return [(giver, label, i, pool_text[i], pool_meta[i]) for giver, label, _, i in picked]

    return _train(text_x, meta_x, y, hand, rounds)


FEATURES = "doc_id long, source string, lang string, n_chars long, x binary"


def _meta_rows(source, lang, n_chars) -> np.ndarray:
    return np.stack([meta_view(*row) for row in zip(source, lang, n_chars)])


def stored_features(docs: DataFrame) -> DataFrame:
    """FEATURES of every document, written once: about 1 KB each."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                x = pa.array([pack_text(t.as_py()) for t in part.column(4)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], x], names=[*part.schema.names[:4], "x"])

    fields = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    return cut(fields.mapInArrow(trimmed(run), FEATURES), "quality-features")


def _handed(pool: DataFrame, views: list[View], taken: list[set[int]], most: list[int], sure: float) -> list[tuple]:
    """The surest of the whole ``pool``, rows alike in all features once: at most ``most`` for each view and label come to the driver."""
    if not any(v.knows for v in views):
        return []
    names, kinds = ["giver", "label", "key", "certain", "x", "source", "lang", "n_chars"], "giver int, label int, key long, certain double, x binary, source string, lang string, n_chars long"

    def run(batches):
        import pyarrow as pa
        import xxhash

        best: dict[tuple[int, int], dict[int, tuple]] = {(g, la): {} for g in (0, 1) for la in (0, 1)}
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                source, lang, n_chars, packed = (c.to_pylist() for c in batch.slice(lo, 512).columns)
                keys = [xxhash.xxh64_intdigest(x + repr(m).encode("utf-8", "surrogatepass")) >> 1 for x, *m in zip(packed, source, lang, n_chars)]
                xs = unpack_texts(packed), _meta_rows(source, lang, n_chars)
                for giver, label, certain, i in surest(views, xs, keys, taken, most, sure):
                    best[giver, label][keys[i]] = (certain, packed[i], source[i], lang[i], n_chars[i])
                for group, rows in best.items():
                    if len(rows) > most[group[1]]:
                        best[group] = dict(sorted(rows.items(), key=lambda r: (-r[1][0], r[0]))[: most[group[1]]])
        types = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.string(), pa.string(), pa.int64()]
        for (giver, label), rows in best.items():
            if rows:
                cols = [[giver] * len(rows), [label] * len(rows), list(rows), *zip(*rows.values())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names=names)

    found = cut(pool.select("source", "lang", "n_chars", "x").mapInArrow(trimmed(run), kinds), "surest")
    out = []
    for giver in (0, 1):
        for label in (0, 1):
            one = found.filter((F.col("giver") == giver) & (F.col("label") == label)).dropDuplicates(["key"])
            for r in one.orderBy(F.desc("certain"), "key").limit(most[label]).collect():
                out.append((giver, label, r.key, unpack_texts([r.x])[0], meta_view(r.source, r.lang, r.n_chars)))
    return out


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 3000, rounds: int = 3, most: int = 400, sure: float = 0.95) -> CoTrained:
    """Fit on a bounded sample of labels: the ``labelled`` doc_ids with a label of smallest hash.

    All other documents are the pool: their features are stored once, in each round every one of
    them is scored, and each view hands the other its ``most`` surest documents, from ``sure`` on, in the
    proportion of the labelled classes.

    A doc_id with several labels takes the smallest, one with several rows the row of
    smallest features; null labels and ids are left out, texts count whole. With under
    LEAST_LABELS labels, or under LEAST_OF_CLASS of a class, no exchange can be judged: the model's
    ``state`` says "shrunk" (text view alone, strongly regularised) or, without
    labels of both classes, "unfitted" (everything is kept with score 1).
    """
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("long").alias("quality"))
    known = marks.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(labelled).collect()
    picked = F.broadcast(docs.sparkSession.createDataFrame([tuple(r) for r in known], "known_id long, quality long"))  # at most ``labelled`` rows
    features = stored_features(docs)
    rows = features.join(picked, F.col("doc_id") == F.col("known_id"))
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct("x", "source", "lang", "n_chars")).alias("row")).collect()
    rows.sort(key=lambda r: r.doc_id)
    if not rows:
        return CoTrained()
    text_x, meta_x = unpack_texts([r.row.x for r in rows]), _meta_rows(*zip(*(r.row[1:] for r in rows)))
    y = np.array([float(r.quality > 0) for r in rows])
    pool, shares = features.join(picked, F.col("doc_id") == F.col("known_id"), "left_anti"), _shares(y, most)
    return _train(text_x, meta_x, y, lambda views, taken: _handed(pool, views, taken, shares, sure), rounds)


def score(docs: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """All columns of ``docs``, ``cotrain_score`` (0 to 1), ``cotrain_kept`` and the model's ``cotrain_state``, row by row.

    Null text counts as empty, null metadata as a value of its own; a text of any length
    is scored whole; rows alike get the same score, repeated doc_ids each their own; a score
    of ``threshold`` itself is kept. Input columns with the new names are replaced, no
    other name clashes. An empty table gives no rows.
    """
    new = ("cotrain_score", "cotrain_kept", "cotrain_state")
    docs = docs.select(*(c for c in docs.columns if c not in new))
    schema = docs.select("*", F.lit(0.0).alias(new[0]), F.lit(True).alias(new[1]), F.lit("").alias(new[2])).schema
    # the four fields stand first, under names that no column has
    names = free_names(docs, 4)
    fields = docs.select(*(F.col(c).alias(n) for n, c in zip(names, ("text", "source", "lang"))), F.col("n_chars").cast("long").alias(names[3]), "*")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                text, *meta = (part.column(i).to_pylist() for i in range(4))
                p = model.score(unpack_texts([pack_text(t) for t in text]), _meta_rows(*meta)).astype(np.float64)
                state = pa.array([model.state] * len(p))
                yield pa.RecordBatch.from_arrays([*part.columns[4:], pa.array(p), pa.array(p >= threshold), state], names=[*part.schema.names[4:], *new])

    return fields.mapInArrow(trimmed(run), schema)
