"""Language ID by nearest centroid over TF-IDF byte n-grams.

Document frequencies cover every training row. Centroids come from spherical
k-means, several for each language, on a bounded sample of the training rows
(``sample`` of each language). A text takes the language of its nearest centroid by cosine; one
farther from it than nearly all training rows of that language is marked
``rejected``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import trimmed
from .features import trigram_counts

DIMS = 4096


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _counts(text: str) -> np.ndarray:
    return trigram_counts(text.lower().encode("utf-8", "surrogatepass"), DIMS)


def _vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), len(idf)), dtype=np.float32)
    for i, c in enumerate(counts):
        np.log1p(c, out=out[i], casting="unsafe")
    out *= idf
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1)


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; deterministic."""
    seeds = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin((x @ x[seeds].T).max(axis=1))))
    c = x[seeds]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


@dataclass
class LanguageModel:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    floors: np.ndarray  # smallest cosine at which a centroid's language is accepted

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and self.langs and has_letter(t)]
        if known:
            cosines = _vectors([_counts(texts[i]) for i in known], self.idf) @ self.centroids.T
            best = cosines.argmax(axis=1)
            for row, (i, j) in enumerate(zip(known, best)):
                score = float(min(1.0, max(0.0, cosines[row, j])))
                out[i] = (self.langs[j], score, score < float(self.floors[j]))
        return out


def fit(train: DataFrame, sample: int = 1000, per_lang: int = 4, reject_share: float = 0.002) -> LanguageModel:
    """``train``: doc_id, text, lang. Of each language the ``sample`` rows with the smallest hashes are clustered.

    Rows with a null text or lang teach nothing; rows alike in doc_id and text count
    once in the sample. Without any row nothing is learned, and every text is ``und``.
    A text is rejected below the cosine that all but ``reject_share`` of the sampled rows reach.
    """
    train = train.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(batches):
        import pyarrow as pa

        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += _counts(text) > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMS), -1)), pa.array(np.append(total, n))], names=["bucket", "n"])

    rows = train.select("text").mapInArrow(trimmed(frequencies), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(DIMS), 0
    for bucket, count in rows:
        if bucket < 0:
            n = count
        else:
            df[bucket] = count
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)

    # the rows of smallest hash of each language; few more than ``sample`` of a language get to be ranked
    h = F.xxhash64("doc_id", "text", F.lit(11))
    sizes = [(r.lang, r["count"]) for r in train.groupBy("lang").count().collect()]
    if not sizes:
        return LanguageModel(idf, np.zeros((0, DIMS), dtype=np.float32), [], np.zeros(0))
    shares = F.broadcast(train.sparkSession.createDataFrame([(la, min(1.0, (2 * sample + 100) / n)) for la, n in sizes], "lang string, share double"))
    likely = train.withColumn("h", h).join(shares, "lang").filter(F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    ids = likely.select("lang", "h", "doc_id").distinct().withColumn("rank", rank).filter(F.col("rank") <= sample).select("lang", "h", "doc_id")

    def sampled(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(d, la, _counts(t).astype("<u4").tobytes()) for d, la, t in zip(*(batch.column(i).to_pylist() for i in range(3))) if has_letter(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.binary()))], names=["doc_id", "lang", "counts"])

    # whole texts are counted where they lie; the driver gets 4 * DIMS bytes for each sampled row
    chosen = likely.join(F.broadcast(ids), ["lang", "h", "doc_id"]).select("doc_id", "lang", "text")  # at most ``sample`` rows a language
    picked = chosen.mapInArrow(trimmed(sampled), "doc_id long, lang string, counts binary").distinct().orderBy("lang", "doc_id", "counts").collect()
    by_lang: dict[str, list[np.ndarray]] = {}
    for _, lang, counts in picked:
        by_lang.setdefault(lang, []).append(np.frombuffer(counts, dtype="<u4"))
    centroids, langs, floors = [np.zeros((0, DIMS), dtype=np.float32)], [], []
    for lang in sorted(by_lang):
        x = _vectors(by_lang[lang], idf)
        c = _kmeans(x, per_lang)
        nearest = (x @ c.T).max(axis=1)
        centroids.append(c)
        langs += [lang] * len(c)
        floors += [float(np.quantile(nearest, reject_share))] * len(c)
    return LanguageModel(idf, np.concatenate(centroids).astype(np.float32), langs, np.array(floors))


PREDICTED = "doc_id long, lang_pred string, score double, rejected boolean"


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1), rejected, one row for each document.

    ``und``, 0.0 and rejected where text is null, empty or without a letter, or
    where nothing was learned. ``lang_pred`` of a rejected text is still its
    nearest language, for who reads the column wants one of the learned values; take
    ``rejected`` to leave such texts out. Repeated doc_ids are predicted row by row, texts
    of any length whole; other columns are not read. An empty table gives no rows.
    """

    def run(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.string(), pa.float64(), pa.bool_())
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                cols = [part.column(0).to_pylist(), *zip(*model.predict(part.column(1).to_pylist()))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), PREDICTED)
