"""Repeated passages by a sparse suffix array.

Of every text only the suffixes at content-selected positions are retained: a
word position whose hash is the smallest of ``window`` neighbouring ones. Equal
passages select equal positions, so a passage of ``min_words`` words holds a
retained suffix among its first ``window`` words, and the suffix shares the
``min_words - window + 1`` words from there (the seed).

Suffixes whose seed occurs in two different texts are sorted by content over the
whole cluster (a range sort that also deals out one common passage). A passage that
begins some words before its retained suffix is shared by the suffixes of one block
of the order (enough common content) that also have these words before them; the
first and last seed of each partition are matched with the other partitions by
passage. Spans of one document are then merged.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, cut, small, trimmed
from .sets import STEP, U64, column_hashes, mixed, window_hashes, word_hashes
from .tokens import text_slices

#: Windows that are compared at once; argmin copies each of them.
SLICE = 1 << 15

TEXTS = "kind int, doc_id long, t1 long, t2 long, n_words long, seed long, pos int"
SUFFIXES = "seed long, doc_id long, t1 long, pos int, n_words long, content binary"
#: Suffixes that leave a task that reads texts at once.
ROWS = 4096


@dataclass(frozen=True)
class Passages:
    """Passages of at least ``min_words`` words; ``window`` positions hold one retained suffix."""

    min_words: int = 50
    window: int = 16
    key: int = 4  # words hashed to select positions

    @property
    def seed(self) -> int:
        return self.min_words - self.window + 1


def retained(h: np.ndarray, how: Passages) -> np.ndarray:
    """Positions (with a whole seed behind them) that are the smallest of some window."""
    keys = mixed(window_hashes(h, how.key))
    n = len(h) - how.seed + 1  # positions with a seed
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    keys = keys[: min(len(keys), n + how.window)]
    if len(keys) < how.window:
        return np.arange(n)[:1] if not len(keys) else np.array([int(keys[:n].argmin())])
    views = np.lib.stride_tricks.sliding_window_view(keys, how.window)
    chosen = [np.unique(views[lo : lo + SLICE].argmin(axis=1) + np.arange(lo, min(lo + SLICE, len(views)))) for lo in range(0, len(views), SLICE)]
    chosen = np.unique(np.concatenate(chosen))
    return chosen[chosen < n]


def _text_id(raw: bytes | memoryview) -> np.ndarray:
    import xxhash

    return np.frombuffer(xxhash.xxh3_128_digest(raw), dtype="<i8")


def _scan(docs: DataFrame, how: Passages) -> DataFrame:
    """kind 0: a row for each document; kind 1: a row for each retained suffix."""

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int32(), *[pa.int64()] * 5, pa.int32()]
        names = [x.split()[0] for x in TEXTS.split(", ")]
        for batch in batches:
            doc_ids = batch.column(0).to_numpy()
            for lo, data, offsets in text_slices(batch.column(1), STEP):
                h, at = word_hashes(data, offsets)
                m = len(at) - 1
                seeds, doc, raw = window_hashes(h, how.seed).view(np.int64), doc_ids[lo : lo + m], memoryview(data)
                ids = np.stack([_text_id(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])])
                chosen = [retained(h[a:b], how) for a, b in zip(at[:-1], at[1:])]
                text = np.repeat(np.arange(m), [len(c) for c in chosen])
                pos, n_words = np.concatenate(chosen), np.diff(at)
                none = pa.nulls(m, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((np.zeros(m, int), doc, ids[:, 0], ids[:, 1], n_words, none, none.cast(pa.int32())), kinds)], names=names)
                if len(pos):
                    cols = (np.ones(len(pos), int), doc[text], ids[text, 0], ids[text, 1], n_words[text], seeds[at[text] + pos], pos)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), TEXTS)


def _context_rows(h: np.ndarray, at: np.ndarray, how: Passages) -> np.ndarray:
    """Of each position the words from it on, then (nearest first) those before it, in big-endian uint32; 0 beyond the text."""
    words = np.concatenate([(h >> U64(32)).astype(">u4"), np.zeros(1, dtype=">u4")])
    reach = np.concatenate([np.arange(how.min_words), -1 - np.arange(how.window)])
    places = at[:, None] + reach
    return words[np.where((places < 0) | (places > len(h)), len(h), places)]


def _contexts(docs: DataFrame, places: DataFrame, how: Passages, broadcast_bytes: int) -> DataFrame:
    """The contested suffixes with the word hashes behind and before them, in one column of fixed width.

    They are written before they are sorted: the sort's samples then read no text, and texts, sorter
    and comparison are never in one task.
    """
    lists = cut(places.groupBy("doc_id", "t1").agg(F.sort_array(F.collect_list("pos")).alias("at")), "suffix-lists")
    chosen = docs.select("doc_id", "text").join(small(lists, broadcast_bytes), "doc_id")
    width = 4 * (how.min_words + how.window)

    def run(batches):
        import pyarrow as pa

        names = [x.split()[0] for x in SUFFIXES.split(", ")]

        def out(rows):
            seed, doc, t1, pos, n, content = (np.concatenate(c) for c in zip(*rows))
            ends = np.arange(len(seed) + 1, dtype=np.int32) * width
            binary = pa.Array.from_buffers(pa.binary(), len(seed), [None, pa.py_buffer(ends), pa.py_buffer(content.tobytes())])
            return pa.RecordBatch.from_arrays([pa.array(seed), pa.array(doc), pa.array(t1), pa.array(pos, pa.int32()), pa.array(n), binary], names=names)

        for batch in batches:
            doc_ids, t1s, lists_, rows, held = *(batch.column(i).to_pylist() for i in (0, 2, 3)), [], 0
            for i, h in column_hashes(batch.column(1)):
                if int(_text_id((batch.column(1)[i].as_py() or "").encode())[0]) != t1s[i]:  # another row under the same doc_id
                    continue
                seeds = window_hashes(h, how.seed).view(np.int64)
                for lo in range(0, len(lists_[i]), ROWS):
                    at = np.array(lists_[i][lo : lo + ROWS], dtype=np.int64)
                    same = lambda v, m=len(at): np.full(m, v, dtype=np.int64)
                    rows.append((seeds[at], same(doc_ids[i]), same(t1s[i]), at, same(len(h)), _context_rows(h, at, how)))
                    held += len(at)
                    if held >= ROWS:
                        yield out(rows)
                        rows, held = [], 0
            if rows:
                yield out(rows)

    return cut(chosen.select("doc_id", "text", "t1", "at").mapInArrow(trimmed(run), SUFFIXES), "suffix-contexts")


def _words_of(table, how: Passages) -> tuple[np.ndarray, ...]:
    """(words behind, their numbers, words before, their numbers) of a table's suffixes."""
    width = how.min_words + how.window
    flat = np.frombuffer(b"".join(b for chunk in table.column("content").chunks for b in [_data(chunk)]), dtype=">u4").reshape(-1, width)
    pos, n = table.column("pos").to_numpy().astype(np.int64), table.column("n_words").to_numpy()
    flat = flat.astype(np.uint32)
    return flat[:, : how.min_words], np.minimum(n - pos, how.min_words), flat[:, how.min_words :], np.minimum(pos, how.window)


def _data(chunk) -> memoryview:
    """The bytes of a chunk of binaries, one behind the other."""
    _, ends, data = chunk.buffers()
    if not len(chunk):
        return memoryview(b"")
    ends = np.frombuffer(ends, dtype=np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
    return memoryview(data)[int(ends[0]) : int(ends[-1])]


def _blocks(table, how: Passages):
    """For each number of words before a suffix: the sorted suffixes that have one passage in common.

    Yields (words before, rows, first of each group in rows, group of each row). Suffixes
    of one group share ``min_words`` words: the block of the order whose common content
    is long enough, divided by the words before it.
    """
    seed = table.column("seed").to_numpy()
    words, right, back, left = _words_of(table, how)
    differ = words[1:] != words[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), how.min_words)
    shared = np.minimum(shared, np.minimum(right[1:], right[:-1]))
    shared[seed[1:] != seed[:-1]] = 0
    behind = np.zeros(len(seed), dtype=U64)
    for n in range(how.window):
        if n:
            behind = mixed(behind * U64(0x9E3779B97F4A7C15) + back[:, n - 1] + U64(n))
        block = np.concatenate([[0], np.cumsum(shared < how.min_words - n)])
        rows = np.flatnonzero((left >= n) & (right >= how.min_words - n))
        if not len(rows):
            continue
        rows = rows[np.lexsort((behind[rows], block[rows]))]
        opens = (block[rows[1:]] != block[rows[:-1]]) | (behind[rows[1:]] != behind[rows[:-1]])
        yield n, rows, np.flatnonzero(np.concatenate([[True], opens])), np.concatenate([[0], np.cumsum(opens)])


def _shared_passages(table, how: Passages) -> tuple[np.ndarray, ...]:
    """doc_id, t1, start, end and other document of the suffixes in passages of two documents."""
    doc, t1, pos = (table.column(c).to_numpy() for c in ("doc_id", "t1", "pos"))
    start, end, other = pos.astype(np.int64), np.full(len(doc), -1), np.full(len(doc), np.iinfo(np.int64).max)
    for n, rows, first, group in _blocks(table, how):
        lo, hi = (f.reduceat(doc[rows], first)[group] for f in (np.minimum, np.maximum))
        two = lo < hi
        rows, lo, hi = rows[two], lo[two], hi[two]
        start[rows] = pos[rows] - n
        end[rows] = np.maximum(end[rows], pos[rows] - n + how.min_words)
        other[rows] = np.minimum(other[rows], np.where(doc[rows] == lo, hi, lo))
    found = end >= 0
    return doc[found], t1[found], start[found], end[found], other[found]


SPANS = "doc_id long, t1 long, start long, end long, other long, passage binary, lo long, hi long, starts array<long>"


def _compare(suffixes: DataFrame, n_suffixes: int, how: Passages, per_task: int = 50_000) -> DataFrame:
    """Spans within each sorted partition, and the passages of its first and last seed for the others.

    A task holds its partition, about ``per_task`` suffixes, as arrays: partitions grow in number, not in size.
    """

    def run(batches):
        import pyarrow as pa

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        names = [x.split()[0] for x in SPANS.split(", ")]
        kinds = [*[pa.int64()] * 5, pa.binary(), *[pa.int64()] * 2, pa.list_(pa.int64())]
        found = _shared_passages(table, how)
        for lo in range(0, len(found[0]), 8192):
            part = [pa.array(c[lo : lo + 8192], pa.int64()) for c in found]
            yield pa.RecordBatch.from_arrays([*part, *(pa.nulls(len(part[0]), k) for k in kinds[5:])], names=names)
        seed = table.column("seed").to_numpy()
        edges = _edge_passages(table.filter(pa.array((seed == seed[0]) | (seed == seed[-1]))), how)
        while out := list(itertools.islice(edges, 8192)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    n = max(1, int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_suffixes // per_task))
    ordered = suffixes.repartitionByRange(n, "seed", "content", "doc_id", "pos").sortWithinPartitions("seed", "content", "doc_id", "pos")
    return ordered.mapInArrow(trimmed(run), SPANS)


def _edge_passages(table, how: Passages):
    """A row for each passage: its identity, its smallest and largest document and, if these are one, its places.

    The places of passages of two documents are spans already.
    """
    import xxhash

    seed, doc, t1, pos = (table.column(c).to_numpy() for c in ("seed", "doc_id", "t1", "pos"))
    content, behind = table.column("content"), 4 * how.min_words
    for n, rows, first, _ in _blocks(table, how):
        for members in np.split(rows, first[1:]):
            at = int(members[0])
            row = content[at].as_py()
            words = row[behind : behind + 4 * n] + row[: behind - 4 * n]
            passage = xxhash.xxh3_128_digest(int(seed[at]).to_bytes(8, "little", signed=True) + bytes([n]) + words)
            lo, hi = int(doc[members].min()), int(doc[members].max())
            if lo < hi:
                yield (None, None, None, None, None, passage, lo, hi, None)
                continue
            for text in np.unique(t1[members]):
                yield (lo, int(text), None, None, None, passage, lo, hi, (pos[members[t1[members] == text]] - n).tolist())


def _across(found: DataFrame, how: Passages, broadcast_bytes: int) -> DataFrame:
    """Spans of passages whose documents lie in different partitions."""
    edges = found.filter("passage IS NOT NULL")
    two = edges.groupBy("passage").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi")).filter("_lo <> _hi")
    two = small(cut(two, "edge-passages"), broadcast_bytes)
    spans = edges.filter("starts IS NOT NULL").join(two, "passage")
    other = F.when(F.col("doc_id") == F.col("_lo"), F.col("_hi")).otherwise(F.col("_lo")).alias("other")
    spans = spans.select("doc_id", "t1", F.explode("starts").alias("start"), other)
    return spans.select("doc_id", "t1", "start", (F.col("start") + how.min_words).alias("end"), "other")


def repeated_passages(docs: DataFrame, how: Passages = Passages(), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, start_word, end_word (exclusive), n_words (of the text), other_doc_id: a row for each span.

    Texts that are equal and have at least ``min_words`` words are whole spans; of
    these only the smallest doc_id is compared with other texts. Null, empty and
    short texts and null doc_ids have no spans; repeats inside one document only
    are left alone. Texts are read whole, however long; other columns are not read. Rows of
    one doc_id with different texts are one document, whose spans may be given for each.
    An empty table gives no rows. other_doc_id is one of the other
    documents; with several, which one can depend on the partitions, the words can't.
    """
    docs = docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    rows = cut(_scan(docs, how), "suffixes")
    texts = rows.filter(F.col("kind") == 0).filter(F.col("n_words") >= how.min_words)
    same = texts.groupBy("t1", "t2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.first("n_words").alias("n_words"))
    same = cut(same, "equal-texts")
    groups = small(cut(same.filter("rep < last").select("t1", "t2", "rep", "last"), "copies"), broadcast_bytes)
    copied = cut(texts.select("doc_id", "t1", "t2", "n_words").join(groups, ["t1", "t2"]), "copied-texts")
    later = cut(copied.filter("doc_id <> rep").select("doc_id", "t1").distinct(), "later-copies")

    held = rows.filter("kind = 1").filter(F.col("n_words") >= how.min_words)
    seeds = held.groupBy("seed").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi")).filter("lo <> hi").select("seed")
    seeds = cut(seeds, "contested-seeds")
    places = held.select("seed", "doc_id", "t1", "pos").join(small(seeds, broadcast_bytes), "seed")
    places = places.join(small(later, broadcast_bytes), ["doc_id", "t1"], "left_anti")
    places = cut(places.select("doc_id", "t1", "pos").distinct(), "contested-suffixes")

    found = cut(_compare(_contexts(docs, places, how, broadcast_bytes), places.count(), how), "spans")
    spans = found.filter("passage IS NULL").select("doc_id", "t1", "start", "end", "other").unionByName(_across(found, how, broadcast_bytes))

    # spans that touch or overlap become one
    order = Window.partitionBy("doc_id", "t1").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.when(reach >= F.col("start"), 0).otherwise(1))
    spans = spans.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "t1", "island").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("other").alias("other_doc_id"))
    single = same.filter("rep = last").select(F.col("rep").alias("doc_id"), "t1", "n_words")
    spans = spans.join(single, ["doc_id", "t1"]).select("doc_id", "start_word", "end_word", "n_words", "other_doc_id")

    other = F.when(F.col("doc_id") == F.col("rep"), F.col("last")).otherwise(F.col("rep"))
    whole = copied.select("doc_id", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"), "n_words", other.alias("other_doc_id"))
    return spans.unionByName(whole)
