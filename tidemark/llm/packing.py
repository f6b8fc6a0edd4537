"""Harmonic packing of token ids into fixed sequences.

Slots are the capacity over a set of reciprocals. A document's ids are cut into
whole sequences and then into pieces that fill a slot nearly or exactly; each
class j takes exactly j pieces a sequence. Every worker fills the bins of its
own classes while it streams, so no text is shuffled; the few pieces left in
open bins (fewer than j for each worker and class) are dealt into bins of their
class once more, for each share of 256 neighbouring workers by itself.
"""

from __future__ import annotations

import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, trimmed
from .tokens import default_tokenizer, encoded_batches

#: Reciprocals: class j holds pieces of at most capacity // j ids, j to a sequence.
CLASSES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)

#: Workers of one share, as a power of two: a share leaves at most one open bin a class.
WORKERS_BITS = 8

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, worker long, bin long, offset long"


def cut_lengths(n: int, capacity: int = 1024, classes: tuple[int, ...] = CLASSES, slack: int = 16) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document of ``n`` ids, in order.

    A rest stays whole if it leaves at most 1/slack of itself empty in its slot,
    or fits the smallest slot; else the largest slot below it is cut off, full.
    """
    slots = [(j, capacity // j) for j in classes if capacity // j]
    out = [(1, capacity)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = max(i for i, (_, slot) in enumerate(slots) if slot >= rest)
        j, slot = slots[k]
        if k + 1 < len(slots) and slot - rest > rest // slack:
            j, length = slots[k + 1]
        else:
            length = rest
        out.append((j, length))
        rest -= length
    return out


def pack(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, class.

    Null text is an empty document (its end id only); null and repeated doc_ids
    are packed row by row, equal rows each for itself; a long text is cut into whole
    sequences and a rest; other columns are not read. An empty table gives no rows.
    Sequence ids are unique and depend on the table's splits.
    """
    path = tokenizer or default_tokenizer()

    def fill(batches):
        import pyarrow as pa

        worker = TaskContext.get().partitionId()
        waiting: dict[int, list[tuple]] = {j: [] for j in CLASSES}
        n_bins, rows = 0, []

        def flush():
            cols = list(zip(*rows))
            kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.int64()] * 3
            names = [x.split()[0] for x in PIECES.split(", ")]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for doc_ids, ids, at in encoded_batches(batches, path, end_id):
            whole = memoryview(ids).cast("B")
            for doc_id, lo, hi in zip(doc_ids, at[:-1].tolist(), at[1:].tolist()):
                n, start = hi - lo, 0
                for j, length in cut_lengths(n, capacity):
                    crc = zlib.crc32(whole[4 * (lo + start) : 4 * (lo + start + length)])
                    waiting[j].append((doc_id, start, length, crc, n, j))
                    start += length
                    if len(waiting[j]) == j:
                        offset = 0
                        for piece in waiting[j]:
                            rows.append((*piece, worker, n_bins, offset))
                            offset += piece[2]
                        waiting[j].clear()
                        n_bins += 1
                if len(rows) >= 4096:
                    yield flush()
        for j in CLASSES:
            rows.extend((*piece, worker, None, k) for k, piece in enumerate(waiting[j]))
        if rows:
            yield flush()

    pieces = cut(docs.select("doc_id", "text").mapInArrow(trimmed(fill), PIECES), "pieces")
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"]
    full = pieces.filter("bin IS NOT NULL").withColumn("sequence_id", F.shiftleft("worker", 32) + F.col("bin"))
    left = pieces.filter("bin IS NULL").withColumn("share", F.shiftright("worker", WORKERS_BITS))
    of_class = Window.partitionBy("share", "class").orderBy("worker", "offset")
    left = left.withColumn("bin", F.floor((F.row_number().over(of_class) - 1) / F.col("class")))
    in_bin = Window.partitionBy("share", "class", "bin").orderBy("worker", "offset").rowsBetween(Window.unboundedPreceding, -1)
    place = F.shiftleft(F.col("class").cast("long"), 52) + F.shiftleft("share", 20) + F.col("bin")
    left = left.withColumn("sequence_id", F.lit(1 << 62) + place)
    left = left.withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)).cast("long"))
    return full.select(result).unionByName(left.select(result))
