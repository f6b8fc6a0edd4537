"""Token-id files: independent zstandard frames, a document index and a trailing seek table.

A file holds, in ascending doc_id order, the ids of one range of documents:

* data frames, each an independent zstandard frame of at most ``frame_ids`` ids
  (little-endian unsigned 32-bit; a long document runs on in the next frames);
* a skippable frame (magic 0x184D2A50) with the compressed document index: for
  each document has_id u1, doc_id i8, first id in this file u8, count u8;
* the seek table, a skippable frame (magic 0x184D2A5E) as in the public
  zstandard seekable format: compressed size, decompressed size and the low 32
  bits of the content's XXH64 for each frame, then frame count, descriptor, magic.

A reader takes the tail, then only the frames of the documents asked for.
"""

from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, scratch_path, trimmed
from .tokens import default_tokenizer, encoded_batches

#: Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

INDEX = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("first", "<u8"), ("count", "<u8")])


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Streams documents into one file; holds one open frame and the index."""

    def __init__(self, out, frame_ids: int = 65_536, level: int = 3):
        import zstandard

        self._out, self._most = out, 4 * frame_ids
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._open, self._filled = [], 0
        self._frames: list[tuple[int, int, int]] = []
        self._index = [array("B"), array("q"), array("Q"), array("Q")]  # the columns of INDEX
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes | memoryview) -> None:
        for column, value in zip(self._index, (doc_id is not None, doc_id or 0, self.n_ids, len(ids) // 4)):
            column.append(value)
        self.n_ids += len(ids) // 4
        while ids:
            part, ids = ids[: self._most - self._filled], ids[self._most - self._filled :]
            self._open.append(part)
            self._filled += len(part)
            if self._filled >= self._most:
                self._flush()

    def _flush(self) -> None:
        import xxhash

        if self._filled:
            content = b"".join(self._open)
            packed = self._zstd.compress(content)
            self._out.write(packed)
            self._frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            self._open, self._filled = [], 0

    def close(self) -> None:
        self._flush()
        rows = np.empty(len(self._index[0]), dtype=INDEX)
        for name, column in zip(INDEX.names, self._index):
            rows[name] = column
        index = self._zstd.compress(rows.tobytes())
        self._out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self._frames.append((8 + len(index), 0, 0))
        table = b"".join(struct.pack("<III", *x) for x in self._frames)
        table += struct.pack("<IBI", len(self._frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


class TokenFileReader:
    """Random access by document; every frame read is held against its checksum."""

    def __init__(self, source):
        import zstandard

        self._in, self._unzstd = source, zstandard.ZstdDecompressor()
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - 9)
        n, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC or not descriptor & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        source.seek(end - 9 - 12 * n)
        frames = np.frombuffer(source.read(12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self._sizes, self._checks = frames[:, 0], frames[:, 2]
        self._at = np.concatenate([[0], np.cumsum(frames[:, 0])])
        self._ends = np.cumsum(frames[:-1, 1]) // 4  # ids up to and with each data frame
        source.seek(int(self._at[n - 1]))
        kind, length = struct.unpack("<II", source.read(8))
        if kind != SKIPPABLE_INDEX:
            raise ValueError("no document index before the seek table")
        self.index = np.frombuffer(self._unzstd.decompress(source.read(length)), dtype=INDEX)
        self.frames_read = 0
        self._last: tuple[int, bytes] = (-1, b"")

    def _frame(self, k: int) -> bytes:
        import xxhash

        if self._last[0] != k:
            self._in.seek(int(self._at[k]))
            content = self._unzstd.decompress(self._in.read(int(self._sizes[k])))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self._checks[k]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            self._last = (k, content)
            self.frames_read += 1
        return self._last[1]

    def ids(self, row: int) -> bytes:
        """The ids of the row-th document of the file."""
        first, count = int(self.index["first"][row]), int(self.index["count"][row])
        k, parts = int(np.searchsorted(self._ends, first, "right")), []
        while count:
            begin = int(self._ends[k - 1]) if k else 0
            part = self._frame(k)[4 * (first - begin) : 4 * (first - begin + count)]
            parts.append(part)
            first, count, k = first + len(part) // 4, count - len(part) // 4, k + 1
        return b"".join(parts)

    def __iter__(self):
        for row, (has_id, doc_id, first, count) in enumerate(self.index.tolist()):
            yield doc_id if has_id else None, first, count, self.ids(row)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, frame_ids: int = 65_536) -> DataFrame:
    """Encode ``text`` and write one file for each range of doc_id; returns the manifest.

    Manifest: part (ascending doc_id ranges), path, n_docs, n_ids. Null text counts
    as empty, null doc_ids come first, rows of one doc_id are ordered by text. A long
    text runs over as many frames as it needs; other columns are not read. A lost task writes the same bytes again under the same name: files are moved
    into place when whole.
    """
    path = tokenizer or default_tokenizer()

    def write(batches):
        import pyarrow as pa

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        fs, root = _filesystem(folder)
        name, out, writer, n = f"{root}/part-{part:05d}.tokens.zst", None, None, 0
        for doc_ids, ids, at in encoded_batches(batches, path):
            whole = memoryview(ids).cast("B")
            for doc_id, lo, hi in zip(doc_ids, at[:-1].tolist(), at[1:].tolist()):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{name}.{attempt}", compression=None)
                    writer = TokenFileWriter(out, frame_ids)
                writer.add(doc_id, whole[4 * lo : 4 * hi])
                n += 1
        if writer is not None:
            writer.close()
            out.close()
            fs.move(f"{name}.{attempt}", name)
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/{name.rsplit('/', 1)[1]}"], "n_docs": [n], "n_ids": [writer.n_ids]})

    tie = F.xxhash64("text")
    ranged = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie, "text")
    return ranged.mapInArrow(trimmed(write), "part long, path string, n_docs long, n_ids long")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Read files back: doc_id, start (ids of all documents before), n_tokens, ids (bytes)."""
    return _with_base(manifest).mapInArrow(trimmed(_reader(lambda ids: ids)), "doc_id long, start long, n_tokens long, ids binary")


def token_digests(manifest: DataFrame) -> DataFrame:
    """As read_token_files, with the unsigned crc32 of the ids for the ids themselves."""
    return _with_base(manifest).mapInArrow(trimmed(_reader(zlib.crc32)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _with_base(manifest: DataFrame) -> DataFrame:
    """One row for each file, dealt out; base: ids in the files before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("path", "part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("base"))
    return based.repartition(max(1, manifest.count()), "part").select("path", "base")


def _reader(digest):
    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, inner = _filesystem(path)
                with fs.open_input_file(inner) as source:
                    rows: list[tuple] = []
                    for doc_id, first, count, ids in TokenFileReader(source):
                        rows.append((doc_id, base + first, count, digest(ids)))
                        if len(rows) == 1024:
                            yield _batch(pa, rows)
                            rows = []
                    if rows:
                        yield _batch(pa, rows)

    def _batch(pa, rows):
        doc_id, start, count, last = zip(*rows)
        whole = pa.int64()
        kind = pa.binary() if isinstance(last[0], bytes) else whole
        return pa.RecordBatch.from_arrays([pa.array(doc_id, whole), pa.array(start, whole), pa.array(count, whole), pa.array(last, kind)], names=["doc_id", "start", "n_tokens", "ids" if kind != whole else "ids_crc32"])

    return read


def encode_and_digest(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` as token files in ``folder`` and return what reading them back gives."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    manifest = cut(write_token_files(docs, folder, tokenizer), "token-manifest")
    return token_digests(manifest)
