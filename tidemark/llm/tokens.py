"""Byte-level BPE ids by the tokenizers library, with a cache of pieces.

Texts are cut where the vocabulary's pattern always ends a match, so the pieces can
be encoded alone. Cutting, telling the pieces of a batch apart and putting their ids
together is array work; the library encodes each piece that a worker has not seen.

The tokenizer is set up as the note beside its file says: the strings of special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
from array import array

import numpy as np

_ENCODERS: dict[str, "PieceEncoder"] = {}

#: Bytes of text whose pieces are told apart at once; one longer text is taken whole.
STEP_BYTES = 1 << 20


def _among(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_ALNUM = _among(bytes(c for c in range(128) if chr(c).isalnum()))
_PUNCT = _among(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_PRINTED = _ALNUM | _PUNCT
#: First bytes of the characters among which are blanks beyond ASCII.
_BLANK_LEAD = _among(bytes({chr(c).encode()[0] for c in range(128, 0x3001) if chr(c).isspace()}))
#: Last two bytes of those blanks.
_BLANK_END = {int.from_bytes(chr(c).encode()[-2:]) for c in range(128, 0x3001) if chr(c).isspace()}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces of the texts that begin at ``starts`` begin, as places in ``data`` (UTF-8).

    Cut is before blanks that follow another character, behind one newline between two
    others, and where letters and digits meet punctuation; behind an apostrophe never,
    since the pattern knows contractions.
    """
    n = len(data)
    at = np.zeros(n + 1, dtype=bool)
    at[starts] = True
    if n < 2:
        return np.flatnonzero(at[:n])
    blank = np.flatnonzero((data == 32) | (data == 10))
    blank = blank[blank > 0]
    before = data[blank - 1]
    solid = _PRINTED[before]
    high = np.flatnonzero(before >= 128)
    ends = (data[blank[high] - 2].astype(np.int32) << 8) | before[high]
    solid[high] = ~np.isin(ends, list(_BLANK_END))
    blank = blank[solid]
    at[blank] = True
    line = blank[(data[blank] == 10) & (blank + 1 < n)]
    after = data[line + 1]
    at[line[_PRINTED[after] | ((after >= 128) & ~_BLANK_LEAD[after])] + 1] = True
    punct = np.flatnonzero(_PUNCT[data])
    left = punct[punct > 1]
    word = data[left - 1]
    latin = (data[left - 2] == 0xC3) & (word >= 0x80) & (word != 0x97) & (word != 0xB7)  # letters from U+00C0 on
    at[left[_ALNUM[word] | latin]] = True
    right = punct[punct + 1 < n]
    at[right[_ALNUM[data[right + 1]] & (data[right] != 39)] + 1] = True
    return np.flatnonzero(at[:n])


def _byte_letters() -> dict[int, str]:
    """The characters by which a byte-level vocabulary names bytes: printed ones stand for themselves."""
    named = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(named)]
    return {b: chr(b) for b in named} | {b: chr(256 + i) for i, b in enumerate(others)}


class PieceEncoder:
    """Ids of whole columns of texts; at most about ``max_cached`` pieces stay known."""

    def __init__(self, path: str, max_cached: int = 200_000, end_id: int = 0):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        self._model, self._letters = self._tok.model, _byte_letters()
        self._max, self._end = max_cached, end_id
        self._forget()

    def _forget(self) -> None:
        self._codes: dict[bytes, int] = {}
        self._ids = array("I", [self._end])  # code 0 is the end of a document
        self._from = array("q", [0, 1])
        self._uses = array("I", [1])

    def _learn(self, pieces: list[bytes]) -> None:
        """Runs of plain letters are one word of the pattern and go straight to the model."""
        rows = []
        for piece in pieces:
            body = piece[1:] if piece[:1] == b" " else piece
            text = body.decode()
            if text.isalpha() and (text.isascii() or max(text) < "ƀ"):
                rows.append([t.id for t in self._model.tokenize(piece.decode("latin-1").translate(self._letters))])
            else:
                rows.append(self._tok.encode(piece.decode(), add_special_tokens=False).ids)
        self._add(pieces, rows)

    def _add(self, pieces, rows) -> None:
        codes, ids, begin, at = self._codes, self._ids, self._from, len(self._from) - 1
        for piece, row in zip(pieces, rows):
            codes[piece] = at
            ids.extend(row)
            begin.append(len(ids))
            at += 1
        self._uses.extend([0] * len(pieces))

    def _make_room(self) -> None:
        """Keep the pieces that several batches asked for, unless they are too many themselves."""
        codes, ids, begin = self._codes, self._ids, self._from
        again = [p for p, c in codes.items() if self._uses[c] > 1]
        again = again if 2 * len(again) < self._max else []
        rows = [ids[begin[codes[p]] : begin[codes[p] + 1]] for p in again]
        self._forget()
        self._add(again, rows)

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray, end: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's begin and, last, end).

        Text i is ``data[offsets[i]:offsets[i + 1]]``; with ``end`` each is closed by the end id.
        """
        import pyarrow as pa

        places = cut_points(data, offsets[:-1][offsets[:-1] < offsets[1:]])
        of_text = np.searchsorted(places, offsets)  # the pieces of each text
        bounds = np.append(places, len(data)).astype(np.int32)
        told = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        pieces = told.dictionary.to_pylist()
        if len(self._codes) > self._max:
            self._make_room()
        self._learn([p for p in pieces if p not in self._codes])
        codes = np.fromiter(map(self._codes.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        np.frombuffer(self._uses, dtype=np.uint32)[codes] += 1
        codes = codes[told.indices.to_numpy()] if len(pieces) else codes
        if end:
            codes = np.insert(codes, of_text[1:], 0)
            of_text = of_text + np.arange(len(of_text))
        begin = np.frombuffer(self._from, dtype=np.int64)
        lengths = begin[codes + 1] - begin[codes]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        where = np.repeat(begin[codes] - upto[:-1], lengths) + np.arange(upto[-1])
        return np.frombuffer(self._ids, dtype=np.uint32)[where], upto[of_text]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        raw = [(t or "").encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        ids, at = self.encode_bytes(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:])]


def encoder(path: str, end_id: int = 0) -> PieceEncoder:
    """One encoder for each worker process, vocabulary and end id."""
    key = f"{end_id} {path}"
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, end_id=end_id)
    return _ENCODERS[key]


def text_slices(column, most: int = STEP_BYTES):
    """(first row, bytes, offsets) of runs of rows of a string column with about ``most`` bytes at most; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def encoded_batches(batches, path: str, end_id: int = 0):
    """Of Arrow batches (doc_id, text): (doc_ids, ids with each document's end id, where each document begins and ends)."""
    enc = encoder(path, end_id)
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for lo, data, offsets in text_slices(batch.column(1)):
            ids, at = enc.encode_bytes(data, offsets, end=True)
            yield doc_ids[lo : lo + len(at) - 1], ids.astype("<u4", copy=False), at
