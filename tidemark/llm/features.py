"""Hashed byte n-grams and a few shape figures of texts, by numpy."""

from __future__ import annotations

import numpy as np

SHAPE = ("symbols", "upper", "digits", "bangs", "bars", "word_length", "distinct_words", "distinct_lines", "log_words", "line_words")


def trigram_counts(text: bytes, dims: int) -> np.ndarray:
    """Counts of the text's 3-byte windows, hashed into ``dims`` (a power of two)."""
    b = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(dims, dtype=np.int64)
    h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    return np.bincount(h & np.uint32(dims - 1), minlength=dims)


def shape(text: str) -> list[float]:
    """Figures of a text that don't depend on its language, in the order of SHAPE."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = raw.split(), raw.split(b"\n")
    n, chars = max(len(words), 1), max(len(raw), 1)
    b = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    letters = max(int(b[65:91].sum() + b[97:123].sum()), 1)
    return [
        sum(int(b[c]) for c in b"#*$%&|<>") / n,
        int(b[65:91].sum()) / letters,
        int(b[48:58].sum()) / chars,
        int(b[33]) / n,
        int(b[124]) / n,
        len(raw) / n,
        len(set(words)) / n,
        len(set(lines)) / max(len(lines), 1),
        float(np.log1p(len(words))),
        float(np.log1p(n / max(len(lines), 1))),
    ]
