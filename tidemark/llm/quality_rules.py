"""Quality rules as a short-circuit cascade.

Each rule looks at one document and says whether to reject it. On a sample every
rule is timed and its rejections are counted; the cascade then runs the rules by
rejections per second, most first, where those count that the rules before left
over, and stops at the first that rejects. The
verdict is that of all rules together, so the order changes only the cost.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from operator import eq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, trimmed

SYMBOLS = "#*$%&|<>"


class Page:
    """One text; what several rules share is computed once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.words = self.text.encode("utf-8", "surrogatepass").split()
        self.n_words = len(self.words)
        self.word_chars = len(self.text) - sum(map(self.text.count, WHITE))
        self.n_symbols = sum(map(self.text.count, SYMBOLS))
        self.n_dup_lines, self.n_lines = self._lines()
        self.n_repeat_words = self._repeats()

    def _lines(self) -> tuple[int, int]:
        lines = self.text.split("\n")
        with_word = [x for x in lines if x.strip(WHITE)]
        return len(with_word) - len(set(with_word)), len(with_word)

    def _repeats(self) -> int:
        """Words that lie in a 3-word window found twice or more, the first included."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        counts, upto, covered = Counter(windows), 0, 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                covered += i + 3 - max(i, upto)
                upto = i + 3
        return covered


def base_failed(p: Page) -> bool:
    return p.n_words < 50 or 100 * p.n_repeat_words > 50 * p.n_words


#: name: does the rule reject. Every rule is a ratio, so it behaves alike at every length.
RULES: dict[str, Callable[[Page], bool]] = {
    "symbols": lambda p: 10 * p.n_symbols > p.n_words,
    "duplicate_lines": lambda p: 10 * p.n_dup_lines > 3 * p.n_lines,
    "word_length": lambda p: not 2 * p.n_words <= p.word_chars <= 12 * p.n_words,
    "exclamations": lambda p: 10 * p.text.count("!") > 3 * p.n_words,
    "few_letters": lambda p: 10 * sum(any(map(str.isalpha, w.decode("utf-8", "surrogatepass"))) for w in p.words) < 8 * p.n_words,
    "stutter": lambda p: 5 * sum(map(eq, p.words, p.words[1:])) > p.n_words,
}


@dataclass
class Cascade:
    """Rules in the order they run, with what the sample said of each."""

    order: list[str]
    seconds: dict[str, float] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)

    @classmethod
    def fit(cls, texts: list[str | None], rules: dict[str, Callable[[Page], bool]] = RULES) -> "Cascade":
        pages = [p for p in map(Page, texts) if not base_failed(p)]
        seconds, verdicts = {}, {}
        for name, rule in rules.items():
            began = time.perf_counter()
            verdicts[name] = [rule(p) for p in pages]
            seconds[name] = max(time.perf_counter() - began, 1e-9)
        order, rejected, open_ = [], {}, set(range(len(pages)))
        while len(order) < len(rules):
            # what a rule rejects counts among the documents that the rules before it let through
            new = {name: sum(verdicts[name][i] for i in open_) for name in rules if name not in order}
            first = min(new, key=lambda x: (-new[x] / seconds[x], seconds[x], x))
            order.append(first)
            rejected[first] = new[first]
            open_ = {i for i in open_ if not verdicts[first][i]}
        return cls(order, seconds, rejected)

    def rejects(self, page: Page, rules: dict[str, Callable[[Page], bool]] = RULES) -> str | None:
        """The first rule that rejects, after which none runs."""
        return next((name for name in self.order if rules[name](page)), None)


def sample_texts(docs: DataFrame, n: int) -> list[str | None]:
    """Texts of the ``n`` doc_ids with the smallest hashes; a repeated doc_id counts at most ``n`` times."""
    ids = [r[0] for r in docs.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(n).collect()]
    return [r[0] for r in docs.filter(F.col("doc_id").isin(ids)).select("text").limit(n).collect()] if ids else []


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"


def judge(docs: DataFrame, sample: int = 256) -> DataFrame:
    """One row for each document: doc_id, the figures, base_failed, kept, rejected_by.

    The sample only sets the order of the rules. Null and empty texts have no
    words and fail the base; null and repeated doc_ids are judged row by row, texts of
    any length whole; other columns are not read. An empty table gives no rows.
    """
    cascade = Cascade.fit(sample_texts(docs, sample))

    def run(batches):
        import pyarrow as pa

        names = ["doc_id", *(x.split()[0] for x in VERDICT.split(", "))]
        kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()]
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(lo, 1000), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    p = Page(text)
                    failed = base_failed(p)
                    by = "base" if failed else cascade.rejects(p)
                    rows.append((doc_id, p.n_words, p.word_chars, p.n_symbols, p.n_dup_lines, p.n_repeat_words, failed, by is None, by))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    # which of several rejecting rules is named depends on the order, so on the sample
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), f"doc_id long, {VERDICT}")
