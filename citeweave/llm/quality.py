"""Quality rules as a short-circuit cascade.

A rule rejects rows of a slice of texts. Each rule's cost and selectivity are estimated on a
sample; rules run in order of rejections per second, and a later rule sees only what the
earlier ones left. Since a document is kept only if no rule rejects it, the order decides the time,
never the verdict; the rule a rejected row names is the first of the list given, whatever the order.

What one rule has worked out is handed on to the next one for the rows that are left.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import NOT_SPACE, Texts, Words, hash_ranges, mix, slices, windows, word_ranges

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 64  # of each partition

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_ROW = np.uint64(0xD6E8FEB86659FD93)


def _within(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one row."""
    return mix(hashes + (row.astype(np.uint64) + np.uint64(1)) * _ROW)


class Features:
    """What rules look at, worked out once per slice and only if asked for."""

    def __init__(self, texts: Texts | None):
        self._texts, self._ranges, self._from = texts, None, None

    def __len__(self):
        return len(self._texts) if self._texts is not None else int(self._from[1].sum())

    def split(self) -> Features:
        """The same texts with their words found and nothing else worked out."""
        made = Features(self.texts)
        made._ranges = self.ranges
        return made

    def take(self, keep: np.ndarray) -> Features:
        """The same for some rows. Texts are cut when they are next looked at, what is worked out already is cut at once."""
        taken = Features(None)
        taken._from = self, keep
        for name in ("n_words", "word_chars", "n_symbols", "n_repeat_words"):
            if name in self.__dict__:
                taken.__dict__[name] = self.__dict__[name][keep]
        for name in ("letters", "lines"):
            if name in self.__dict__:
                taken.__dict__[name] = tuple(x[keep] for x in self.__dict__[name])
        return taken

    def _origin(self) -> tuple[Features, np.ndarray]:
        """The features that hold texts, and which of their rows are these."""
        of, keep = self._from
        if of._texts is None:
            root, rows = of._origin()
            keep_all = np.zeros(len(rows), bool)
            keep_all[np.flatnonzero(rows)[keep]] = True
            return root, keep_all
        return of, keep

    @property
    def texts(self) -> Texts:
        if self._texts is None:
            root, keep = self._origin()
            sizes = np.diff(root._texts.bounds)
            bounds = np.concatenate([[0], np.cumsum(sizes[keep])])
            texts = Texts(root._texts.data[np.repeat(keep, sizes)], bounds)
            if root._ranges is not None:
                start, end, words = root._ranges
                counts = np.diff(words)
                held = np.repeat(keep, counts)
                moved = np.repeat(root._texts.bounds[:-1][keep] - bounds[:-1], counts[keep])
                self._ranges = start[held] - moved, end[held] - moved, np.concatenate([[0], np.cumsum(counts[keep])])
            self._texts = texts
        return self._texts

    def _count(self, flags: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(flags), self.texts.bounds))

    @property
    def ranges(self):
        """Where words begin and end, and the words of each row."""
        texts = self.texts  # may bring them along
        if self._ranges is None:
            self._ranges = word_ranges(texts, NOT_SPACE)
        return self._ranges

    @cached_property
    def words(self) -> Words:
        start, end, bounds = self.ranges
        return Words(start, end, hash_ranges(self.texts.data, start, end, lower=False), bounds)

    @cached_property
    def n_words(self):
        return np.diff(self.ranges[2])

    @cached_property
    def word_chars(self):
        data = self.texts.data
        return self._count(NOT_SPACE[data] & ((data & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self):
        return self._count(_SYMBOL[self.texts.data])

    @cached_property
    def letters(self):
        """ASCII capitals and small letters."""
        data = self.texts.data
        return self._count((data >= 0x41) & (data <= 0x5A)), self._count((data >= 0x61) & (data <= 0x7A))

    @cached_property
    def lines(self):
        """Lines with a word, and those equal to an earlier line of their text."""
        data, bounds = self.texts.data, self.texts.bounds
        breaks = np.flatnonzero(data == 0x0A)
        start = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
        end = np.sort(np.concatenate([bounds[1:], breaks]))
        first = np.searchsorted(self.ranges[0], start)
        held = np.searchsorted(self.ranges[0], end) > first
        start, end = start[held], end[held]
        row = np.searchsorted(bounds, start, "right") - 1
        n = np.bincount(row, minlength=len(self))
        _, index = np.unique(_within(hash_ranges(data, start, end, lower=False), row), return_index=True)
        return n, n - np.bincount(row[index], minlength=len(self))

    @cached_property
    def n_repeat_words(self):
        """Words in runs of five that occur at least twice in their text."""
        words, n = self.words, len(self.words.hash)
        runs, bounds = windows(words, 5)
        if not len(runs):
            return np.zeros(len(self), np.int64)
        counts = np.diff(bounds)
        row = np.repeat(np.arange(len(self)), counts)
        _, back, times = np.unique(_within(runs, row), return_inverse=True, return_counts=True)
        first = np.repeat(words.bounds[:-1] - bounds[:-1], counts) + np.arange(len(runs))
        seen = np.zeros(n + 5, np.int64)
        seen[first[times[back] > 1] + 5] = 1
        seen = np.cumsum(seen)
        # seen[i + 5] counts repeated runs that begin at word i or before.
        covered = seen[5:] > seen[:-5]
        return np.diff(np.searchsorted(np.flatnonzero(covered), words.bounds))


@dataclass(frozen=True)
class Rule:
    """`rejects(features)` gives a flag per row."""

    name: str
    rejects: Callable[[Features], np.ndarray]


def _few_words(f: Features):
    return f.n_words < 10


def _word_length(f: Features):
    return (f.word_chars < 2 * f.n_words) | (f.word_chars > 15 * f.n_words)


def _symbols(f: Features):
    return 10 * f.n_symbols > f.n_words


def _capitals(f: Features):
    large, small = f.letters
    return large > small


def _repeated_lines(f: Features):
    lines, again = f.lines
    return (again >= 6) & (10 * again > 3 * lines)


def _repeated_words(f: Features):
    return 100 * f.n_repeat_words > 20 * f.n_words


RULES = (
    Rule("few_words", _few_words),
    Rule("word_length", _word_length),
    Rule("symbols", _symbols),
    Rule("capitals", _capitals),
    Rule("repeated_lines", _repeated_lines),
    Rule("repeated_words", _repeated_words),
)


def measure(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Each rule's seconds and rejections on at most `sample_rows` rows of each partition, a row per rule.

    A partition's rows are spread over its first batch; no more of it is read. What rules share, the words, is
    found before and charged to none. A few figures come to the driver.
    """
    rules = list(rules)

    def run(batches: Iterator[pa.RecordBatch]):
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        rows = np.unique(np.linspace(0, batch.num_rows - 1, min(sample_rows, batch.num_rows)).astype(np.int64))
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for _, texts in slices([batch.take(pa.array(rows))], text):
            features = Features(texts)
            for i, rule in enumerate(rules):
                alone = features.split()
                begun = time.perf_counter()
                rejected[i] += int(rule.rejects(alone).sum())
                seconds[i] += time.perf_counter() - begun
        yield pa.RecordBatch.from_pydict(
            {"rule": [r.name for r in rules], "seconds": seconds, "rejected": rejected, "rows": [len(rows)] * len(rules)}
        )

    figures = docs.select(text).mapInArrow(run, "rule string, seconds double, rejected long, rows long")
    summed = figures.groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("seconds", "rejected", "rows")))
    found = {f.rule: f.asDict() for f in summed.collect()}
    return [found[r.name] for r in rules if r.name in found]


def order_rules(rules: Sequence[Rule], figures: list[dict]) -> list[Rule]:
    """Most rejections per second first; without a sample, the order given."""
    gain = {f["rule"]: (f["rejected"], f["seconds"]) for f in figures}
    return sorted(rules, key=lambda r: -(gain[r.name][0] / max(gain[r.name][1], 1e-9)) if r.name in gain else 0.0)


def judge(features: Features, rules: Sequence[Rule]) -> np.ndarray:
    """Per row, the position of the rule that rejected it, or -1."""
    verdict = np.full(len(features), -1)
    left = np.arange(len(features))
    for position, rule in enumerate(rules):
        if not len(left):
            break
        bad = rule.rejects(features)
        verdict[left[bad]] = position
        if bad.any():
            left, features = left[~bad], features.take(~bad)
    return verdict


def name_rules(features: Features, verdict: np.ndarray, ordered: Sequence[Rule], rules: Sequence[Rule]) -> np.ndarray:
    """Per row, the position in `rules` of the first of them that rejects it, or -1; `verdict` is what `judge` gave.

    Rejected rows alone are looked at, and by those rules only that come before the one that is known.
    """
    place = {rule.name: i for i, rule in enumerate(rules)}
    out = np.full(len(features), -1)
    left = np.flatnonzero(verdict >= 0)
    known = np.array([place[r.name] for r in ordered], np.int64)[verdict[left]]
    features = features.take(verdict >= 0)
    for position, rule in enumerate(rules):
        if not len(left):
            break
        here = known == position
        if (known > position).any():
            here |= rule.rejects(features)
        out[left[here]] = position
        if here.any():
            left, known, features = left[~here], known[~here], features.take(~here)
    return out


def quality_cascade(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    profile: bool = False,
) -> DataFrame:
    """`docs` with `rejected_by`: the name of the rule that rejected the row, NULL if none did.

    A NULL or empty text has no words. Repeated rows are judged alike, an empty table gives an empty
    one, and a column already named like an added one is replaced. `profile` adds n_words,
    word_chars, n_symbols, n_dup_lines and n_repeat_words of every row. A row that several
    rules reject names the first of them in `rules`, so the measured order does not show. A very long
    text is judged whole, by itself.
    """
    rules = list(rules)
    ordered = order_rules(rules, measure(docs, rules, text, sample_rows))
    added = {"rejected_by": T.StringType()}
    if profile:
        added |= dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), T.LongType())
    docs = docs.select([c for c in docs.columns if c not in added])
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in added.items())])
    names = pa.array([r.name for r in rules], pa.string())

    def run(batches: Iterator[pa.RecordBatch]):
        for batch, texts in slices(batches, text):
            f = Features(texts)
            # Figures of every row come first if they are wanted: the rules then look at those.
            figures = (f.n_words, f.word_chars, f.n_symbols, f.lines[1], f.n_repeat_words) if profile else ()
            verdict = name_rules(f, judge(f, ordered), ordered, rules)
            columns = [*batch.columns, names.take(pa.array(verdict, mask=verdict < 0)), *(pa.array(v, pa.int64()) for v in figures)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    return docs.mapInArrow(run, schema)
