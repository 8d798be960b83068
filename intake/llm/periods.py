"""Periodic runs of words: stretches that repeat a period at least so many times.

A batch of texts is one string of word numbers, with a separator of its own after each text.
Longest common extensions (LCE) of two places are answered through a difference cover: of any
two places one finds, within fewer words than the cover's modulus, two places that are both
sampled. Only sampled suffixes are sorted; up to there words are compared, from there on a
sparse table of the sorted suffixes' common prefixes has the answer. The same on the
reversed string gives extensions to the left.

Runs are found on a harmonic grid: a run of period q and length L has L - q places whose word
equals the one q further, so one of every ``least length - q`` places, for each q, lies in
it and its extensions to both sides are the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intake.llm.common import words

# A perfect difference set, each residue but 0 is one difference of two of them.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)


@dataclass(frozen=True)
class Periods:
    """A run has its period at least ``exponent`` times and ``least`` words or more.

    ``words`` is how many words are searched at once, in whole texts: a longer text is
    searched alone. ``pairs`` is how many places of the grid are looked at at once.
    """

    least: int = 6
    exponent: int = 4
    words: int = 1 << 18
    pairs: int = 1 << 19

    def shortest(self, q: np.ndarray) -> np.ndarray:
        """Words that a run of period ``q`` has at least."""
        return np.maximum(self.least, self.exponent * q)


def _meeting() -> np.ndarray:
    """For residues a, b the least d for which a + d and b + d are both in the cover."""
    sampled = np.isin(np.arange(MODULUS), COVER)
    at = np.arange(MODULUS)
    table = np.full((MODULUS, MODULUS), -1, np.int64)
    for d in reversed(range(MODULUS)):
        both = sampled[(at + d) % MODULUS]
        table[np.ix_(both, both)] = d
    return table


_MEET = _meeting()
_SLOT = np.full(MODULUS, -1, np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """LCE queries on one array of word numbers (0 or more)."""

    def __init__(self, text: np.ndarray) -> None:
        n = len(text)
        # Numbers of their own behind the end: no extension reaches beyond it.
        self._text = np.concatenate([text, text.max(initial=0) + 1 + np.arange(2 * MODULUS)])
        width = len(COVER)
        rounds = -(-n // MODULUS) + 1
        places = (np.arange(rounds)[:, None] * MODULUS + np.array(COVER)).ravel()
        self._places = places[places < n]
        rank, levels = self._sorted(width)
        self._rank = rank
        order = np.empty_like(rank)
        order[rank] = np.arange(len(rank), dtype=rank.dtype)
        self._table = self._minima(self._common(order, levels, width))

    def _sorted(self, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Ranks of the sampled suffixes, and their ranks by the first 31, 62, 124 ... words.

        The first ones by sorting these words; then by doubling, and only where a rank is shared:
        the suffix MODULUS words further is sampled as well.
        """
        places, size = self._places, len(self._places)
        if not size:
            return np.zeros(0, np.int64), []
        base = np.int64(self._text.max() + 1)
        keys = [
            self._text[places + k] * base + (self._text[places + k + 1] if k + 1 < MODULUS else 0)
            for k in range(0, MODULUS, 2)
        ]
        order = np.lexsort(keys[::-1])
        new = np.ones(size, bool)
        new[1:] = False
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(size, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        levels, step = [rank], width
        while True:
            shared = np.flatnonzero(np.bincount(rank, minlength=size)[rank] > 1)
            if not len(shared):
                return rank, levels
            after = np.where(shared + step < size, rank[np.minimum(shared + step, size - 1)], -1)
            place = np.lexsort((after, rank[shared]))
            mine, group, after = shared[place], rank[shared[place]], after[place]
            first = np.ones(len(mine), bool)
            first[1:] = group[1:] != group[:-1]
            split = first.copy()
            split[1:] |= after[1:] != after[:-1]
            at = np.arange(len(mine))
            start = np.maximum.accumulate(np.where(first, at, 0))
            rank = rank.copy()
            rank[mine] = group + np.maximum.accumulate(np.where(split, at, 0)) - start
            levels.append(rank)
            step *= 2

    def _common(self, order: np.ndarray, levels: list[np.ndarray], width: int) -> np.ndarray:
        """Common words of each sorted suffix and the one before it; 0 for the first."""
        size = len(order)
        common = np.zeros(size, np.int64)
        if size < 2:
            return common
        a, b = order[:-1].copy(), order[1:].copy()
        for k in reversed(range(len(levels))):
            inside = (a < size) & (b < size)
            level = levels[k]
            same = np.flatnonzero(inside)
            same = same[level[a[same]] == level[b[same]]]
            common[1 + same] += MODULUS << k
            a[same] += width << k
            b[same] += width << k
        i = self._places[order[:-1]] + common[1:]
        j = self._places[order[1:]] + common[1:]
        common[1:] += self._compared(i, j, np.full(size - 1, MODULUS, np.int64))
        return common

    @staticmethod
    def _minima(common: np.ndarray) -> list[np.ndarray]:
        table, span = [common], 1
        while 2 * span <= len(common):
            last = table[-1]
            table.append(np.minimum(last[:-span], last[span:]))
            span *= 2
        return table

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, counted up to ``most``."""
        found = np.zeros(len(i), np.int64)
        live = np.flatnonzero(most > 0)
        end = len(self._text)
        while len(live):
            x, y = i[live] + found[live], j[live] + found[live]
            inside = np.maximum(x, y) < end
            live, x, y = live[inside], x[inside], y[inside]
            live = live[self._text[x] == self._text[y]]
            found[live] += 1
            live = live[found[live] < most[live]]
        return found

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from places ``i`` and ``j`` (i < j) on."""
        meet = _MEET[i % MODULUS, j % MODULUS]
        found = self._compared(i, j, meet)
        on = np.flatnonzero(found == meet)
        if not len(on):
            return found
        x, y = i[on] + meet[on], j[on] + meet[on]
        inside = y < len(self._text) - 2 * MODULUS
        on, x, y = on[inside], x[inside], y[inside]
        x = self._rank[x // MODULUS * len(COVER) + _SLOT[x % MODULUS]]
        y = self._rank[y // MODULUS * len(COVER) + _SLOT[y % MODULUS]]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        for k in np.unique(level):
            one = np.flatnonzero(level == k)
            row = self._table[k]
            found[on[one]] += np.minimum(row[low[one]], row[high[one] - (1 << int(k)) + 1])
        return found


def _grid(starts: np.ndarray, lengths: np.ndarray, how: Periods) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to look at, in parts of about ``how.pairs``: for every text and period."""
    most = lengths // how.exponent
    tops = np.maximum(np.where(lengths >= how.least, most, 0), 0)
    text = np.repeat(np.arange(len(starts)), tops)
    q = np.arange(len(text)) - np.repeat(np.cumsum(tops) - tops, tops) + 1
    step = how.shortest(q) - q
    # Places i of a text for which i + q is in it as well.
    n = (lengths[text] - q - 1) // step + 1
    ends = np.cumsum(n)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + how.pairs, "right")))
        part = np.repeat(np.arange(at, to), n[at:to])
        k = np.arange(len(part)) - np.repeat(np.cumsum(n[at:to]) - n[at:to], n[at:to])
        yield starts[text[part]] + k * step[part], q[part]
        at = to


def runs_of(texts: list[np.ndarray], how: Periods = Periods()) -> list[np.ndarray]:
    """(start, length, period) of all runs of each text of word numbers, by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    joined = np.empty(int(lengths.sum()) + len(texts) + 1, np.int64)
    joined[0] = top
    for k, (t, s) in enumerate(zip(texts, starts, strict=True)):
        joined[s : s + len(t)] = t
        joined[s + len(t)] = top + 1 + k
    n = len(joined)
    ahead = back = None
    found = []
    for i, q in _grid(starts, lengths, how):
        same = joined[i] == joined[i + q]
        i, q = i[same], q[same]
        if not len(i):
            continue
        if ahead is None:
            ahead, back = Extensions(joined), Extensions(joined[::-1])
        right = ahead.of(i, i + q)
        # The place before i is n - i in the reversed string.
        left = back.of(n - i - q, n - i)
        long = right + left + q >= how.shortest(q)
        found.append(np.stack([i[long] - left[long], (right + left + q)[long], q[long]], axis=1))
    if not found:
        return [np.zeros((0, 3), np.int64)] * len(texts)
    # Places of one run agree; a multiple of the smallest period gives the same stretch.
    rows = np.unique(np.concatenate(found), axis=0)
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], starts)
    cuts = [*cuts, len(rows)]
    return [rows[a:b] - [s, 0, 0] for a, b, s in zip(cuts, cuts[1:], starts, strict=False)]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: a run keeps its first period, unless another run drops a word of it."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, how: Periods = Periods()) -> DataFrame:
    """doc_id, ``runs`` (start, length, period; by start, then period) and ``collapsed`` of each row.

    ``collapsed`` is the text's words but for those that repeat a run's first period, joined by
    one space. Reads doc_id and text only. Null, empty and blank texts have no runs and an empty
    ``collapsed``; rows that repeat are searched each for itself; no documents, no rows. Texts are
    whole: one task holds at most one text beyond ``how.words`` words, and some 20 numbers a word.
    """

    def flush(texts: list[list[bytes]]) -> tuple[list, list]:
        numbers: dict[bytes, int] = {}
        counter = count()
        coded = [np.fromiter(map(numbers.setdefault, t, counter), np.int64, len(t)) for t in texts]
        runs, collapsed = [], []
        for t, r in zip(texts, runs_of(coded, how), strict=True):
            if len(r):
                t = [t[k] for k in np.flatnonzero(kept_words(len(t), r))]
            runs.append([{"start": int(s), "length": int(n), "period": int(q)} for s, n, q in r])
            collapsed.append(b" ".join(t))
        return runs, collapsed

    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, at, held, texts = part.column(0), 0, 0, []
            for text in part.column(1):
                # bytes.split knows the six blanks only.
                texts.append((text.as_py() or b"").split())
                held += len(texts[-1])
                if held >= how.words or at + len(texts) == part.num_rows:
                    runs, collapsed = flush(texts)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(at, len(texts)), pa.array(runs, kind), pa.array(collapsed, pa.binary())],
                        names=["doc_id", "runs", "collapsed"],
                    )
                    at, held, texts = at + len(texts), 0, []

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        batches, f"doc_id long, runs {RUNS}, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def stuttered(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the texts of one in ten documents repeat some of their words to the end.

    With h the CRC-32 of the decimal id and g = h // 10, texts with h % 10 = 0 repeat, from word
    a = g % n on, the words a to a + p - 1, where p = 1 + (n - a) // (3 + g % 8). Other
    texts, those without words or without an id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # The steps are columns of their own, so that a text is split once.
    cut = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    cut = cut.select("*", F.size("w").cast("long").alias("n"), F.expr("h div 10").alias("g"))
    cut = cut.select("*", F.expr("CASE WHEN n > 0 THEN g % n END").alias("a"))
    cut = cut.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    tail = "slice(flatten(array_repeat(slice(w, int(a + 1), int(p)), int((n - a + p - 1) div p))), 1, int(n - a))"
    again = F.array_join(F.expr(f"concat(slice(w, 1, int(a)), {tail})"), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))
