"""Periodic runs of words, caught online over completed power-of-two blocks.

Words are appended to a tape. On level k every completed, aligned block of 2^k words is a
catcher: it watches the 2^k places of the block after it for its own return, which
shows a period q of at least 2^k and below 2^(k+1). Two thirds of any stretch of three
periods or more hold such a block, so none is missed. A return starts a suffix
comparison, backwards to where the period begins and forwards as words come; when
it spans two periods, a square is reported, and squares of one period that touch are
one run, found once. A run that reaches the tape's end stays open and goes on with the
next word.

The catchers of a level are advanced together: a tape's levels hold fingerprints of
the blocks that start at each word, and appended words are compared as whole
arrays, so a word costs a few operations a level whether it comes alone or in
thousands. Fingerprints only propose; the words themselves are compared.
Catchers inside a known run whose period divides theirs report nothing new and
rest, so constant texts cost no more than others.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frame, shipped, words_of

#: A run has so many words at least, and so many periods.
LEAST, PERIODS = 24, 3
#: Words that share a tape, more only for one text.
TAPE = 65_536
#: Odd factors of the fingerprints, one a level, by a multiplicative rule.
_FACTORS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1) ** 7) % (1 << 64) | 1 for k in range(64)], dtype=np.uint64)

#: Turns a document's id and words into the words to search.
Rewrite = Callable[[int | None, list[str]], list[str]]


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Line:
    """An array that grows at its end, with room to spare."""

    def __init__(self, kind):
        self._room, self.n = np.zeros(64, dtype=kind), 0

    def add(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self._room):
            self._room = np.concatenate([self._room[:self.n], np.zeros(max(need, 2 * self.n) - self.n, dtype=self._room.dtype)])
        self._room[self.n:need] = more
        self.n = need

    @property
    def held(self) -> np.ndarray:
        return self._room[:self.n]


class Tape:
    """Appended words, as whole numbers, and the runs caught in them.

    ``longest`` is the longest stretch that can hold a run (a text, if several share the
    tape with a number of their own between them); it bounds the levels. A negative number
    equals no other word if it is used once.
    """

    def __init__(self, longest: int | None = None, least: int = LEAST, periods: int = PERIODS):
        if periods < 3:
            raise ValueError("two periods alone need not hold a whole catcher")
        self._codes = _Line(np.int64)
        self.longest, self.least, self.periods = longest, least, periods
        self._prints: list[_Line] = []
        #: (period, start) -> end, of every stretch of two periods or more, and of those that still grow.
        self.caught: dict[tuple[int, int], int] = {}
        self._open: set[tuple[int, int]] = set()

    @property
    def codes(self) -> np.ndarray:
        return self._codes.held

    def append(self, codes: np.ndarray) -> None:
        """Advances every catcher by the appended words."""
        old = self._codes.n
        self._codes.add(np.asarray(codes, dtype=np.int64))
        n = self._codes.n
        for q, a in list(self._open):
            end = self.caught[q, a] = self._forward(q, self.caught[q, a])
            if end < n:
                self._open.discard((q, a))
                if end - a < 2 * q:
                    del self.caught[q, a]
        reach = n if self.longest is None else min(self.longest, n)
        level, width = 0, 1
        while width * self.periods <= reach:
            new = level == len(self._prints)
            if new:
                self._prints.append(_Line(np.uint64))
            self._fingerprint(level, width)
            self._catch(level, width, 0 if new else old)
            level, width = level + 1, width * 2

    def _fingerprint(self, level: int, width: int) -> None:
        """Prints of the blocks of ``width`` words at each place, as far as the words go."""
        line = self._prints[level]
        have, want = line.n, self._codes.n - width + 1
        if want <= have:
            return
        if level == 0:
            line.add(_stirred(self.codes[have:want].astype(np.uint64) * _FACTORS[0] + _FACTORS[1]))
        else:
            below, half = self._prints[level - 1].held, width // 2
            line.add(_stirred(below[have:want] * _FACTORS[level] + below[have + half:want + half]))

    def _catch(self, level: int, width: int, old: int) -> None:
        """Returns of the level's blocks that the words from ``old`` on complete."""
        prints = self._prints[level].held
        # A return that ends behind `old` starts behind old - width, in the block after its catcher.
        first = max(0, (old - width + 1) // width - 1)
        blocks = len(prints) // width
        rest = len(prints) - blocks * width
        starts, periods = [], []
        if blocks - first >= 2:
            rows = prints[first * width:blocks * width].reshape(-1, width)
            at, to = np.nonzero(rows[1:] == rows[:-1, :1])
            starts.append((at + first) * width)
            periods.append(to + width)
        if rest and blocks - 1 >= first and blocks >= 1:
            to = np.flatnonzero(prints[blocks * width:] == prints[(blocks - 1) * width])
            starts.append(np.full(len(to), (blocks - 1) * width))
            periods.append(to + width)
        if not starts:
            return
        start, period = np.concatenate(starts), np.concatenate(periods)
        fresh = start + period + width > old
        start, period = start[fresh], period[fresh]
        if len(start):
            awake = ~self._resting(start, period, width)
            start, period = start[awake], period[awake]
        order = np.lexsort((start, period))
        begun = ended = last = -1
        for s, q in zip(start[order].tolist(), period[order].tolist()):
            if q == last and begun <= s and s + q + width <= ended:
                continue
            if not np.array_equal(self.codes[s:s + width], self.codes[s + q:s + q + width]):
                continue  # fingerprints alone agreed
            a, b = self._backward(q, s), self._forward(q, s + q + width)
            last, begun, ended = q, a, b
            if (b - a >= 2 * q or b == len(self.codes)) and (q, a) not in self.caught:
                self.caught[q, a] = b
                if b == len(self.codes):
                    self._open.add((q, a))

    def _resting(self, start: np.ndarray, period: np.ndarray, width: int) -> np.ndarray:
        """Which catchers lie with their return in a known run whose period divides theirs."""
        spans = [(a, b, q) for (q, a), b in self.caught.items() if b - a >= max(2 * width, 2 * q)]
        if not spans:
            return np.zeros(len(start), dtype=bool)
        # Two long runs of small periods overlap in little, so the run with the last start before a catcher, or the one before that, holds it.
        spans.sort()
        a, b, q = (np.array(x) for x in zip(*spans))
        at = np.searchsorted(a, start, side="right") - 1
        out = np.zeros(len(start), dtype=bool)
        for back in (0, 1):
            i = at - back
            ok = i >= 0
            i = np.maximum(i, 0)
            out |= ok & (start + period + width <= b[i]) & (period % q[i] == 0)
        return out

    def _forward(self, q: int, at: int) -> int:
        """The end of the stretch with period ``q`` that holds the words before ``at``."""
        n, step = len(self.codes), 16
        while at < n:
            end = min(at + step, n)
            differ = self.codes[at:end] != self.codes[at - q:end - q]
            where = differ.argmax()
            if differ[where]:
                return at + int(where)
            at, step = end, step * 2
        return n

    def _backward(self, q: int, at: int) -> int:
        """The start of the stretch with period ``q`` that holds the words from ``at`` on."""
        step = 16
        while at > 0:
            low = max(0, at - step)
            differ = (self.codes[low:at] != self.codes[low + q:at + q])[::-1]
            where = differ.argmax()
            if differ[where]:
                return at - int(where)
            at, step = low, step * 2
        return 0

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start, then period; each with its smallest period."""
        out = [(a, b - a, q) for (q, a), b in self.caught.items()
               if b - a >= max(self.least, self.periods * q) and self._smallest(q, a, b)]
        return sorted(out, key=lambda r: (r[0], r[2]))

    def _smallest(self, q: int, a: int, b: int) -> bool:
        """Whether no shorter period has the stretch; one would divide ``q``."""
        rest, prime = q, 2
        while rest > 1:
            if prime * prime > rest:
                prime = rest
            if rest % prime == 0:
                p = q // prime
                if self._forward(p, a + p) >= b:
                    return False
                while rest % prime == 0:
                    rest //= prime
            prime += 1
        return True


def caught_in(texts: list[list[str]], least: int = LEAST, periods: int = PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; texts share tapes of some TAPE words, those of like length together."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i in range(len(texts)) if len(texts[i]) >= least), key=lambda i: len(texts[i]))
    while order:
        held, group = 0, []
        while order and (not group or held + len(texts[order[-1]]) <= TAPE):
            group.append(i := order.pop())
            held += len(texts[i]) + 1
        number: dict[str, int] = defaultdict(count().__next__)
        line, starts, at = [], [], 0
        for k, i in enumerate(group):
            line.append(np.fromiter(map(number.__getitem__, texts[i]), np.int64, len(texts[i])))
            line.append(np.array([-1 - k]))
            starts.append(at)
            at += len(texts[i]) + 1
        tape = Tape(len(texts[group[0]]), least, periods)
        tape.append(np.concatenate(line))
        for start, length, period in tape.runs():
            k = int(np.searchsorted(starts, start, side="right")) - 1
            out[group[k]].append((start - starts[k], length, period))
    return out


def kept_words(words: list[str], runs: Iterable[tuple[int, int, int]]) -> list[str]:
    """The words that no run repeats: of each run, only the first period stays."""
    drop = [(start + period, start + length) for start, length, period in runs]
    if not drop:
        return words
    keep = np.ones(len(words), dtype=bool)
    for a, b in drop:
        keep[a:b] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None,
           least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """key, ``runs`` and ``collapsed`` of every row: the runs of its words, and its words without their repeats.

    ``runs`` are structs (start, length, period) by start, then period; ``collapsed``
    joins the kept words by one space. Null and empty texts have no run and an empty
    ``collapsed``. Repeated rows each give a row, null keys are kept; columns beside
    the two are not read. ``rewrite`` changes a document's words before the search.
    A text is one row's work: whole, of any length, without a shuffle.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, cells = batch["k"].tolist(), batch["t"].tolist()
            low, total = 0, 0
            for high in range(len(names)):
                total += len(cells[high]) if cells[high] else 0
                if total < 8 * TAPE and high + 1 < len(names):
                    continue
                texts = [words_of(c) if c else [] for c in cells[low:high + 1]]
                if rewrite:
                    texts = [rewrite(None if pd.isna(k) else int(k), w) for k, w in zip(names[low:high + 1], texts)]
                rows = [(None if pd.isna(k) else k, [{"start": a, "length": b, "period": q} for a, b, q in runs],
                         " ".join(kept_words(w, runs)))
                        for k, w, runs in zip(names[low:high + 1], texts, caught_in(texts, least, periods))]
                yield frame(rows, [key, "runs", "collapsed"])
                low, total = high + 1, 0

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return shipped(narrow).mapInPandas(
        search, f"`{key}` {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The query's rule: a tenth of the documents repeats a stretch of its words to the end."""
    import zlib

    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a:a + p]
    return words[:a] + (stretch * (-(-(n - a) // p)))[:n - a]


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: number of runs, the one of most periods, and prints of runs and of kept words."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")

    def most(best: Column, r: Column) -> Column:
        # length / period by cross products; runs come by start, then period, so the first of equal ones stays.
        more = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(best.isNull() | more, r).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), most)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
