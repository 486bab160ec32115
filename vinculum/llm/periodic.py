"""Periodic runs of words by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
and length at least max(`least_words`, `least_times` * q) that no neighbouring word extends
keeping period q.

1. *Stretches.* The last words of a run repeat the `PROBE` words before them one period
   earlier, so only stretches whose word 5-grams have occurred before in the text can end a
   run.  Each such stretch, widened to the left by the longest period it allows, is searched;
   overlapping ones are one.  The rest of a text can't hold a run.
2. *Automaton.* The words of a stretch are appended to a suffix automaton, whose states by
   suffix links form a tree; the path from the state of a prefix to the root holds all its
   suffixes.
3. *Access.* Appending word i recolours this path with i.  The path is kept as link-cut trees
   keep it, cut into segments of one colour on heavy paths; each segment that is recoloured
   tells the previous end e of its suffixes and the longest of them, L words: a square of
   period d = i - e ends at i as soon as L >= d, and words i - L - d + 1 to i have period d.
   As e is the latest end, d is their smallest period.
4. *Runs.* Such a repetition that the next word doesn't extend is a run, found once, at its
   last word.

A text is searched within its row's task; the memory is in proportion to the longest text
(some hundred bytes a word of it), and the accesses recolour about log n segments a word.

Defined results: null and word-less texts have no run; rows that repeat a doc_id and rows
with a null doc_id are searched each for itself; ties of the greatest exponent go to the
smallest start, then the smallest period; very long texts and words are read whole; extra
columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum.llm.common import over_batches, slices, stage, worker
from vinculum.llm.tokens import texts_of

#: Words of the n-grams that mark stretches; a run of six words of period 1 holds two of them.
PROBE = 5
_FACTORS = np.random.Generator(np.random.PCG64(60493)).integers(0, 1 << 63, PROBE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: start, length, period
Run = tuple[int, int, int]


@dataclass(frozen=True)
class Params:
    """Runs of at least `least_words` words and `least_times` periods; stretches are found for
    six words and four periods or more."""

    least_words: int = 6
    least_times: int = 4

    def __post_init__(self) -> None:
        if self.least_words < 6 or self.least_times < 4:
            raise ValueError("runs shorter than six words or four periods aren't searched")


class Automaton:
    """Suffix automaton of a sequence of word numbers: lengths and suffix links of its states.

    Most states have one transition, which lies in two flat arrays; the rest in dictionaries.
    """

    def __init__(self, words: Sequence[int]) -> None:
        self.length, self.link = array("q", [0]), array("q", [-1])
        self.word, self.to = array("q", [-1]), array("q", [-1])
        self.more: dict[int, dict[int, int]] = {}
        self.prefix = array("q")  # state of each prefix
        last = 0
        for word in words:
            last = self._append(last, word)
            self.prefix.append(last)

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(-1)
        self.to.append(-1)
        return len(self.length) - 1

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        more = self.more.get(state)
        return more.get(word, -1) if more else -1

    def _lead(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _append(self, last: int, word: int) -> int:
        new = self._state(self.length[last] + 1, 0)
        p = last
        while p >= 0 and (q := self._next(p, word)) < 0:
            self._lead(p, word, new)
            p = self.link[p]
        if p < 0:
            return new
        if self.length[q] != self.length[p] + 1:
            split = self._state(self.length[p] + 1, self.link[q])
            self.word[split], self.to[split] = self.word[q], self.to[q]
            if q in self.more:
                self.more[split] = dict(self.more[q])
            self.link[q] = split
            while p >= 0 and self._next(p, word) == q:
                self._lead(p, word, split)
                p = self.link[p]
            q = split
        self.link[new] = q
        return new


class Accessed:
    """Last ends of the automaton's states, recoloured path by path.

    Every heavy path of the link tree holds its colours as a stack of (longest suffix of the
    segment, end), the segment next to the path's head on top.
    """

    def __init__(self, automaton: Automaton) -> None:
        self.length, self.link = automaton.length, automaton.link
        n = len(self.length)
        order = np.argsort(np.frombuffer(self.length, np.int64), kind="stable").tolist()
        weight, heavy = [1] * n, [-1] * n
        for v in reversed(order[1:]):  # longer states first: children before parents
            up = self.link[v]
            weight[up] += weight[v]
            if heavy[up] < 0 or weight[v] > weight[heavy[up]]:
                heavy[up] = v
        self.head = array("q", range(n))
        for v in order[1:]:
            if heavy[self.link[v]] == v:
                self.head[v] = self.head[self.link[v]]
        self.colours: dict[int, list[tuple[int, int]]] = {}

    def access(self, state: int, end: int) -> Iterator[tuple[int, int]]:
        """Colours the path from `state` to the root with `end`: the (previous end, longest
        suffix) of each segment that had a colour."""
        while state >= 0:
            head, length = self.head[state], self.length[state]
            segments = self.colours.setdefault(head, [])
            longest = -1
            while segments and segments[-1][0] <= length:
                longest, before = segments.pop()
                yield before, longest
            if segments and longest < length:  # the rest of this segment keeps its colour
                yield segments[-1][1], length
            segments.append((length, end))
            state = self.link[head]


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words that together hold every run, with the word before it."""
    n = len(words)
    if n < PROBE + 1:
        return []
    m = n - PROBE + 1
    gram = np.zeros(m, np.uint64)
    for i in range(PROBE):
        gram += (words[i : i + m].astype(np.uint64) + np.uint64(1)) * _FACTORS[i]
        gram ^= gram >> np.uint64(29)
    order = np.argsort(gram, kind="stable")
    again = np.zeros(m + 2, np.int8)
    again[order[1:][gram[order[1:]] == gram[order[:-1]]] + 1] = 1
    edges = np.diff(again)
    out: list[tuple[int, int]] = []
    for first, after in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
        # 5-grams first .. after - 1 occurred before; period <= (their count + 4) / 3.
        lo = max(0, first - (after - first + 4) // 3 - 2)
        hi = after - 1 + PROBE
        if out and lo <= out[-1][1]:
            out[-1] = (min(lo, out[-1][0]), hi)
            while len(out) > 1 and out[-1][0] <= out[-2][1]:
                out[-2:] = [(min(out[-2][0], out[-1][0]), out[-1][1])]
        else:
            out.append((lo, hi))
    return out


def runs_between(words: list[int], lo: int, hi: int, p: Params = Params()) -> Iterator[Run]:
    """The runs that end in words[lo:hi] and begin after lo, or at word 0."""
    n = len(words)
    automaton = Automaton(words[lo:hi])
    tree = Accessed(automaton)
    for i in range(lo, hi):
        found: dict[int, int] = {}
        for before, longest in tree.access(automaton.prefix[i - lo], i):
            d = i - before
            if longest + d >= p.least_words and longest >= (p.least_times - 1) * d and longest > found.get(d, 0):
                found[d] = longest
        for d, longest in found.items():
            if i + 1 == n or words[i + 1] != words[i + 1 - d]:
                yield i - longest - d + 1, longest + d, d


def runs(words: list[bytes], p: Params = Params()) -> list[Run]:
    """All runs of a text by start, then period."""
    if len(words) < p.least_words:
        return []
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return []
    numbers = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    found: list[Run] = []
    whole: list[int] = []
    for lo, hi in stretches(numbers):
        whole = whole or numbers.tolist()
        found += runs_between(whole, lo, hi, p)
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(found: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; ties to the first by start, then period."""
    best: Run | None = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]


def plant(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the periodic tail that a tenth of the ids call for."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


SCHEMA = "doc_id long, n_runs long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_DIGESTED = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


@worker("periodic")
def _found(batches: Iterator[pa.RecordBatch], p: Params, change: Callable | None, digests: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            ids = batch.column(0).slice(lo, hi - lo)
            counts, lists, texts, best = [], [], [], []
            for doc_id, text in zip(ids.to_pylist(), texts_of(batch.column(1).slice(lo, hi - lo))):
                words = text.split()  # of bytes: at space and 0x09-0x0D
                if change:
                    words = change(words, doc_id)
                found = runs(words, p)
                left = b" ".join(collapsed(words, found))
                counts.append(len(found))
                if digests:
                    best.append(strongest(found) or (None, None, None))
                    lists.append(hashlib.sha256("".join("%d,%d,%d\n" % run for run in found).encode()).hexdigest())
                    texts.append(hashlib.sha256(left).hexdigest())
                else:
                    lists.append([dict(zip(("start", "length", "period"), run)) for run in found])
                    texts.append(left)
            n = pa.array(counts, pa.int64())
            if digests:
                starts, lengths, periods = zip(*best)
                exponents = [length and 1000 * length // period for _, length, period in best]
                numbers = [pa.array(x, pa.int64()) for x in (starts, lengths, periods, exponents)]
                columns = [ids, n, *numbers, pa.array(lists, pa.string()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _DIGESTED.split(", ")])
            else:
                yield pa.RecordBatch.from_arrays([ids, n, pa.array(lists, _RUNS), pa.array(texts, pa.binary())], names=["doc_id", "n_runs", "runs", "collapsed"])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def periodic_runs(docs: DataFrame, params: Params = Params(), change: Callable | None = None) -> DataFrame:
    """doc_id, n_runs, runs (start, length, period of each) and collapsed (the UTF-8 text
    without repeats), one row per row of `docs` (doc_id, text).

    `change` (words, doc_id) -> words, a function of this package, alters the words first.
    """
    return over_batches(_rows(docs), partial(_found, p=params, change=change, digests=False), SCHEMA)


def run_digests(docs: DataFrame, params: Params = Params(), change: Callable | None = None) -> DataFrame:
    """The same as `periodic_runs`, with the strongest run and digests instead of lists and texts."""
    return stage(over_batches(_rows(docs), partial(_found, p=params, change=change, digests=True), _DIGESTED), "periodic-runs")
