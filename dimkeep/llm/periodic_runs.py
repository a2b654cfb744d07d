"""Periodic runs of words in whole texts, found on a Re-Pair grammar.

The words of a text become numbers. Re-Pair replaces the most frequent pair of
neighbours by a new symbol until no pair occurs twice; every place is settled by the
most frequent pair around it, so that pairs which do not touch are replaced in one
round. What is left is joined two by two, so the whole text is one binary derivation.

A run lies in the expansion of some lowest symbol and there crosses the border between
its two parts. So the runs that cross the border are computed once for each symbol, in
one place where it stands, and carried to every place of the derivation that the symbol
has. A run cut by the end of a symbol's expansion is part of one that a larger symbol
crosses; merging intervals of one period leaves the maximal ones.

Crossing runs: a run has at least four periods ``q``, so for ``l`` the power of two with
``l / 2 < q <= l`` one of the places ``border - j * l / 2`` (j to 4) has ``q + l`` words of
the run behind it, and there the next ``l`` words come again first after exactly ``q``
words. Equal stretches are found by hashes and then compared word by word.

Texts are searched where they lie; nothing is shuffled. A task holds the words of a few
texts at a time, at least of one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.llm.shared import free_name

#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words of several texts that are searched together.
_TOGETHER = 200_000
#: Comparisons made in one go.
_AT_ONCE = 1 << 21

_WORD = re.compile(r"[^\x20\x09-\x0D]+")

Run = tuple[int, int, int]  # start, length, period
Prepare = Callable[[object, list[str]], list[str]]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def _mixed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers in which every bit depends on every bit of the value."""
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Grammar:
    """Binary rules over symbols: words first, then one symbol for each rule, parts before wholes."""

    words: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # of the expansion
    start: np.ndarray  # one place where the symbol stands
    rounds: list[tuple[int, int]]  # rules of each round
    roots: np.ndarray  # a symbol for each text


def _chosen_pairs(sym: np.ndarray, alive: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places whose pair is replaced, its key's number, places whose pair may still repeat)."""
    at = np.flatnonzero(alive[:-1])
    one, two = sym[at], sym[at + 1]
    same = one == two
    later = at[:0]
    if same.any():  # of a row of equal symbols each second pair counts
        equal = np.append(sym[:-1] == sym[1:], False)
        begins = np.flatnonzero(equal & ~np.append(False, equal[:-1]))
        odd = same & ((at - begins[np.maximum(np.searchsorted(begins, at, "right") - 1, 0)]) % 2 == 1)
        later = at[odd]
        at, one, two = at[~odd], one[~odd], two[~odd]
    key = one * symbols + two
    bits = max(10, int(len(key)).bit_length() + 1)
    slot = (_mixed(key) >> np.uint64(64 - bits)).astype(np.int64)
    often = np.bincount(slot, minlength=1 << bits)[slot] > 1
    at, key = at[often], key[often]
    found, number, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[number] > 1
    at, number = at[again], number[again]
    rank = np.empty(len(found), np.int64)
    rank[np.lexsort((found, _mixed(found), count))] = np.arange(1, len(found) + 1)
    weight = np.zeros(len(sym) + 1, np.int64)
    weight[at] = rank[number]
    wins = (weight[at] > weight[at + 1]) & (weight[at] > np.where(at > 0, weight[at - 1], 0))
    wins &= np.bincount(number[wins], minlength=len(found))[number] > 1
    return at[wins], np.unique(number[wins], return_inverse=True)[1], np.concatenate((at, later))


def re_pair(ids: np.ndarray, begins: np.ndarray) -> Grammar:
    """The grammar of texts that lie one behind the other and share no number; none is empty."""
    words = int(ids.max()) + 1
    sym, start = ids.astype(np.int64), np.arange(len(ids))
    # an expansion's length by symbol; words first
    left, right, length, place, rounds = [], [], [np.ones(words, np.int64)], [], []
    symbols = words
    sizes = length[0]

    def add(first: np.ndarray, second: np.ndarray, where: np.ndarray) -> np.ndarray:
        nonlocal symbols, sizes
        new = np.arange(symbols, symbols + len(first))
        left.append(first)
        right.append(second)
        place.append(where)
        sizes = np.append(sizes, sizes[first] + sizes[second])
        rounds.append((symbols, symbols + len(first)))
        symbols += len(first)
        return new

    alive = np.ones(len(sym), bool)
    while True:
        at, rule, maybe = _chosen_pairs(sym, alive, symbols)
        if not len(at):
            break
        first = np.empty(rule.max() + 1, np.int64)
        first[rule[::-1]] = at[::-1]  # one place of each pair
        new = add(sym[first], sym[first + 1], start[first])
        alive = np.zeros(len(sym), bool)
        alive[maybe] = True
        sym[at] = new[rule]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        fresh = np.zeros(len(sym), bool)
        fresh[at] = True
        sym, start, alive, fresh = sym[keep], start[keep], alive[keep], fresh[keep]
        alive |= fresh
        alive[:-1] |= fresh[1:]

    while True:  # no pair repeats: join two by two within each text
        text = np.searchsorted(begins, start, "right") - 1
        order = np.arange(len(sym)) - np.searchsorted(text, text)
        heads = np.flatnonzero((order[:-1] % 2 == 0) & (text[1:] == text[:-1]))
        if not len(heads):
            break
        new = add(sym[heads], sym[heads + 1], start[heads])
        sym[heads] = new
        keep = np.ones(len(sym), bool)
        keep[heads + 1] = False
        sym, start = sym[keep], start[keep]
    cat = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return Grammar(words, cat(left), cat(right), sizes, cat(place), rounds, sym)


class _Stretches:
    """Hashes of stretches of the words, and how far a period reaches."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        self._power = np.cumprod(np.append(np.uint64(1), np.full(n, 0x9E3779B97F4A7C15, np.uint64)))
        self._sum = np.append(np.uint64(0), np.cumsum(_mixed(ids + 1) * self._power[:n]))
        # words until the same word comes again
        order = np.argsort(ids, kind="stable")
        self._gap = np.full(n, n + 1, np.int64)
        again = ids[order[1:]] == ids[order[:-1]]
        self._gap[order[:-1][again]] = (order[1:] - order[:-1])[again]

    def repeat_within(self, size: int) -> np.ndarray:
        """How many words before each place do not come again within ``size`` words."""
        return np.append(0, np.cumsum(self._gap > size))

    def equal(self, at: np.ndarray, size: int, by: np.ndarray) -> np.ndarray:
        one = (self._sum[at + size] - self._sum[at]) * self._power[by]
        return one == self._sum[at + by + size] - self._sum[at + by]

    def reach(self, at: int, period: int, lo: int, hi: int) -> tuple[int, int]:
        """The longest stretch around ``at`` inside [lo, hi) whose words ``period`` apart are the same."""
        ids = self.ids
        end, step = at, 64
        while end < hi - period:
            upto = min(end + step, hi - period)
            differ = np.flatnonzero(ids[end:upto] != ids[end + period : upto + period])
            if len(differ):
                end += int(differ[0])
                break
            end, step = upto, step * 4
        begin, step = at, 64
        while begin > lo:
            down = max(begin - step, lo)
            differ = np.flatnonzero(ids[down:begin] != ids[down + period : begin + period])
            if len(differ):
                begin = down + int(differ[-1]) + 1
                break
            begin, step = down, step * 4
        return begin, end + period


def _has_smaller_period(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether two periods from ``start`` also repeat a proper part of the period."""
    rest, divisor, parts = period, 2, []
    while rest > 1:
        if divisor * divisor > rest:
            divisor = rest
        if rest % divisor == 0:
            parts.append(period // divisor)
            while rest % divisor == 0:
                rest //= divisor
        divisor += 1
    end = start + 2 * period
    return any(np.array_equal(ids[start : end - p], ids[start + p : end]) for p in parts)


def _first_repeat(stretches: _Stretches, at: np.ndarray, end: np.ndarray, least: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number, period): where ``size`` words from ``at[number]`` come again first after ``least`` to ``size`` words."""
    ids = stretches.ids
    by = np.arange(least, size + 1)
    step = max(1, _AT_ONCE // len(by))
    for begin in range(0, len(at), step):
        a, e = at[begin : begin + step], end[begin : begin + step]
        there = a[:, None] + by[None, :]
        fits = there + size <= e[:, None]
        row, col = np.nonzero(fits & (ids[np.where(fits, there, 0)] == ids[a][:, None]))
        same = stretches.equal(a[row], size, by[col])
        row, col = row[same], col[same]
        row, first = np.unique(row, return_index=True)
        yield row + begin, by[col[first]]


def crossing_runs(ids: np.ndarray, grammar: Grammar) -> np.ndarray:
    """(rule, start, end, period) of the runs over the border of each rule, counted from its expansion's start."""
    stretches = _Stretches(ids)
    size = grammar.length[grammar.words :]
    begin = grammar.start
    border, end = begin + grammar.length[grammar.left], begin + size
    out = set()
    level = 1
    while True:
        least = level // 2 + 1
        rules = np.flatnonzero(size >= max(LEAST_WORDS, LEAST_PERIODS * least))
        if not len(rules):
            break
        back = np.array([1]) if level == 1 else np.arange(5) * (level // 2)
        at = (border[rules][:, None] - back[None, :]).ravel()
        rule = np.repeat(rules, len(back))
        able = (at >= begin[rule]) & (at + least + level <= end[rule])
        at, rule = at[able], rule[able]
        once = stretches.repeat_within(level)
        able = once[at + level] == once[at]
        at, rule = at[able], rule[able]
        for number, period in _first_repeat(stretches, at, end[rule], least, level):
            for r, a, q in {(int(rule[i]), int(at[i]), int(q)) for i, q in zip(number, period)}:
                lo, hi, middle = int(begin[r]), int(end[r]), int(border[r])
                s, e = stretches.reach(a, q, lo, hi)
                if e < a + q + level:  # the hashes were equal and the words are not
                    same = lambda p: np.array_equal(ids[a : a + level], ids[a + p : a + p + level])  # noqa: B023, E731
                    q = next((p for p in range(q + 1, min(level, hi - level - a) + 1) if same(p)), 0)
                    if not q:
                        continue
                    s, e = stretches.reach(a, q, lo, hi)
                if s < middle < e and e - s >= max(LEAST_WORDS, LEAST_PERIODS * q) and not _has_smaller_period(ids, s, q):
                    out.add((r, s - lo, e - lo, q))
        level *= 2
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def _everywhere(grammar: Grammar, runs: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """(period, start, end) of the rules' runs at all places of the derivation."""
    holds = np.zeros(len(grammar.length), bool)
    holds[runs[:, 0] + grammar.words] = True
    for lo, hi in grammar.rounds:
        rules = slice(lo - grammar.words, hi - grammar.words)
        holds[lo:hi] |= holds[grammar.left[rules]] | holds[grammar.right[rules]]
    sym, at = grammar.roots[holds[grammar.roots]], begins[holds[grammar.roots]]
    found = []
    while len(sym):
        rule = sym - grammar.words
        first, last = np.searchsorted(runs[:, 0], rule, "left"), np.searchsorted(runs[:, 0], rule, "right")
        many = last - first
        place = np.repeat(at, many)
        own = runs[np.repeat(first - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())]
        found.append(np.stack((own[:, 3], own[:, 1] + place, own[:, 2] + place), axis=1))
        left, right = grammar.left[rule], grammar.right[rule]
        at = np.concatenate((at, at + grammar.length[left]))
        sym = np.concatenate((left, right))
        more = holds[sym]
        sym, at = sym[more], at[more]
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)


def _merged(found: np.ndarray) -> list[Run]:
    """Maximal intervals (start, length, period): those of one period that share a period's length are one run."""
    out: list[list[int]] = []
    for q, s, e in found.tolist():  # by period, then start
        if out and out[-1][0] == q and s <= out[-1][2] - q:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([q, s, e])
    return sorted((s, e - s, q) for q, s, e in out)


def runs_of(texts: list[list[str]]) -> list[list[Run]]:
    """(start, length, period) of every run of each text, by start and then period."""
    out: list[list[Run]] = [[] for _ in texts]
    full = [i for i, words in enumerate(texts) if len(words) >= LEAST_WORDS]
    if not full:
        return out
    numbers, begins, total, known = [], [], 0, 0
    for i in full:
        place: dict[str, int] = {}
        numbers.append(np.array([place.setdefault(w, len(place)) for w in texts[i]], np.int64) + known)
        known += len(place)
        begins.append(total)
        total += len(texts[i])
    ids, starts = np.concatenate(numbers), np.array(begins)
    grammar = re_pair(ids, starts)
    crossing = crossing_runs(ids, grammar)
    if not len(crossing):
        return out
    found = _everywhere(grammar, crossing, starts)
    text = np.searchsorted(starts, found[:, 1], "right") - 1
    for t in np.unique(text).tolist():
        out[full[t]] = [(s - begins[t], n, q) for s, n, q in _merged(found[text == t])]
    return out


def collapse(words: list[str], runs: list[Run]) -> list[str]:
    """The words without those that a run repeats: of each run its first period stays, unless another run repeats it."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change[:-1]) > 0
    return [w for w, d in zip(words, dropped.tolist()) if not d]


def _together(batch: pa.RecordBatch, prepare: Prepare | None) -> Iterator[tuple[int, list[list[str]]]]:
    """Texts of a batch as words, a few at a time, with the place of the first."""
    texts, count, first = [], 0, 0
    for i, (key, text) in enumerate(zip(batch.column(0), batch.column(1))):
        words = words_of(text.as_py())
        texts.append(prepare(key.as_py(), words) if prepare else words)
        count += len(texts[-1])
        if count >= _TOGETHER:
            yield first, texts
            texts, count, first = [], 0, i + 1
    if texts:
        yield first, texts


def periodic_runs(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    out: str = "periodic",
    prepare: Prepare | None = None,
) -> DataFrame:
    """``doc_id`` and a struct ``out`` for each row: ``n_words``, ``runs`` (start, length, period) and ``collapsed``.

    Words are what blanks, tabs and line ends divide. A run is a stretch of words of
    smallest period ``q``, at least 6 and ``4 * q`` words long, that no neighbour extends.
    ``collapsed`` are the words, joined by one space, without those that any run contains
    after its first period. ``prepare`` may change the words of a text, given its id.

    Every row is its own text, whatever its id: repeated rows have equal results, and a
    null id goes through. A null or empty text has no words, no runs and an empty
    ``collapsed``. A text may be as long as a row can be; its words are searched at
    once. Other columns are not looked at. An empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for first, texts in _together(batch, prepare):
                found = runs_of(texts)
                said = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
                kept = [" ".join(collapse(w, r)) for w, r in zip(texts, found)]
                columns = [batch.column(0).slice(first, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array(said, run_type), pa.array(kept, pa.string())]
                yield pa.record_batch(columns, names=["key", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    searched = rows.mapInArrow(run, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    name = free_name(docs.select(doc_id), out)
    return searched.select(F.col("key").alias(doc_id), F.struct("n_words", "runs", "collapsed").alias(name))


def strongest(runs: str) -> F.Column:
    """The run of the greatest length in periods, compared exactly; equal ones by start, then period. Null without a run."""
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.aggregate(runs, F.try_element_at(F.col(runs), F.lit(1)), lambda a, b: F.when(more(a, b), b).otherwise(a))
