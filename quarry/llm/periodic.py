"""Periodic runs of words, found on a grammar of the texts.

A **run** is a stretch of consecutive words with smallest period q (words q apart are equal) that no neighbouring word extends with
period q, of at least ``LEAST`` words and ``TIMES`` periods.

**Grammar.** The word ids of many documents at once are compressed by Re-Pair: the most frequent pair of neighbouring symbols becomes a new
nonterminal, again and again, until no pair occurs twice. As replacing a pair changes the counts of overlapping pairs only, each round
replaces all pairs at once that are more frequent than those which overlap them, wherever that is so (of equal symbols, every other pair). What is left of
a document is joined two by two, so that each document is one derivation tree of binary rules.

**Crossing runs.** A run lies inside the text of some lowest node of the tree and crosses the boundary between its two children. So for
each rule, once, however often it is used, the runs of its text that cross its boundary are sought. A run of period q, 2^k <= q < 2^(k+1),
holds, for one of nine places 2^k apart at or before the boundary, a block of 2^(k+1) words that occurs again q words later, and not
earlier: the next place of an equal block is the only candidate there. Equal blocks have equal names (names of blocks of 2^k words are made from two names of
half the length), and by names a candidate is extended to both sides as far as the rule's text reaches.

**Positions.** The runs of a rule are moved to all positions at which the document's tree derives it; intervals of one period that overlap
by a period or more are one run.

Scale: one pass without a shuffle, and a row per document; documents are worked on in chunks of ``CHUNK`` code points, a longer one by
itself, in memory proportional to its words (and to the logarithm of its longest repeated stretch).

Defined results: null and empty texts have no words and no run; repeated rows are handled each; a null id is carried along; an empty table gives
an empty result; further columns are ignored. Runs come by start, then period.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD

LEAST, TIMES = 6, 4
CHUNK = 1_000_000
RUNS = "array<struct<start:long,length:long,period:long>>"


def repair(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rules of the documents whose words lie between ``ends``: left, right (symbols; words are below 0, as ~word), the first place
    of each rule's text, and the root of each document (a rule, ~word, or the least int64 for no words)."""
    symbol = ~words.astype(np.int64)
    place = np.arange(len(words))
    document = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    # A pair that occurs once stays alone as long as its symbols do.
    alone = np.zeros(len(words), bool)
    lefts, rights, firsts, n_rules = [], [], [], 0
    while True:
        inside = np.diff(document) == 0
        if not inside.any():
            break
        left, right = symbol[:-1], symbol[1:]
        at = np.flatnonzero(inside & ~alone[:-1])
        low = int(symbol.min())
        codes = (left[at] - low) * (n_rules - low) + (right[at] - low)
        order = np.argsort(codes, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = np.diff(codes[order]) != 0
        number = np.cumsum(new) - 1
        often = np.bincount(number)[number]
        kind, weight = np.full(len(left), -1, np.int64), np.zeros(len(left), np.int64)
        kind[at[order]], weight[at[order]] = number, often
        alone[:-1][weight == 1] = True
        # Overlapping pairs of equal symbols: every other one, from the left.
        same = np.zeros(len(left), bool)
        same[1:] = (kind[1:] == kind[:-1]) & (kind[1:] >= 0) & inside[1:]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(left))))
        odd = (np.arange(len(left)) - head) % 2 == 1
        # Others give way to the more frequent pair, of equals to the one of lower number.
        key = weight * (len(left) + 1) - kind
        beaten = np.zeros(len(left), bool)
        beaten[1:] = (key[:-1] > key[1:]) & inside[:-1] & ~same[1:]
        beaten[:-1] |= (key[1:] > key[:-1]) & inside[1:] & ~same[1:]
        take = np.flatnonzero((weight > 1) & ~odd & ~beaten)
        if len(take):
            _, used, kinds = np.unique(kind[take], return_index=True, return_inverse=True)
            used = take[used]
        else:
            # No pair repeats: neighbours are joined two by two.
            head = np.searchsorted(document, document)
            take = np.flatnonzero(inside & ((np.arange(len(symbol)) - head)[:-1] % 2 == 0))
            kinds, used = np.arange(len(take)), take
        lefts.append(left[used])
        rights.append(right[used])
        firsts.append(place[used])
        symbol = symbol.copy()
        symbol[take] = n_rules + kinds
        n_rules += len(used)
        alone[take] = False
        alone[take[take > 0] - 1] = False
        stays = np.ones(len(symbol), bool)
        stays[take + 1] = False
        symbol, place, document, alone = symbol[stays], place[stays], document[stays], alone[stays]
    roots = np.full(len(ends) - 1, np.iinfo(np.int64).min)
    roots[document] = symbol
    empty = np.zeros(0, np.int64)
    return *(np.concatenate([empty, *x]) for x in (lefts, rights, firsts)), roots


class Names:
    """Names of the blocks of 2^k words inside documents that occur more than once; -1 for others."""

    def __init__(self, words: np.ndarray, ends: np.ndarray) -> None:
        self.n = len(words)
        room = np.repeat(ends[1:], np.diff(ends)) - np.arange(self.n)
        self.levels = [self._repeated(words.astype(np.int64), np.arange(self.n))]
        size = 1
        while True:
            low = self.levels[-1]
            at = np.flatnonzero((low >= 0) & (room >= 2 * size))
            at = at[low[at + size] >= 0]
            if not len(at):
                break
            name = self._repeated(low[at].astype(np.int64) * (self.n + 1) + low[at + size], at)
            if (name < 0).all():
                break
            self.levels.append(name)
            size *= 2

    def _repeated(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        name = np.full(self.n, -1, np.int32)
        if len(codes):
            order = np.argsort(codes, kind="stable")
            new = np.ones(len(codes), bool)
            new[1:] = np.diff(codes[order]) != 0
            group = np.cumsum(new) - 1
            often = np.bincount(group)[group] > 1
            name[at[order[often]]] = group[often]
        return name

    def following(self, k: int) -> np.ndarray:
        """The distance from each block of 2^k words to the next equal one, 0 for none."""
        name = self.levels[k]
        at = np.flatnonzero(name >= 0)
        order = at[np.argsort(name[at], kind="stable")]
        distance = np.zeros(self.n, np.int64)
        equal = name[order[1:]] == name[order[:-1]]
        distance[order[:-1][equal]] = (order[1:] - order[:-1])[equal]
        return distance

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from a and b on."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = np.minimum(a + total, self.n - 1), np.minimum(b + total, self.n - 1)
            name = self.levels[k]
            same = (name[x] >= 0) & (name[x] == name[y]) & (b + total < self.n)
            total[same] += 1 << k
        return total

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal before a and b."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - total - (1 << k), b - total - (1 << k)
            name = self.levels[k]
            same = (x >= 0) & (name[np.maximum(x, 0)] >= 0) & (name[np.maximum(x, 0)] == name[np.maximum(y, 0)])
            total[same] += 1 << k
        return total


def crossing(names: Names, low: np.ndarray, cut: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """rule, start, end, period of the runs of the texts [low, high) that cross ``cut``."""
    found = [np.zeros((4, 0), np.int64)]
    for k in range(len(names.levels) - 1):
        block, rules = 2 << k, np.flatnonzero(high - low >= max(LEAST, TIMES << k))
        distance = names.following(k + 1)
        for step in range(9):
            at = cut[rules] - step * (1 << k)
            fits = at >= low[rules]
            rule, at = rules[fits], at[fits]
            at = np.minimum(at, names.n - 1)
            period = distance[at]
            fits = (period >= 1 << k) & (period < block) & (at + period + block <= high[rule])
            rule, at, period = rule[fits], at[fits], period[fits]
            if not len(rule):
                continue
            start = np.maximum(at - names.backward(at, at + period), low[rule])
            end = np.minimum(at + period + names.forward(at, at + period), high[rule])
            fits = (start < cut[rule]) & (end > cut[rule]) & (end - start >= np.maximum(LEAST, TIMES * period))
            found.append(np.stack([rule, start, end, period])[:, fits])
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def runs(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end, period of all runs of the documents whose word ids lie between ``ends``, by start, then period."""
    nothing = np.zeros(0, np.int64)
    names = Names(words, ends)
    if len(names.levels) < 2:
        return nothing, nothing, nothing
    left, right, first, roots = repair(words, ends)
    length = np.ones(len(left) + 1, np.int64)

    def lengths_of(symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < 0, 1, length[np.maximum(symbols, 0)])

    # Rules of one round only use those of earlier rounds, so lengths settle in as many passes as trees are deep.
    pending = np.ones(len(left), bool)
    known = np.zeros(len(left) + 1, bool)
    while pending.any():
        at = np.flatnonzero(pending)
        ready = at[((left[at] < 0) | known[np.maximum(left[at], 0)]) & ((right[at] < 0) | known[np.maximum(right[at], 0)])]
        length[ready] = lengths_of(left[ready]) + lengths_of(right[ready])
        known[ready], pending[ready] = True, False
    rule, start, end, period = crossing(names, first, first + lengths_of(left), first + length[:-1])
    if not len(rule):
        return nothing, nothing, nothing

    # Rules that have runs, themselves or below, are followed down from the documents' roots.
    has = np.zeros(len(left) + 1, bool)
    has[rule] = True
    for _, rules in _by_depth(left, right):
        has[rules] |= ((left[rules] >= 0) & has[np.maximum(left[rules], 0)]) | ((right[rules] >= 0) & has[np.maximum(right[rules], 0)])
    begins = np.searchsorted(rule, np.arange(len(left) + 1))
    symbol, place = roots, ends[:-1].astype(np.int64)
    out = []
    while True:
        keep = symbol >= 0
        symbol, place = symbol[keep], place[keep]
        keep = has[symbol]
        symbol, place = symbol[keep], place[keep]
        if not len(symbol):
            break
        count = begins[symbol + 1] - begins[symbol]
        which = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begins[symbol], count)
        moved = np.repeat(place - first[symbol], count)
        out.append(np.stack([start[which] + moved, end[which] + moved, period[which]]))
        symbol, place = (
            np.concatenate([left[symbol], right[symbol]]),
            np.concatenate([place, place + lengths_of(left[symbol])]),
        )
    start, end, period = np.concatenate(out, axis=1)
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    # Of one period, what reaches a period into the one before belongs to it; offsets keep periods apart.
    apart = period * (int(ends[-1]) + 1)
    reach = np.maximum.accumulate(end + apart)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] + apart[1:] + period[1:] > reach[:-1]
    group = np.flatnonzero(new)
    stop = reach[np.append(group[1:], len(start)) - 1] - apart[group]
    start, period = start[group], period[group]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _by_depth(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rules in layers; a layer's rules are made of words and of rules of earlier layers."""
    known, pending, depth = np.zeros(len(left) + 1, bool), np.arange(len(left)), 0
    while len(pending):
        l, r = left[pending], right[pending]
        ready = ((l < 0) | known[np.maximum(l, 0)]) & ((r < 0) | known[np.maximum(r, 0)])
        yield depth, pending[ready]
        known[pending[ready]] = True
        pending, depth = pending[~ready], depth + 1


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    begin, total = 0, 0
    for n, size in enumerate(sizes):
        if n > begin and total + size > CHUNK:
            yield begin, n
            begin, total = n, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def as_they_are(doc_id: int | None, words: list[str]) -> list[str]:
    return words


def stutter(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of every tenth document (by checksum of its id), repeated from some word on with some period."""
    if doc_id is None or not words:
        return words
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10:
        return words
    g, n = checksum // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def find_runs(docs: DataFrame, change: Callable[[int | None, list[str]], list[str]] = as_they_are) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed (the words that are no repetition: a word goes if it
    lies in a run after its first period; joined by a blank). ``change`` makes the words that are looked at from those of the text."""
    pattern = re.compile(WORD)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _chunks([len(t) for t in texts]):
                yield _found(ids[a:b], [change(i, pattern.findall(t)) for i, t in zip(ids[a:b], texts[a:b], strict=True)])

    schema = f"doc_id long, n_words long, runs {RUNS}, collapsed string"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, schema)


def _found(ids: list[int | None], lists: list[list[str]]) -> pa.RecordBatch:
    every = [w for some in lists for w in some]
    number = {w: n for n, w in enumerate(dict.fromkeys(every))}
    words = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
    ends = np.cumsum([0, *map(len, lists)])
    start, stop, period = runs(words, ends)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, stop, -1)
    repeated = np.cumsum(depth)[:-1] > 0
    collapsed = []
    for some, a, b in zip(lists, ends, ends[1:], strict=False):
        gone = repeated[a:b]
        collapsed.append(" ".join([w for w, g in zip(some, gone.tolist(), strict=True) if not g] if gone.any() else some))
    owner = np.searchsorted(ends, start, side="right") - 1
    upto = np.searchsorted(owner, np.arange(len(lists) + 1)).astype(np.int32)
    fields = [start - ends[owner], stop - start, period]
    struct = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(np.diff(ends), pa.int64()),
            pa.ListArray.from_arrays(pa.array(upto), struct),
            pa.array(collapsed, pa.string()),
        ],
        ["doc_id", "n_words", "runs", "collapsed"],
    )
