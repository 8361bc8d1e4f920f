"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs without blanks and ASCII marks. A scan of the documents finds the three-word runs of the benchmark items
in them, the seeds. Wherever ``MIN_SEEDS`` different runs of one item lie together, the words around them are aligned with the item,
however many documents or items have these runs: a leak that is frequent stays a leak. A match scores 2, a mismatch or a gap -1, and the
best local score, divided by that of the item with itself, is the result. Edited and paraphrased copies keep most of it. Passages with
too few of the item's words for the least score (a bound that no alignment can pass) are not aligned.

The benchmark is read in blocks of at most ``BLOCK_RUNS`` runs, each sent to the workers as one table; any benchmark size works,
with a scan per block. Nothing but matches leaves the scan.

Defined results: null and empty texts have no match; an item without words matches nothing, one of fewer than three words is one run;
of several passages of a document that match an item, the best (then first) is returned; equal items are matched each;
repeated rows give a row each; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored, text_key
from quarry.llm.shingles import Words, shingle_hashes

RUN = 3
MIN_SEEDS = 2
#: Part of an item's own score that an alignment needs.
LEAST_SCORE = 0.4
BLOCK_RUNS = 200_000
MATCH, OTHER = 2, -1


class Items:
    """A block of benchmark items: their words, and an index from runs to items."""

    def __init__(self, ids: list[int], words: list[np.ndarray]) -> None:
        self.ids, self.words = ids, words
        runs = [np.unique(shingle_hashes(w, RUN)) for w in words]
        item = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        self.runs, back = np.unique(np.concatenate([np.zeros(0, np.uint64), *runs]), return_inverse=True)
        self.own = np.split(back, np.cumsum([len(r) for r in runs])[:-1])
        order = np.argsort(back, kind="stable")
        self.item = item[order]
        self.begin = np.searchsorted(back[order], np.arange(len(self.runs) + 1))
        self.need = np.array([MIN_SEEDS if len(w) >= 4 * RUN else 1 for w in words], np.int64)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.runs & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the text, and the run that each has."""
        runs = shingle_hashes(hashes, RUN)
        at = np.flatnonzero(self.sieve[(runs & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at) or not len(self.runs):
            return at[:0], at[:0]
        run = np.minimum(np.searchsorted(self.runs, runs[at]), len(self.runs) - 1)
        same = self.runs[run] == runs[at]
        return at[same], run[same]

    def passages(self, at: np.ndarray, run: np.ndarray, n_words: int) -> Iterator[tuple[int, int, int]]:
        """(item, first word, word after the last) wherever enough runs of an item lie together."""
        different = np.unique(run)
        # No more than the runs of the block, however often the text has them.
        items = np.concatenate([self.item[self.begin[r] : self.begin[r + 1]] for r in different])
        items, n_runs = np.unique(items, return_counts=True)
        for i in items[n_runs >= self.need[items]].tolist():
            mine = np.isin(run, self.own[i])
            yield from self._together(i, at[mine], run[mine], n_words)

    def _together(self, i: int, at: np.ndarray, run: np.ndarray, n_words: int) -> Iterator[tuple[int, int, int]]:
        size = len(self.words[i])
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > size) + 1):
            if len(np.unique(run[part])) < self.need[i]:
                continue
            low, high = max(0, int(at[part[0]]) - size), min(n_words, int(at[part[-1]]) + RUN + size)
            # A long stretch is cut into overlapping windows, each longer than any alignment that matters.
            for start in range(low, max(low + 1, high - 2 * size), 2 * size):
                yield i, start, min(high, start + 4 * size)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment: score, and the word of the passage after its last."""
    place = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, OTHER)
        row = np.maximum(row + OTHER, 0)
        row[1:] = np.maximum(row[1:], diagonal)
        # Gaps in the item: the best of all earlier cells less one per step.
        row = np.maximum.accumulate(row - OTHER * place) + OTHER * place
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items, in blocks of a bounded number of runs."""
    ids, words, known, runs = [], [], Words(), 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        found = known.hashes(row["text"])
        if not len(found):
            continue
        if ids and runs + len(found) > BLOCK_RUNS:
            yield Items(ids, words)
            ids, words, runs = [], [], 0
        ids.append(row["item_id"])
        words.append(found)
        runs += len(found)
    if ids:
        yield Items(ids, words)


def _scan(items) -> callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = Words(), items.value
        for batch in batches:
            rows = []
            for n, text in enumerate(batch.column("text")):
                hashes = known.hashes(text.as_py())
                at, run = block.hits(hashes)
                if not len(at):
                    continue
                best: dict[int, tuple] = {}
                for i, first, last in block.passages(at, run, len(hashes)):
                    own, words = block.words[i], hashes[first:last]
                    least = LEAST_SCORE * MATCH * len(own)
                    # Words that the passage does not have cannot match.
                    if MATCH * np.isin(own, words).sum() < least:
                        continue
                    points, end = align(own, words)
                    if points >= least:
                        # The same alignment from its end gives its start.
                        _, back = align(own[::-1], words[:end][::-1])
                        found = (points, -(first + end - back), first + end)
                        best[i] = max(best.get(i, (0, 0, 0)), found)
                for i, (points, start, end) in best.items():
                    rows.append((n, block.ids[i], points / (MATCH * len(block.words[i])), -start, end))
            n, *found = zip(*rows, strict=True) if rows else [()] * 5
            kept = batch.select(["doc_id", "key"]).take(pa.array(n, pa.int64()))
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(x, kind) for x, kind in zip(found, kinds, strict=True))],
                ["doc_id", "key", "item_id", "score", "start_word", "end_word"],
            )

    return scan


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key (of the text), item_id, score (0 to 1), start_word, end_word: passages that stem from an item."""
    spark = docs.sparkSession
    schema = "doc_id long, key binary, item_id long, score double, start_word long, end_word long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    result = None
    for block in _blocks(benchmark):
        scored = rows.mapInArrow(_scan(spark.sparkContext.broadcast(block)), schema)
        result = scored if result is None else result.unionByName(scored)
    return spark.createDataFrame([], schema) if result is None else result


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a match; rows with equal text share the verdict."""
    leaked = stored(matches(docs, benchmark).select(F.col("key").alias("__leaked")).distinct())
    marked = docs.withColumn("__key", text_key())
    return marked.join(leaked, marked["__key"] == leaked["__leaked"], "left_anti").drop("__key")
