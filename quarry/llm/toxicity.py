"""Toxicity by the nearest labelled examples.

**Terms** of a text are its words (lower-cased runs without blanks and ASCII marks) and their beginnings of 3 to 6 bytes, since
abuse is often a known stem with a new ending. The space has a dimension for every term that two examples
share and that the labels depend on at all (chi-square of ``SIGNIFICANT``, one in twenty by chance), however many these are.

**Examples.** At most ``PER_CLASS`` labelled documents per class, those with the least hash of their id, are the index; votes are
weighted by how many labelled documents each stands for. This bound keeps the index small enough to be sent to every worker;
the documents that are scored are not bounded in any way.

**Search.** Vectors are (1 + ln tf) x idf x how far the labels depend on the term, of length one; the last factor is
chi2 / (chi2 + ``HALF_CHI2``), so that words which are there by chance weigh little, and rare abuse still has a place. The inverted index
has, for each term, its postings in blocks of ``BLOCK`` examples, with the largest weight of each block that has any. The bound of a block is the sum of these maxima times the query's weights; the
blocks with the best bounds are scored first, then all whose bound reaches the k-th best cosine so far. The result is exactly
that of scoring every example.

**Score.** The nearest ``NEIGHBOURS`` vote with their cosines as weights. The share of toxic votes and the weight of the query's
strongest terms go through a logistic curve that is fitted on the examples, each by its neighbours without itself, so the score is a
probability. The neighbours come along as evidence. A text with no term of the space has the rate of such examples.

Scoring is one scan without a shuffle. Labels, language, source and ids are never inputs of a score.

Defined results: null text counts as empty; several labels of one id count as toxic if one is; null labels are ignored; without
labelled examples of both classes every score is the share of toxic labels (0 if there are none); ties in cosine go to
the least id; repeated rows get a row each; further columns are ignored by ``score`` and kept by ``reject``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored
from quarry.llm.shingles import STEP, Words, mixed

BEGINNINGS = (3, 4, 5, 6)
SALTS = np.array(BEGINNINGS, np.uint64) * STEP
PER_CLASS = 500
SIGNIFICANT = 3.84
HALF_CHI2 = 30.0
STRONGEST = 3
BLOCK = 64
NEIGHBOURS = 25
EVIDENCE = 3
LIMIT = 0.3
RIDGE = 0.1


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def terms(text: str | None, known: Words) -> np.ndarray:
    """One number for each word and each beginning of a word, repeated as often as it occurs."""
    data = (text or "").lower().encode("utf-8", "surrogatepass")
    whole, begin, end, running = known.parts(data)
    found = [whole]
    for n, salt in zip(BEGINNINGS, SALTS, strict=True):
        at = begin[end - begin > n]
        found.append(mixed((running[at + n] - running[at]) * known.inverses[at] + salt))
    return np.concatenate(found)


@dataclass
class Model:
    """The vector space, the block-max index of the examples, and the curve of the score."""

    base: float
    space: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Entries of term t: begins[t] to begins[t + 1]; an entry is a block, its postings (first, last) and their largest value.
    begins: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    last: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    highest: np.ndarray = field(default_factory=lambda: np.zeros(0))
    example: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    curve: np.ndarray = field(default_factory=lambda: np.zeros(3))
    sieve: np.ndarray = field(default_factory=lambda: np.zeros(1, bool))

    def set_space(self, space: np.ndarray, idf: np.ndarray) -> None:
        order = np.argsort(space)
        self.space, self.idf = space[order], idf[order]
        self.sieve = np.zeros(1 << 21, bool)
        self.sieve[(self.space & np.uint64(len(self.sieve) - 1)).astype(np.int64)] = True

    def vector(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Places in the space, weights of length one, and the length of the strongest before."""
        if not len(self.space):
            return np.zeros(0, np.int64), np.zeros(0), 0.0
        maybe = found[self.sieve[(found & np.uint64(len(self.sieve) - 1)).astype(np.int64)]]
        at = np.minimum(np.searchsorted(self.space, maybe), len(self.space) - 1)
        at, times = np.unique(at[self.space[at] == maybe], return_counts=True)
        weights = (1 + np.log(times)) * self.idf[at]
        length = float(np.sqrt((weights**2).sum()))
        return at, weights / max(length, 1e-300), float(np.sqrt((np.sort(weights)[-STRONGEST:] ** 2).sum()))

    def set_examples(self, ids, toxic, weight, vectors) -> None:
        """Examples with like first terms lie together, so that blocks differ in their maxima."""
        order = sorted(range(len(ids)), key=lambda i: (tuple(vectors[i][0][np.argsort(-vectors[i][1])][:2]), ids[i]))
        self.ids, self.toxic, self.weight = (np.array([x[i] for i in order]) for x in (ids, toxic, weight))
        term = np.concatenate([np.zeros(0, np.int64), *(vectors[i][0] for i in order)])
        value = np.concatenate([np.zeros(0), *(vectors[i][1] for i in order)])
        example = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by_term = np.lexsort((example, term))
        term, self.example, self.value = term[by_term], example[by_term], value[by_term]
        cell = term * (-(-len(order) // BLOCK)) + self.example // BLOCK
        self.first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.last = np.append(self.first[1:], len(cell))
        self.block = self.example[self.first] // BLOCK
        self.highest = np.maximum.reduceat(self.value, self.first) if len(self.first) else np.zeros(0)
        self.begins = np.searchsorted(term[self.first], np.arange(len(self.space) + 1))

    def entries(self, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of some terms, with the weight that the query gives the term."""
        count = self.begins[at + 1] - self.begins[at]
        ends = np.cumsum(count)
        places = np.arange(count.sum()) - np.repeat(ends - count - self.begins[at], count)
        return places, np.repeat(weights, count)

    def cosines(self, entries: np.ndarray, weights: np.ndarray, into: np.ndarray) -> None:
        """Add up the products of the postings of the given entries."""
        count = self.last[entries] - self.first[entries]
        ends = np.cumsum(count)
        if not len(ends):
            return
        places = np.arange(ends[-1]) - np.repeat(ends - count - self.first[entries], count)
        into += np.bincount(self.example[places], self.value[places] * np.repeat(weights, count), len(into))

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest positive cosine (ties: least id), exactly; ``without`` is left out."""
        entries, share = self.entries(at, weights)
        block = self.block[entries]
        bound = np.bincount(block, share * self.highest[entries], -(-len(self.ids) // BLOCK)) * (1 + 1e-9)
        order = np.argsort(-bound, kind="stable")
        order = order[: int((bound > 0).sum())]
        score, done, step = np.zeros(len(self.ids)), 0, 2
        while done < len(order):
            now = np.zeros(len(bound), bool)
            now[order[done : done + step]] = True
            mine = now[block]
            self.cosines(entries[mine], share[mine], score)
            done, step = done + step, len(order)
            seen = np.delete(score, without) if without >= 0 else score
            reached = np.partition(seen, -k)[-k] if len(seen) >= k else 0.0
            # Blocks are in order of their bounds: the first that cannot reach ends the search.
            order = order[: max(done, int((bound[order] >= reached).sum()))] if reached > 0 else order
        if without >= 0:
            score[without] = 0
        some = np.flatnonzero(score > 0)
        if len(some) > 4 * k:
            some = some[score[some] >= np.partition(score[some], -k)[-k]]
        best = some[np.lexsort((self.ids[some], -score[some]))][:k]
        return best, score[best]

    def features(self, at, weights, strongest: float, without: int = -1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        best, near = self.nearest(at, weights, NEIGHBOURS, without)
        votes = near * self.weight[best]
        share = ((votes * self.toxic[best]).sum() + 0.05 * self.base) / (votes.sum() + 0.05)
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.array([1.0, np.log(share / (1 - share)), np.log1p(strongest**2)]), best, near

    def fit_curve(self, rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression with a ridge, by Newton's steps, halved until they gain."""

        def gain(curve: np.ndarray) -> float:
            z = np.where(toxic > 0, 1, -1) * (rows @ curve)
            return float(-(weight * np.logaddexp(0, -z)).sum() - 0.5 * RIDGE * (curve @ curve))

        self.curve = np.zeros(rows.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-(rows @ self.curve)))
            slope = rows.T @ (weight * (toxic - p)) - RIDGE * self.curve
            bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + RIDGE * np.eye(rows.shape[1])
            step = np.linalg.solve(bend, slope)
            while np.abs(step).max() > 1e-9 and gain(self.curve + step) <= gain(self.curve):
                step /= 2
            if np.abs(step).max() <= 1e-9:
                break
            self.curve += step

    def score(self, text: str | None, known: Words) -> tuple[float, np.ndarray, np.ndarray]:
        """Probability, and the nearest examples with their cosines."""
        at, weights, strongest = self.vector(terms(text, known))
        if not len(at) or not len(self.ids):
            return self.base, np.zeros(0, np.int64), np.zeros(0)
        row, best, near = self.features(at, weights, strongest)
        p = 1 / (1 + np.exp(-(row @ self.curve)))
        return float(p), self.ids[best[:EVIDENCE]], near[:EVIDENCE]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each term of a batch, in how many texts of each class it is."""
    known = Words()
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            each = [np.unique(terms(t.as_py(), known)) for t in part.column("text")]
            toxic = np.repeat(np.array(part.column("toxic")), [len(x) for x in each])
            found, back = np.unique(np.concatenate(each), return_inverse=True)
            n, n1 = np.bincount(back), np.bincount(back, toxic).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(n1)], ["term", "n", "n1"]
            )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    everything = sum(totals.values())
    base = totals.get(1, 0) / everything if everything else 0.0
    if len(totals) < 2:
        return Model(base)
    parts = [
        known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)
    ]
    chosen = stored(parts[0].unionByName(parts[1]))  # 2 x per_class rows at most
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    examples = stored(texts.dropDuplicates(["doc_id"]).select("doc_id", "toxic", "text"))
    sizes = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(base)
    n1, n0 = float(sizes[1]), float(sizes[0])
    counted = (
        examples.mapInArrow(_term_counts, "term long, n long, n1 long")
        .groupBy("term")
        .agg(F.sum("n").cast("double").alias("n"), F.sum("n1").cast("double").alias("n1"))
    )
    a, b = F.col("n1"), F.col("n") - F.col("n1")
    chi2 = (n1 + n0) * F.pow(a * (n0 - b) - b * (n1 - a), 2) / (n1 * n0 * F.col("n") * F.greatest(n1 + n0 - F.col("n"), F.lit(0.5)))
    # No more terms than the texts of 2 x per_class examples have.
    space = counted.withColumn("chi2", F.coalesce(chi2, F.lit(0.0))).where((F.col("n") >= 2) & (F.col("chi2") >= SIGNIFICANT)).toArrow()
    model = Model(base)
    if not space.num_rows:
        return model
    found, toxic, chi2 = (space.column(c).to_numpy() for c in ("n", "n1", "chi2"))
    # Document frequency as it is among all labelled documents, whose classes the examples do not show in proportion.
    df = (base * toxic / n1 + (1 - base) * (found - toxic) / n0) * everything
    factor = chi2 / (chi2 + HALF_CHI2)
    model.set_space(space.column("term").to_numpy().view(np.uint64), (np.log((everything + 1) / (df + 1)) + 1) * factor)
    # 2 x per_class rows, each with its terms of the space only.
    rows = examples.mapInArrow(_vectors(model), "doc_id long, toxic int, at array<long>, weights array<double>, strongest double")
    rows = sorted(rows.collect(), key=lambda r: r["doc_id"])
    stands = {1: totals[1] / n1, 0: totals[0] / n0}
    none = [r for r in rows if not r["at"]]
    some = [r for r in rows if r["at"]]
    empty = sum(stands[r["toxic"]] for r in none), sum(stands[r["toxic"]] * r["toxic"] for r in none)
    model.base = (empty[1] + base) / (empty[0] + 1)
    if not some:
        return model
    vectors = [(np.array(r["at"], np.int64), np.array(r["weights"])) for r in some]
    model.set_examples(
        [r["doc_id"] for r in some], [float(r["toxic"]) for r in some], [stands[r["toxic"]] for r in some], vectors
    )
    place = {int(i): n for n, i in enumerate(model.ids)}
    features = [
        model.features(at, w, r["strongest"], place[r["doc_id"]])[0] for r, (at, w) in zip(some, vectors, strict=True)
    ]
    model.fit_curve(
        np.array(features), np.array([float(r["toxic"]) for r in some]), np.array([stands[r["toxic"]] for r in some])
    )
    return model


def _vectors(model: Model) -> callable:
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            found = [model.vector(terms(t.as_py(), known)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("toxic").cast(pa.int32()),
                    pa.array([x[0].tolist() for x in found], pa.list_(pa.int64())),
                    pa.array([x[1].tolist() for x in found], pa.list_(pa.float64())),
                    pa.array([x[2] for x in found], pa.float64()),
                ],
                ["doc_id", "toxic", "at", "weights", "strongest"],
            )

    return vectors


SCORES = "doc_id long, held_out boolean, score double, predicted int, evidence array<long>, cosines array<double>"


def score(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (nearest examples), cosines: one row per document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            found = [sent.value.score(t.as_py(), known) for t in batch.column("text")]
            scores = np.array([x[0] for x in found], np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores),
                    pa.array((scores >= limit).astype(np.int32)),
                    pa.array([x[1].tolist() for x in found], pa.list_(pa.int64())),
                    pa.array([x[2].tolist() for x in found], pa.list_(pa.float64())),
                ],
                ["doc_id", "held_out", "score", "predicted", "evidence", "cosines"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(scored, SCORES)


def reject(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that score below the limit, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            text = batch.column(batch.schema.names.index("text"))
            clean = [sent.value.score(t.as_py(), known)[0] < limit for t in text]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
