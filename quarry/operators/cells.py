"""Exact dense search that reads part of the vectors: cells with a centre and a radius, passed by where a bound shows it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.ranking import MAX_SENT_QUERIES, TIE_DIGITS, blocks, ranked, scan_for_best
from quarry.operators.vector import METRICS, matrix_of, scores_of

# Vectors that centres are sought on (they only set how much is passed by, never what is found), and rounds of it.
SAMPLE, ROUNDS = 20_000, 8
# Centres go to every task: 4,096 of 1,024 numbers are 32 MB.
MAX_CELLS = 4_096
# Vectors without a direction stand by themselves, in a cell that is always read.
NO_DIRECTION = -1


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1, and which rows have a length."""
    lengths = np.sqrt((rows**2).sum(axis=1))
    return np.divide(rows, lengths[:, None], out=np.zeros_like(rows), where=lengths[:, None] > 0), lengths > 0


def _shaped(rows: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows as the metric sees them, and which of them have a place."""
    return _units(rows) if metric == "cosine" else (rows, np.ones(len(rows), bool))


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T, axis=1)


def _centres(rows: np.ndarray, n: int) -> np.ndarray:
    """Means of the sample's vectors that are nearest to each other."""
    centres = rows[np.random.default_rng(0).permutation(len(rows))[:n]]
    for _ in range(ROUNDS):
        cell = _nearest(rows, centres)
        count = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, rows)
        centres = np.divide(sums, count[:, None], out=centres.copy(), where=count[:, None] > 0)
    return centres


@dataclass(frozen=True)
class Cells:
    """What is known of each cell without reading it."""

    numbers: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


class CellTable:
    """Vectors (id, embedding, and any further columns) stored by cell, for one metric.

    A query first reads the cells that promise most, as many as hold ``k`` vectors; the k-th best score of these
    is a bar, and of the other cells only those are read whose best possible score reaches it.  By the triangle inequality
    that is, for a query q and a cell with centre c and radius r, ``|q - c| - r`` for the distance and ``q·c + |q| r`` for the
    product (cosine: the product of vectors of length 1).  So the answer is that of a scan of all vectors.
    """

    def __init__(self, spark: SparkSession, path: str, metric: str = "cosine"):
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}: use one of {METRICS}")
        self.spark, self.path, self.metric = spark, path.rstrip("/"), metric

    # -- making -------------------------------------------------------------------

    def build(self, vectors: DataFrame, n_cells: int) -> None:
        """Write the vectors by cell; centres are sought on a sample of at most ``SAMPLE`` vectors."""
        n_cells = min(n_cells, MAX_CELLS)
        by_hash = vectors.select("embedding").orderBy(F.xxhash64("id")).limit(SAMPLE).toArrow()
        sample, there = _shaped(matrix_of(by_hash.column("embedding")), self.metric)
        centres = _centres(sample[there], n_cells) if there.any() else np.zeros((1, sample.shape[1]))
        shared, metric = self.spark.sparkContext.broadcast(centres), self.metric

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, there = _shaped(matrix_of(batch.column("embedding"), shared.value.shape[1]), metric)
                cell = _nearest(rows, shared.value)
                away = np.sqrt(((rows - shared.value[cell]) ** 2).sum(axis=1))
                cell[~there] = NO_DIRECTION
                yield batch.append_column("cell", pa.array(cell, pa.int32())).append_column("away", pa.array(away))

        schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])
        placed = vectors.mapInArrow(place, schema)
        # A large cell is written by several tasks.
        spread = placed.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(16)))
        spread.write.partitionBy("cell").parquet(f"{self.path}/vectors")
        told = self.spark.read.parquet(f"{self.path}/vectors").groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("size"))
        middle = self.spark.createDataFrame(pd.DataFrame({"cell": range(len(centres)), "centre": centres.tolist()}), "cell int, centre array<double>")
        told.join(middle, "cell", "left").coalesce(1).write.parquet(f"{self.path}/cells")

    # -- searching ----------------------------------------------------------------

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors").drop("away")

    def cells(self) -> Cells:
        """One row per cell, at most ``MAX_CELLS`` and one more."""
        rows = self.spark.read.parquet(f"{self.path}/cells").filter(f"cell <> {NO_DIRECTION}").orderBy("cell").toArrow()
        return Cells(
            rows.column("cell").to_numpy(), matrix_of(rows.column("centre")),
            rows.column("radius").to_numpy(), rows.column("size").to_numpy(),
        )

    def search(self, queries: DataFrame, k: int = 5, condition: Column | None = None) -> DataFrame:
        """(query_id, rank, id, score): the ``k`` best vectors per query among those that meet ``condition``."""
        vectors = self.read() if condition is None else self.read().filter(condition)
        query_type, id_type = queries.schema["query_id"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString()
        hits, cells = self.spark.createDataFrame([], f"query_id {query_type}, id {id_type}, score double"), self.cells()
        for sent in blocks(queries.select("query_id", "embedding"), MAX_SENT_QUERIES, MAX_SENT_QUERIES):
            if sent.num_rows:
                hits = hits.unionByName(self._search_block(vectors, sent, query_type, cells, k))
        return ranked(hits, k, item="id", ascending=self.metric == "euclidean").select("query_id", "rank", "id", "score")

    def _search_block(self, vectors: DataFrame, sent: pa.Table, query_type: str, cells: Cells, k: int) -> DataFrame:
        ascending = self.metric == "euclidean"
        asked = matrix_of(sent.column("embedding"))
        promise = self.promise(asked, cells)
        # The cells that promise most and together hold k vectors, for each query.
        order = np.argsort(-promise, axis=1, kind="stable")
        held = np.cumsum(cells.sizes[order], axis=1)
        first = np.zeros(promise.shape, bool)
        np.put_along_axis(first, order, held - cells.sizes[order] < k, axis=1)
        seen = self._scan(vectors, sent, asked, query_type, cells, first, True, k)
        best = ranked(seen, k, item="id", ascending=ascending).toArrow()
        place = {q: n for n, q in enumerate(sent.column("query_id").to_pylist())}
        bar = np.full(len(asked), -np.inf)
        counts = np.zeros(len(asked), int)
        worst = np.full(len(asked), np.inf)
        for query, score in zip(best.column("query_id").to_pylist(), best.column("score").to_pylist()):
            n = place[query]
            counts[n] += 1
            worst[n] = min(worst[n], -score if ascending else score)
        bar[counts >= k] = worst[counts >= k]
        # Ties count after rounding, and sums may come in another order.
        slack = 10.0**-TIE_DIGITS + 1e-9 * np.abs(np.where(np.isfinite(bar), bar, 0))
        later = (promise >= (bar - slack)[:, None]) & ~first
        kept = self.spark.createDataFrame(best.select(["query_id", "id", "score"])) if best.num_rows else seen.limit(0)
        kept = kept.select(*[F.col(c).cast(seen.schema[c].dataType).alias(c) for c in ("query_id", "id", "score")])
        return kept.unionByName(self._scan(vectors, sent, asked, query_type, cells, later, False, k))

    def promise(self, asked: np.ndarray, cells: Cells) -> np.ndarray:
        """Queries x cells: the best score that a vector of the cell can have (distances with a minus)."""
        if self.metric == "euclidean":
            squares = (asked**2).sum(axis=1)[:, None] + (cells.centres**2).sum(axis=1)[None, :] - 2 * asked @ cells.centres.T
            away = np.sqrt(np.maximum(squares, 0))
            return -np.maximum(away * (1 - 1e-9) - 1e-6 - cells.radii[None, :], 0)
        if self.metric == "cosine":
            asked = _units(asked)[0]
        lengths = np.sqrt((asked**2).sum(axis=1))
        return asked @ cells.centres.T + lengths[:, None] * cells.radii[None, :]

    def _scan(
        self, vectors: DataFrame, sent: pa.Table, asked: np.ndarray, query_type: str, cells: Cells, wanted: np.ndarray, rest: bool, k: int
    ) -> DataFrame:
        """The best of the cells wanted by each query, and of vectors without a direction if ``rest``; other cells are not read."""
        metric, ascending = self.metric, self.metric == "euclidean"
        numbers = cells.numbers[wanted.any(axis=0)].tolist() + ([NO_DIRECTION] if rest else [])
        shared = self.spark.sparkContext.broadcast((asked, {int(c): np.flatnonzero(wanted[:, n]) for n, c in enumerate(cells.numbers)}))

        def score_batch(batch: pa.RecordBatch) -> np.ndarray:
            asked, by_cell = shared.value
            scores = np.full((batch.num_rows, len(asked)), np.inf if ascending else -np.inf)
            cell = batch.column("cell").to_numpy()
            rows = matrix_of(batch.column("embedding"), asked.shape[1])
            for number in np.unique(cell).tolist():
                here = np.flatnonzero(cell == number)
                some = np.arange(len(asked)) if number == NO_DIRECTION else by_cell[number]
                if len(some):
                    scores[np.ix_(here, some)] = scores_of(rows[here], asked[some], metric, k)
            return scores

        part = vectors.filter(F.col("cell").isin(numbers)) if numbers else vectors.limit(0)
        rows = part.select("id", "embedding", F.col("cell").cast("int").alias("cell"))
        hits = scan_for_best(rows, "id", score_batch, sent.column("query_id").combine_chunks(), query_type, k, ascending)
        return hits.filter(F.abs("score") < float("inf"))
