"""Ranks: the k best per query, the same tie rule everywhere (score, then id)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.session import cut_lineage

TIE_DIGITS = 9

# Queries that may be sent whole to every task: 16,384 of up to 1,024 numbers are 128 MB.
MAX_SENT_QUERIES = 16_384
# Scores a task holds at once (rows of a batch times queries), and hits it keeps before
# it drops those that no longer are among the best.
MAX_HELD_SCORES = 500_000
MAX_HELD_HITS = 1_000_000
# Rows of a batch whose items are taken apart at once.
MAX_HELD_ROWS = 1_024


def ranked(hits: DataFrame, k: int, score: str = "score", item: str = "chunk_id", ascending: bool = False) -> DataFrame:
    """The ``k`` best rows per ``query_id`` with a 1-based ``rank``."""
    rounded = F.round(score, TIE_DIGITS)
    order = rounded.asc() if ascending else rounded.desc()
    best = W.partitionBy("query_id").orderBy(order, F.col(item).asc())
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _best_of_slice(
    scores: np.ndarray, k: int, ascending: bool, positive_only: bool, limits: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(rows, queries) of the scores (rows x queries) that may be among the ``k`` best of a query.

    Rows come in rising order of id, so of equal scores the first are taken.  ``limits`` holds
    the k-th best key that a query has had in any slice; worse ones are passed over.
    """
    keys = np.round(scores, TIE_DIGITS) if ascending else -np.round(scores, TIE_DIGITS)
    some = (scores > 0 if positive_only else keys < np.inf) & (keys <= limits)
    if len(keys) > k:
        last = np.partition(keys, k - 1, axis=0)[k - 1]
        better, equal = keys < last, keys == last
        equal &= np.cumsum(equal, axis=0) <= k - better.sum(axis=0)
        some &= better | equal
        np.minimum(limits, last, out=limits)
    return np.nonzero(some)


def best_of_hits(hits: pa.Table, k: int, ascending: bool) -> pa.Table:
    """The ``k`` best of each query among the hits (query, id, score) of a task."""
    key = pc.round(hits.column("score"), TIE_DIGITS)
    key = key if ascending else pc.negate(key)
    order = pc.sort_indices(
        hits.append_column("key", key),
        sort_keys=[("query", "ascending"), ("key", "ascending"), ("id", "ascending")],
    )
    ordered = hits.take(order)
    query = ordered.column("query").to_numpy()
    place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    return ordered.filter(pa.array(place < k))


def best_in_task(
    batches: Iterable[pa.RecordBatch],
    score_batch: Callable[[pa.RecordBatch], np.ndarray],
    query_ids: pa.Array,
    k: int,
    ascending: bool,
    positive_only: bool,
    max_scores: int,
    max_hits: int,
) -> pa.Table | None:
    """(query_id, id, score): the ``k`` best rows per query of all batches; the id is column 0."""
    step = max(1, max_scores // max(1, len(query_ids)))
    held: list[pa.Table] = []
    limits = np.full(len(query_ids), np.inf)
    for whole in batches:
        for offset in range(0, whole.num_rows, step):
            part = whole.slice(offset, step)
            part = part.take(pc.sort_indices(part.column(0)))
            scores = score_batch(part)
            row, query = _best_of_slice(scores, k, ascending, positive_only, limits)
            found = [pa.array(query), part.column(0).take(pa.array(row)), pa.array(scores[row, query], pa.float64())]
            held.append(pa.table(found, names=["query", "id", "score"]))
            if sum(h.num_rows for h in held) > max_hits:
                held = [best_of_hits(pa.concat_tables(held), k, ascending)]
    if not held:
        return None
    best = best_of_hits(pa.concat_tables(held), k, ascending)
    columns = [query_ids.take(best.column("query").combine_chunks()), best.column("id"), best.column("score")]
    return pa.table(columns, names=["query_id", "id", "score"])


def scan_for_best(
    table: DataFrame,
    id_column: str,
    score_batch: Callable[[pa.RecordBatch], np.ndarray],
    query_ids: pa.Array,
    query_id_type: str,
    k: int,
    ascending: bool = False,
    positive_only: bool = False,
) -> DataFrame:
    """Score every row of ``table`` against every query, each task passing on only its best.

    The pairs themselves never become rows: a task holds a slice of scores at a time.
    """

    bounds = MAX_HELD_SCORES, MAX_HELD_HITS

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = best_in_task(batches, score_batch, query_ids, k, ascending, positive_only, *bounds)
        if found is not None:
            yield from found.to_batches()

    id_type = table.schema[id_column].dataType.simpleString()
    columns = [id_column, *[c for c in table.columns if c != id_column]]
    return table.select(*columns).mapInArrow(best, f"query_id {query_id_type}, id {id_type}, score double")


def slices(batches: Iterable[pa.RecordBatch], rows: int = MAX_HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows."""
    return (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))


def first_rows(table: DataFrame, limit: int) -> pa.Table | None:
    """The whole of ``table`` on the driver if it has at most ``limit`` rows, else None."""
    found = table.limit(limit + 1).toArrow()
    return found if found.num_rows <= limit else None


def blocks(table: DataFrame, max_rows: int, max_queries: int) -> Iterator[pa.Table]:
    """``table`` in blocks of whole queries within both bounds, one at a time on the driver.

    A single query with more rows than that is a block of its own.
    """
    sent = first_rows(table, max_rows)
    if sent is not None and pc.count_distinct(sent.column("query_id")).as_py() <= max_queries:
        yield sent
        return
    kept = cut_lineage(table)
    size = (F.count(F.lit(1)).alias("n"), F.count_distinct("query_id").alias("queries"))
    parts = [(F.lit(True), *kept.agg(*size).first())]
    while parts:
        condition, n, queries = parts.pop()
        if queries == 1 or (n <= max_rows and queries <= max_queries):
            yield kept.filter(condition).toArrow()
            continue
        # Twice as many parts as would do if they were equal; one that is still too large is cut again.
        cuts = math.ceil(2 * max(n / max_rows, queries / max_queries))
        part = F.pmod(F.xxhash64("query_id", F.lit(len(parts)), F.lit(n)), F.lit(cuts))
        sizes = kept.filter(condition).groupBy(part.alias("part")).agg(*size).collect()
        parts += [(condition & (part == r["part"]), r["n"], r["queries"]) for r in sizes]


def small_side(table: DataFrame, max_rows: int, key: str) -> DataFrame:
    """``table`` marked for broadcast if it has at most ``max_rows`` rows, else as it is.

    Counting up to the bound reads the key column only.
    """
    return F.broadcast(table) if table.select(key).limit(max_rows + 1).count() <= max_rows else table
