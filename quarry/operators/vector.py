"""Exact dense search: a table of query vectors against a table of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranking import MAX_HELD_SCORES, MAX_SENT_QUERIES, blocks, ranked, scan_for_best

METRICS = ("cosine", "dotproduct", "euclidean")

# Columns of a query table that filter the vectors for that query, and the column each is compared with.
CONDITIONS = {
    "document": "document",
    "chunk_type": "chunk_type",
    "min_page": "page_number",
    "max_page": "page_number",
    "has_image": "has_image",
}


def matrix_of(vectors: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors as rows of ``width`` numbers (by default that of the first); null vectors and numbers are zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    if width is None:
        width = int(sizes[there][0]) if there.any() else 0
    if (sizes[there] != width).any():
        raise ValueError(f"vectors must have {width} numbers")
    rows = np.zeros((len(vectors), width))
    rows[there] = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
    return np.nan_to_num(rows, nan=0.0)


def scores_of(rows: np.ndarray, queries: np.ndarray, metric: str, k: int, allowed: np.ndarray | None = None) -> np.ndarray:
    """Rows x queries; for euclidean the distance, else the similarity.  Pairs that are not ``allowed`` have the worst score."""
    if metric == "euclidean":
        return _distances(rows, queries, k, allowed)
    scores = rows @ queries.T
    if metric == "cosine":
        row_squares, query_squares = (rows**2).sum(axis=1), (queries**2).sum(axis=1)
        size = np.sqrt(row_squares)[:, None] * np.sqrt(query_squares)[None, :]
        scores = np.divide(scores, size, out=np.zeros_like(scores), where=size != 0)
    return scores if allowed is None else np.where(allowed, scores, -np.inf)


def _distances(rows: np.ndarray, queries: np.ndarray, k: int, allowed: np.ndarray | None) -> np.ndarray:
    """Distances of the rows that may be among the ``k`` nearest of a query, infinite for the others.

    Squares by products tell who may be; they lose small distances, so these pairs are measured again by their differences.
    """
    row_squares, query_squares = (rows**2).sum(axis=1), (queries**2).sum(axis=1)
    squares = row_squares[:, None] + query_squares[None, :] - 2 * rows @ queries.T
    if allowed is not None:
        squares = np.where(allowed, squares, np.inf)
    near = squares < np.inf
    if len(rows) > k:
        # Far more than products in double precision can be wrong.
        unsure = 1e-9 * (row_squares.max() + query_squares)
        near &= squares <= np.partition(squares, k - 1, axis=0)[k - 1] + 2 * unsure
    row, query = np.nonzero(near)
    distances = np.full(squares.shape, np.inf)
    step = max(1, MAX_HELD_SCORES // max(1, rows.shape[1]))
    for begin in range(0, len(row), step):
        r, q = row[begin : begin + step], query[begin : begin + step]
        distances[r, q] = np.sqrt(((rows[r] - queries[q]) ** 2).sum(axis=1))
    return distances


def _allowed(batch: pa.RecordBatch, conditions: dict[str, pa.Array]) -> np.ndarray:
    """Rows x queries: whether a row meets the conditions of a query; a null condition is none."""
    allowed = np.True_
    for name, wanted in conditions.items():
        values = batch.column(CONDITIONS[name])
        if name in ("min_page", "max_page"):
            # Nulls become NaN, which meets no bound.
            page, bound = (x.cast("double").to_numpy(zero_copy_only=False)[:, None] for x in (values, wanted))
            meets = np.isnan(bound).T | (page >= bound.T if name == "min_page" else page <= bound.T)
        else:
            known = pc.unique(pc.drop_null(wanted))
            value, want = (
                pc.fill_null(pc.index_in(x, known), missing).to_numpy(zero_copy_only=False)[:, None]
                for x, missing in ((values, -2), (wanted, -1))
            )
            meets = (want == -1).T | (value == want.T)
        allowed = allowed & meets
    return allowed


def allowed_pairs(
    columns: dict[str, pa.Array], conditions: dict[str, pa.Array], row: np.ndarray, query: np.ndarray
) -> np.ndarray:
    """Whether row ``row[i]`` meets the conditions of query ``query[i]``; as ``_allowed``, for some pairs."""
    allowed = np.ones(len(row), bool)
    for name, wanted in conditions.items():
        values, want = columns[CONDITIONS[name]].take(pa.array(row)), wanted.take(pa.array(query))
        if name in ("min_page", "max_page"):
            page, bound = (x.cast("double").to_numpy(zero_copy_only=False) for x in (values, want))
            allowed &= np.isnan(bound) | (page >= bound if name == "min_page" else page <= bound)
        else:
            met = pc.fill_null(pc.equal(values, want), False).to_numpy(zero_copy_only=False)
            allowed &= pc.is_null(want).to_numpy(zero_copy_only=False) | met
    return allowed


def plain_conditions(queries: DataFrame) -> tuple[list[str], list[Column]]:
    """The columns of ``CONDITIONS`` that a query table has, and their values; an empty document or type is none."""
    names = [c for c in CONDITIONS if c in queries.columns]
    return names, [F.nullif(c, F.lit("")).alias(c) if c in ("document", "chunk_type") else F.col(c) for c in names]


def dense_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    max_sent: int = MAX_SENT_QUERIES,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best vectors per query.

    A null vector counts as zeros; one of another width than the queries stops the job.
    ``vectors(id, embedding)`` should already be filtered; ``queries(query_id, embedding)``
    may have columns of ``CONDITIONS``, each row's own filter (null or empty: none) on the
    metadata columns that ``vectors`` then needs.  Up to ``max_sent`` queries are sent to every
    task and the vectors are only scanned; more queries are cut into blocks with a scan each.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}: use one of {METRICS}")
    conditions, plain = plain_conditions(queries)
    vectors = vectors.select("id", "embedding", *sorted({CONDITIONS[c] for c in conditions}))
    queries = queries.select("query_id", "embedding", *plain)
    query_type, id_type = (t.schema[c].dataType.simpleString() for t, c in ((queries, "query_id"), (vectors, "id")))
    hits = vectors.sparkSession.createDataFrame([], f"query_id {query_type}, id {id_type}, score double")
    scans = [
        _scan(vectors, sent, query_type, conditions, k, metric) for sent in blocks(queries, max_sent, max_sent) if sent.num_rows
    ]
    for n, scan in enumerate(scans):
        hits = hits.unionByName(scan) if n else scan
    return ranked(hits, k, item="id", ascending=metric == "euclidean").select("query_id", "rank", "id", "score")


def _scan(
    vectors: DataFrame, sent: pa.Table, query_type: str, conditions: list[str], k: int, metric: str
) -> DataFrame:
    """(query_id, id, score): the best of every task for one block of queries."""
    ascending = metric == "euclidean"
    context = vectors.sparkSession.sparkContext
    matrix = context.broadcast(matrix_of(sent.column("embedding")))
    wanted = context.broadcast({c: sent.column(c).combine_chunks() for c in conditions})

    def score_batch(batch: pa.RecordBatch) -> np.ndarray:
        rows = matrix_of(batch.column("embedding"), matrix.value.shape[1])
        return scores_of(rows, matrix.value, metric, k, _allowed(batch, wanted.value) if conditions else None)

    hits = scan_for_best(vectors, "id", score_batch, sent.column("query_id").combine_chunks(), query_type, k, ascending)
    return hits.filter(F.abs("score") < float("inf")) if conditions or ascending else hits
