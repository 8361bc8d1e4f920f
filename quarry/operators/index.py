"""The vector table: records, filters, upsert, statistics."""

from __future__ import annotations

import functools
import operator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.operators.ranking import small_side
from quarry.schemas import FILTER_FIELDS, VECTORS
from quarry.session import cut_lineage
from quarry.sources.bucketed import BUCKETS, BucketedTable

# Ids that may be sent whole to every task.
MAX_SENT_IDS = 1_000_000

OPERATORS = {"$eq": operator.eq, "$gte": operator.ge, "$lte": operator.le}


def prepare_vectors(
    chunks: DataFrame,
    embedding: Column | None = None,
    content_chars: int | None = None,
    description_chars: int | None = None,
) -> DataFrame:
    """Chunk records as flat, filterable index records with defaults for what is missing.

    Texts are stored whole; ``content_chars`` and ``description_chars`` cut them for a store that limits them.
    """

    def cut(column: str, chars: int | None) -> Column:
        return F.col(column) if chars is None else F.left(column, F.lit(chars))

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("int").alias(name)

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    vector = embedding if embedding is not None else F.col("embedding")
    return chunks.select(
        F.col("chunk_id").alias("id"),
        vector.cast("array<float>").alias("embedding"),
        "chunk_id",
        text("document", ""),
        number("chunk_index"),
        text("chunk_type", "text"),
        text("section_title", ""),
        number("page_number"),
        number("element_count"),
        number("token_count"),
        F.coalesce("has_image", F.lit(False)).alias("has_image"),
        F.nullif(cut("image_description", description_chars), F.lit("")).alias("image_description"),
        F.nullif("filetype", F.lit("")).alias("filetype"),
        cut("original_content", content_chars).alias("original_content"),
    )


def compile_filter(filters: dict[str, Any] | None, fields: tuple[str, ...] = FILTER_FIELDS) -> Column:
    """A filter dict as a condition: ``{field: {op: value, …}}``, ``{"$and": [filter, …]}``.

    Several operators of a field, several fields and the parts of ``$and`` must all hold.
    """
    conditions: list[Column] = []
    for name, wanted in (filters or {}).items():
        if name == "$and":
            conditions.extend(compile_filter(part, fields) for part in wanted)
        elif name not in fields:
            raise ValueError(f"unknown filter field {name!r}")
        elif not isinstance(wanted, dict):
            raise ValueError(f"field {name!r} needs an operator dict, not {wanted!r}")
        else:
            for op, value in wanted.items():
                if op not in OPERATORS:
                    raise ValueError(f"unknown filter operator {op!r}")
                conditions.append(OPERATORS[op](F.col(name), F.lit(value)))
    return functools.reduce(operator.and_, conditions, F.lit(True))


def combined_filter(
    document: str | None = None,
    chunk_type: str | None = None,
    min_page: int | None = None,
    max_page: int | None = None,
    has_image: bool | None = None,
) -> dict[str, Any] | None:
    """Filter dict of the conditions given; an empty document or type is no condition."""
    conditions: list[dict[str, Any]] = []
    for name, value in (("document", document), ("chunk_type", chunk_type)):
        if value:
            conditions.append({name: {"$eq": value}})
    for name, op, value in (
        ("page_number", "$gte", min_page),
        ("page_number", "$lte", max_page),
        ("has_image", "$eq", has_image),
    ):
        if value is not None:
            conditions.append({name: {op: value}})
    return {"$and": conditions} if conditions else None


def latest(rows: DataFrame, order: list[Column], key: str = "id") -> DataFrame:
    """One row per key, the last in ``order``."""
    newest = W.partitionBy(key).orderBy(*[c.desc() for c in order])
    return rows.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") == 1).drop("_nth")


def upsert(stored: DataFrame, sent: DataFrame, order: list[Column]) -> DataFrame:
    """``stored`` with the rows of ``sent`` put in; of several with one id the last counts.

    The stored rows are only compared by id: if few rows are sent, they do not move.
    """
    new = latest(sent, order).select(*stored.columns)
    ids = small_side(sent.select("id"), MAX_SENT_IDS, "id")
    return stored.join(ids, "id", "left_anti").unionByName(new)


def upsert_report(sent: DataFrame, table: DataFrame) -> DataFrame:
    """Rows sent (repeated ids count), rows in the table, width of the vectors."""
    return sent.agg(F.count(F.lit(1)).alias("upserted")).join(index_stats(table), how="full")


def index_stats(vectors: DataFrame) -> DataFrame:
    return vectors.agg(
        F.count(F.lit(1)).alias("total_vectors"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dimensions")
    )


class VectorTable:
    """A stored vector table of fixed width, in buckets of ids; made on first use."""

    def __init__(self, spark: SparkSession, path: str, dimensions: int = 1024, buckets: int = BUCKETS):
        self.table, self.dimensions = BucketedTable(spark, path, VECTORS, "id", buckets), dimensions
        if not self.table.exists():
            self.table.clear()

    def read(self) -> DataFrame:
        return self.table.read()

    def read_buckets(self) -> tuple[DataFrame, int]:
        """The records with their ``_bucket``, and the number of buckets: what a ``Retriever`` needs to read few folders."""
        return self.table.read_with_bucket(), len(self.table.manifest().folders)

    def read_ids(self, ids: DataFrame) -> DataFrame:
        """The records of the ids in the first column of ``ids``, from their buckets alone."""
        return self.table.read_keys(ids)

    def index_chunks(self, vectors: DataFrame, order: list[Column] | None = None) -> dict[str, int]:
        """Upsert records; a vector of another width stops the job and changes nothing.

        Of several records with one id the last in ``order`` counts, by default the last in the batch.  Only the
        buckets that the batch falls into are written anew.
        """
        # As a column, not as a filter: a filter would be moved to the texts and encode them a second time.
        wrong = F.raise_error(F.lit(f"vectors must have {self.dimensions} numbers")).cast("array<float>")
        width = F.when(F.size("embedding") == self.dimensions, F.col("embedding")).otherwise(wrong)
        # The batch is made once, however often it is looked at.
        checked = cut_lineage(vectors.withColumn("embedding", width).withColumn("_sent", F.monotonically_increasing_id()))
        self.table.merge(checked, order or [F.col("_sent")])
        return {"upserted": checked.count(), **self.stats()}

    def stats(self) -> dict[str, int]:
        return {"total_vectors": self.read().count(), "dimensions": self.dimensions}

    def compact(self) -> None:
        """All records in new files; old versions go with ``clean_up``."""
        self.table.compact()

    def clean_up(self, keep: int = 1) -> None:
        self.table.clean_up(keep)

    def delete_all_vectors(self) -> None:
        self.table.clear()

    def delete_index(self) -> None:
        self.table.drop()
