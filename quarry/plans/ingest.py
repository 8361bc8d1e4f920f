"""Documents to searchable chunks: process, chunk, index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.borders import PIPELINE_PARAMS, ChunkParams
from quarry.operators.chunking import chunk_elements, chunk_records, chunk_rows, rows_of_arrays
from quarry.operators.elements import describe_images, document_parts, valid_elements
from quarry.operators.enrich import Encoder, embed_texts, fill_cache, with_context, with_vectors
from quarry.operators.index import VectorTable, latest, prepare_vectors
from quarry.sources.files import read_chunks_json


def element_vectors(elements: DataFrame, encoder: Encoder, cache: DataFrame | None = None) -> DataFrame:
    """Elements with the ``vector`` that similarity grouping compares."""
    if cache is None:
        return valid_elements(elements).withColumn("vector", encoder.encode(F.col("text")))
    filled = fill_cache(valid_elements(elements), cache, encoder.encode)
    return embed_texts(valid_elements(elements), filled, encoder.dimensions).withColumnRenamed("embedding", "vector")


def chunk_documents(
    elements: DataFrame,
    params: ChunkParams = PIPELINE_PARAMS,
    use_context: bool = True,
    completions: DataFrame | None = None,
    encoder: Encoder = Encoder(),
    block_rows: int | None = None,
) -> DataFrame:
    """Chunk records of an elements table; ``block_rows`` for documents of any length (see ``chunk_elements``).

    The document text a context is asked with is made before images are described.
    """
    ready = elements if completions is None else describe_images(elements, completions)
    if params.strategy == "semantic":
        ready = element_vectors(ready, encoder)
    chunks = chunk_elements(ready, params, block_rows)
    if not use_context:
        return chunk_records(chunks)
    parts = None if completions is None else document_parts(elements)
    return chunk_records(with_context(chunks, parts, completions), F.col("context"))


def chunk_arrays(documents: DataFrame, params: ChunkParams = PIPELINE_PARAMS, use_context: bool = True) -> DataFrame:
    """Chunk records of (document, elements array) by size, in place: no shuffle."""
    if params.strategy != "basic":
        raise ValueError("similarity grouping needs an elements table with vectors")
    chunks = chunk_rows(rows_of_arrays(documents), params)
    return chunk_records(with_context(chunks), F.col("context")) if use_context else chunk_records(chunks)


def index_records(chunks: DataFrame, encoder: Encoder = Encoder(), cache: DataFrame | None = None) -> DataFrame:
    """Chunk records as rows of the vector table, with vectors of the cache where it has them."""
    return prepare_vectors(with_vectors(chunks, encoder.encode, cache, "contextualized_content"))


def index_from_json(
    table: VectorTable, spark: SparkSession, path: str, encoder: Encoder = Encoder(), cache: DataFrame | None = None
) -> dict[str, int]:
    """Index the chunks of one JSON file, or of all ``*_chunks.json`` files of a folder; the statistics of the table.

    Of several chunks with one id the last counts, in order of file names and of places in them.
    """
    chunks = read_chunks_json(spark, path)
    last = latest(chunks, [F.col("filename"), F.col("file_pos")], "chunk_id")
    return {**table.index_chunks(index_records(last, encoder, cache)), "upserted": chunks.count()}
