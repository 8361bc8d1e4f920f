"""Tables the registered queries start from, all derived from whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.encoder import hash_embedding
from quarry.functions.rows import unfold
from quarry.operators import fusion
from quarry.operators.elements import image_requests
from quarry.operators.index import prepare_vectors
from quarry.plans.retriever import Retriever
from quarry.session import prepare, read_table
from quarry.sources.parsers import explode_elements, text_elements

DIMENSIONS = 64


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = given(spark, sf_dir, "documents")
    return table.withColumn("document", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")))


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def text_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("document", text_elements(F.col("text")).alias("elements"))


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_elements(text_arrays(spark, sf_dir))


def table_html(text):
    """A text as an HTML table: a row per sentence, a cell per word."""
    rows = F.replace(F.replace(text, F.lit(". "), F.lit("</td></tr><TR class='r'><td>")), F.lit(" "), F.lit(" </td><td>"))
    return F.concat(F.lit("<table><tr><td>"), rows, F.lit("&amp;<b>.</b></td></tr></table>"))


def mixed_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines, some made tables, images or titles by their length."""
    # The length is made in the array: as a column of its own it would be counted again wherever it is used.
    sized = F.transform("elements", lambda e: F.struct(e["type"], e["text"], F.length(e["text"]).alias("size")))
    lines = unfold(text_arrays(spark, sf_dir).select("document", sized.alias("elements")), ["document"], F.col("elements"), "e", "pos")
    size = F.col("size")
    kind = (
        F.when(size % 7 == 0, "Table").when(size % 11 == 0, "Image").when(size % 13 == 0, "Title").otherwise(F.col("type"))
    )
    is_table, is_image = F.col("kind") == "Table", F.col("kind") == "Image"
    formats = F.array(F.lit("PNG "), F.lit("jpg"), F.lit("image/gif"), F.lit("bmp"))
    return (
        lines.select("document", "pos", "e.*")
        .withColumn("kind", kind)
        .select(
            "document",
            "pos",
            F.col("kind").alias("type"),
            F.when((is_image & (size % 2 == 0)) | (is_table & (size % 14 == 0)), "").otherwise(F.col("text")).alias("text"),
            F.struct(
                (F.floor(F.col("pos") / 10) + 1).cast("int").alias("page_number"),
                F.when(is_table & (size % 3 != 0), table_html(F.col("text"))).alias("text_as_html"),
                F.when(is_image & (size % 3 != 0), F.md5("text")).alias("image_base64"),
                F.when(is_image, formats[size % 4]).alias("filetype"),
                F.lit(None).cast("string").alias("image_description"),
                F.lit(None).cast("boolean").alias("has_image"),
            ).alias("metadata"),
        )
    )


def image_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions for images, empty for some types and missing for others."""
    requests = image_requests(mixed_elements(spark, sf_dir))
    digit = F.left("image_base64", F.lit(1))
    response = F.when(digit < "8", F.concat(F.lit(" A picture of "), F.left("image_base64", F.lit(8)))).otherwise("")
    return requests.filter(digit < "c").select(F.lit("image").alias("task"), "request_id", response.alias("response"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as one chunk record, with metadata taken from its columns."""
    return documents(spark, sf_dir).select(
        F.concat("document", F.lit("_chunk_0")).alias("chunk_id"),
        "document",
        F.lit(0).alias("chunk_index"),
        F.when(F.col("lang") == "en", "text").when(F.col("lang") == "fr", "table").otherwise("image").alias("chunk_type"),
        F.col("source").alias("section_title"),
        (F.col("n_chars") % 50).cast("int").alias("page_number"),
        F.lit(1).alias("element_count"),
        F.col("n_chars").cast("int").alias("token_count"),
        (F.col("n_chars") % 5 == 0).alias("has_image"),
        F.lit(None).cast("string").alias("image_description"),
        F.lit(None).cast("string").alias("filetype"),
        F.col("text").alias("original_content"),
        F.col("text").alias("contextualized_content"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_vectors(records(spark, sf_dir), hash_embedding(F.col("contextualized_content"), DIMENSIONS))


def encode(text):
    return hash_embedding(text, DIMENSIONS)


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries(spark, sf_dir).select("query_id", encode(F.col("query")).alias("embedding"))


def given_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up answers: the next query's text; rewordings: the sentences of the query.

    Some queries have none, which brings in the fallbacks.
    """
    asked = queries(spark, sf_dir)
    following = asked.select((F.col("query_id") - 1).alias("query_id"), F.col("query").alias("response"))
    hyde = fusion.hyde_requests(asked).join(following.filter(F.col("query_id") % 4 != 3), "query_id")
    sentences = F.concat(F.lit(" \n"), F.replace("query", F.lit(". "), F.lit(" \n\n ")))
    parts = [hyde.select(F.lit("hyde").alias("task"), "request_id", "response")]
    for variants in (2, 3):
        requests = fusion.expand_requests(asked, variants).filter(F.col("query_id") % 5 != 0)
        parts.append(requests.select(F.lit("expand").alias("task"), "request_id", sentences.alias("response")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ranking_text():
    """A model's ranking: repeated, out of range and missing numbers included."""
    odd = F.col("query_id") % 3
    return F.when(odd == 1, "3, 1, 2, 99, 1").when(odd == 2, "Ranking: 7;0;5 and 12345678901234567890, 2")


def retriever(spark: SparkSession, sf_dir: str, with_completions: bool = False) -> Retriever:
    answers = completions(spark, sf_dir) if with_completions else None
    return Retriever(vectors(spark, sf_dir), encode, answers)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.concat("document", F.lit("_chunk_0")).alias("chunk_id"), F.col("text").alias("content")
    )
