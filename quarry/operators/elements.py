"""Elements: validity, images, sections, document texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.text import html_table_to_markdown, is_filled, media_type, strip
from quarry.operators.enrich import one_answer

# What stands for a description that could not be had.
NO_DESCRIPTION = "[Image: description unavailable]"
EMPTY_DESCRIPTION = "[Image: description unavailable - empty response]"
IMAGE_MARK = "[IMAGE] "

STAND_ALONE = ("Table", "Image")

# Elements of one document that one task may see at once.
BLOCK_ROWS = 20_000

# Positions of a document whose texts stand together as one part of its full text.
PART_ROWS = 50


def is_valid(kind: Column, text: Column, image: Column) -> Column:
    """An image counts if it has data, anything else if it has visible text."""
    return F.when(kind == "Image", F.coalesce(image != "", F.lit(False))).otherwise(is_filled(text))


def valid_elements(elements: DataFrame) -> DataFrame:
    kind = F.coalesce("type", F.lit(""))
    return elements.filter(is_valid(kind, F.col("text"), F.col("metadata.image_base64")))


def image_requests(elements: DataFrame) -> DataFrame:
    """One request per distinct image: id, data and media type."""
    images = valid_elements(elements.filter(F.col("type") == "Image"))
    return images.select(
        F.sha2("metadata.image_base64", 256).alias("request_id"),
        F.col("metadata.image_base64").alias("image_base64"),
        media_type(F.col("metadata.filetype")).alias("media_type"),
    ).groupBy("request_id").agg(F.first("image_base64").alias("image_base64"), F.min("media_type").alias("media_type"))


def describe_images(elements: DataFrame, completions: DataFrame) -> DataFrame:
    """Valid elements, images with ``[IMAGE] description`` as text.

    ``completions(task, request_id, response)``: an empty response and a missing one
    leave two different stand-in texts.
    """
    responses = one_answer(completions, "image").withColumnRenamed("request_id", "image_id")
    is_image = F.coalesce(F.col("type") == "Image", F.lit(False))
    # What is an image is known from the type alone, so it is looked at before the texts are.
    images, others = valid_elements(elements.filter(is_image)), valid_elements(elements.filter(~is_image))
    # Only images take part in the join; all other rows stay where they are.
    described = (
        images.withColumn("image_id", F.sha2("metadata.image_base64", 256))
        .join(responses, "image_id", "left")
        .withColumn(
            "description",
            F.when(F.col("response").isNull(), NO_DESCRIPTION)
            .when(F.col("response") == "", EMPTY_DESCRIPTION)
            .otherwise(strip(F.col("response"))),
        )
        .withColumn("text", F.concat(F.lit(IMAGE_MARK), "description"))
        .withColumn(
            "metadata",
            F.col("metadata")
            .withField("image_description", F.col("description"))
            .withField("has_image", F.lit(True)),
        )
    )
    return others.unionByName(described.select(*others.columns))


def carried_over(
    elements: DataFrame, block_rows: int, local: Column, merge: Column, name: str, default: Column
) -> DataFrame:
    """Add ``name``: what a running value over a document has reached *before* each block.

    A document is cut into blocks of ``block_rows`` positions, so that no window holds
    more than one block; ``local`` summarises a block and ``merge`` runs over the
    summaries of the blocks before (one row per block).
    """
    summaries = elements.groupBy("document", "block").agg(local.alias(name))
    before = W.partitionBy("document").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = summaries.select("document", "block", F.coalesce(merge.over(before), default).alias(name))
    return elements.join(carried, ["document", "block"])


def section_titles(elements: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Valid elements with the text of the last Title at or before them."""
    titled = valid_elements(elements).select(
        "document",
        "pos",
        "type",
        F.floor(F.col("pos") / block_rows).alias("block"),
        F.when(F.col("type") == "Title", F.col("text")).alias("title"),
    )
    last_in_block = F.max_by("title", F.when(F.col("title").isNotNull(), F.col("pos")))
    carried = carried_over(
        titled, block_rows, last_in_block, F.last("carried_title", True), "carried_title", F.lit(None)
    )
    within = W.partitionBy("document", "block").orderBy("pos")
    return carried.select(
        "document",
        "pos",
        "type",
        F.coalesce(F.last("title", True).over(within), "carried_title").alias("section_title"),
    )


def hard_segments(elements: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Valid elements with the number of tables and images up to and including them."""
    alone = valid_elements(elements).select(
        "document",
        "pos",
        "type",
        F.floor(F.col("pos") / block_rows).alias("block"),
        F.col("type").isin(*STAND_ALONE).cast("int").alias("alone"),
    )
    carried = carried_over(alone, block_rows, F.sum("alone"), F.sum("segments_before"), "segments_before", F.lit(0))
    within = W.partitionBy("document", "block").orderBy("pos")
    return carried.select(
        "document",
        "pos",
        "type",
        (F.col("segments_before") + F.sum("alone").over(within)).cast("int").alias("segment"),
    )


def reading_text(kind: Column, text: Column, html: Column) -> Column:
    """Text of an element as it stands in a chunk: tables as Markdown where there is HTML."""
    has_html = F.coalesce((kind == "Table") & (html != ""), F.lit(False))
    return F.when(has_html, html_table_to_markdown(html)).otherwise(F.coalesce(text, F.lit("")))


def document_parts(elements: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Full text of each document, stripped parts joined by blank lines.

    Every document comes in parts of ``part_rows`` positions, those without text left out;
    ``enrich.whole_texts`` joins them.
    """
    html = F.col("metadata.text_as_html")
    is_table = F.coalesce((F.col("type") == "Table") & is_filled(html), F.lit(False))
    text = F.when(is_table, html_table_to_markdown(html)).otherwise(strip(F.coalesce("text", F.lit(""))))
    return (
        elements.select("document", "pos", is_table.alias("is_table"), text.alias("text"))
        .filter(F.col("is_table") | (F.col("text") != ""))
        .groupBy("document", F.floor(F.col("pos") / part_rows).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("parts"))
        .select("document", "part", F.array_join("parts.text", "\n\n").alias("text"))
    )
