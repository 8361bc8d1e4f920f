"""Table layouts shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

ELEMENT_METADATA = T.StructType(
    [
        T.StructField("page_number", T.IntegerType()),
        T.StructField("text_as_html", T.StringType()),
        T.StructField("image_base64", T.StringType()),
        T.StructField("filetype", T.StringType()),
        T.StructField("image_description", T.StringType()),
        T.StructField("has_image", T.BooleanType()),
    ]
)

# One element as it stands in a JSON file.
ELEMENT_JSON = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("metadata", ELEMENT_METADATA),
    ]
)

ELEMENTS = T.StructType(
    [
        T.StructField("document", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        *ELEMENT_JSON.fields,
    ]
)

CHUNK_METADATA = T.StructType(
    [
        T.StructField("document", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("chunk_type", T.StringType()),
        T.StructField("section_title", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("element_count", T.IntegerType()),
        T.StructField("has_image", T.BooleanType()),
        T.StructField("image_base64", T.StringType()),
        T.StructField("image_description", T.StringType()),
        T.StructField("filetype", T.StringType()),
    ]
)

# One chunk as it stands in a JSON file.
CHUNK_JSON = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("original_content", T.StringType()),
        T.StructField("contextualized_content", T.StringType()),
        T.StructField("metadata", CHUNK_METADATA),
        T.StructField("token_count", T.IntegerType()),
    ]
)

# Columns of the vector table, and the fields a filter may name.
VECTORS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("chunk_id", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("chunk_type", T.StringType()),
        T.StructField("section_title", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("element_count", T.IntegerType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("has_image", T.BooleanType()),
        T.StructField("image_description", T.StringType()),
        T.StructField("filetype", T.StringType()),
        T.StructField("original_content", T.StringType()),
    ]
)
FILTER_FIELDS = tuple(f.name for f in VECTORS.fields if f.name not in ("id", "embedding"))

EMBEDDING_CACHE = T.StructType(
    [T.StructField("text_sha", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
)
COMPLETIONS = T.StructType(
    [
        T.StructField("task", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)

# What was asked of a model, and what came of it: a response, or the error of an attempt.
ANSWERS = T.StructType(
    [
        *COMPLETIONS.fields,
        T.StructField("error", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
    ]
)
