"""Files in and out: routing by type, element and chunk files, the extraction log."""

from __future__ import annotations

from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.rows import unfold
from quarry.schemas import CHUNK_JSON, ELEMENT_JSON
from quarry.sources import folders
from quarry.sources.parsers import file_elements
from quarry.sources.whole_files import write_files

JSON_ARRAY = {"open": "[", "between": ",\n", "close": "]"}

# Extraction parameters by file type; any other type has the last ones.
LANGUAGES = ["eng"]
ROUTES = {
    ".pdf": {
        "strategy": "hi_res",
        "hi_res_model_name": "yolox",
        "pdf_infer_table_structure": True,
        "extract_image_block_types": ["Image", "Table"],
        "split_pdf_page": True,
        "split_pdf_allow_failed": True,
        "split_pdf_concurrency_level": 10,
    },
    ".pptx": {"strategy": "hi_res", "extract_image_block_types": ["Image", "Table"], "infer_table_structure": True},
    ".docx": {"strategy": "hi_res", "infer_table_structure": True},
    ".html": {"strategy": "auto"},
    ".txt": {"strategy": "fast"},
    ".md": {"strategy": "fast"},
    ".csv": {"strategy": "fast"},
}
DEFAULT_ROUTE = {"strategy": "auto"}

# Types whose content is read here, and how long a file of them may be.
READABLE = (".html", ".htm", ".csv", ".txt", ".md")
MAX_FILE_BYTES = 256 * 1024 * 1024

ROUTE_TYPES = {
    "strategy": "string",
    "hi_res_model_name": "string",
    "pdf_infer_table_structure": "boolean",
    "infer_table_structure": "boolean",
    "extract_image_block_types": "array<string>",
    "split_pdf_page": "boolean",
    "split_pdf_allow_failed": "boolean",
    "split_pdf_concurrency_level": "int",
}


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_extension(path: Column) -> Column:
    """Last suffix of the file name in lower case, '' without one."""
    return F.lower(F.regexp_extract(file_name(path), r"[^.](\.[^./]+)$", 1))


def json_name(path: Column) -> Column:
    """Name of the element file of a source: the last suffix becomes ``.json``."""
    name = file_name(path)
    return F.concat(F.regexp_replace(name, r"(?<=[^.])\.[^./]+$", ""), F.lit(".json"))


def route(files: DataFrame, path: str = "path") -> DataFrame:
    """Files with their extraction parameters."""

    def value(parameters: dict, name: str) -> Column:
        return F.lit(parameters.get(name)).cast(ROUTE_TYPES[name])

    extension = file_extension(F.col(path))
    columns = {"extension": extension, "languages": F.lit(LANGUAGES)}
    for name in ROUTE_TYPES:
        chosen = value(DEFAULT_ROUTE, name)
        for suffix, parameters in ROUTES.items():
            chosen = F.when(extension == suffix, value(parameters, name)).otherwise(chosen)
        columns[name] = chosen
    return files.withColumns(columns)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, filename, extension, length) of the files of a flat folder; no content is read.

    A folder of many files is listed by a task when the rows are asked for.  Spark's file sources, which list on the driver at once and
    pass empty files by, do the others.
    """
    place = folders.Folder(spark, folder)
    # Empty files have the path as it was given.
    given, path = F.concat(F.lit(folder.rstrip("/") + "/"), "filename"), F.concat(F.lit(place.path), "filename")
    if place.has_many():
        every = place.list().select(F.when(F.col("length") > 0, path).otherwise(given).alias("path"), "filename", "length")
        return every.withColumn("extension", file_extension(F.col("path")))
    source = spark.read.format("binaryFile").load(folder)
    listed = source.select("path", file_name(F.col("path")).alias("filename"), "length")
    names = [unquote(path.rsplit("/", 1)[1]) for path in source.inputFiles()]
    # One scan of the listing: what it passes by is found by the names it has no row for.
    joined = spark.createDataFrame(pa.table({"filename": pa.array(names, pa.string())})).join(listed, "filename", "left")
    every = joined.select(F.coalesce("path", given).alias("path"), "filename", F.coalesce("length", F.lit(0).cast("long")).alias("length"))
    return every.withColumn("extension", file_extension(F.col("path")))


def read_files(spark: SparkSession, folder: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(path, filename, extension, length, content, problem) of the files of a flat folder.

    Content is read of files that a rule reads, up to ``max_bytes``; where it is null ``problem`` says why.
    """
    listed = list_files(spark, folder)
    known = F.col("extension").isin(*READABLE)
    wanted = known & F.col("length").between(1, max_bytes)
    place = folders.Folder(spark, folder)
    if place.has_many():
        found = place.read(listed, wanted)
    else:
        either = lambda suffix: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in suffix)
        pattern = "*{" + ",".join(either(suffix) for suffix in READABLE) + "}"
        raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        path = F.col("path")
        named = raw.select("path", file_name(path).alias("filename"), file_extension(path).alias("extension"), "length", "content")
        found = named.filter(wanted).unionByName(listed.filter(~wanted), allowMissingColumns=True)
    text = F.col("content").cast("string")
    return found.withColumn("whole", F.is_valid_utf8(text)).select(
        "path", "filename", "extension", "length",
        F.when(F.col("whole"), text).when(known & (F.col("length") == 0), "").alias("content"),
        F.when(~F.col("whole"), "content is not UTF-8")
        .when(known & (F.col("length") > max_bytes), F.lit(f"file of more than {max_bytes} bytes"))
        .when(~known, F.concat(F.lit("no reader for file type "), "extension"))
        .alias("problem"),
    )


def extract(files: DataFrame) -> DataFrame:
    """Files with their ``elements`` array (null where it failed) and log columns.

    A file of a type that no rule reads, or without readable content, is a row with the status ``failed`` and an ``error``.
    """
    read = route(files).withColumn("elements", file_elements(F.col("content"), F.col("extension")))
    failed = F.col("elements").isNull()
    problem = F.when(~F.col("extension").isin(*READABLE), F.concat(F.lit("no reader for file type "), "extension")).otherwise("no content")
    if "problem" in files.columns:
        problem = F.coalesce("problem", problem)
    return read.select(
        F.col("filename").alias("document"),
        "filename",
        json_name(F.col("path")).alias("output"),
        "elements",
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(~failed, F.size("elements")).alias("elements_count"),
        F.when(~failed, F.col("strategy")).alias("strategy"),
        F.when(failed, problem).alias("error"),
    )


def extract_log(extracted: DataFrame) -> DataFrame:
    return extracted.select("filename", "status", "elements_count", "strategy", "error")


def extract_summary(log: DataFrame) -> DataFrame:
    """Totals of a run; what succeeded and what failed can be read in the log itself."""
    return log.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.coalesce(F.sum("elements_count"), F.lit(0)).alias("elements"),
    )


# -- element and chunk files --------------------------------------------------------


def parse_elements(texts: DataFrame, content: str = "content") -> DataFrame:
    """(filename, content) with the JSON array of elements; null where it cannot be read."""
    return texts.withColumn("elements", F.from_json(content, T.ArrayType(ELEMENT_JSON)))


def json_elements_log(parsed: DataFrame) -> DataFrame:
    failed = F.col("elements").isNull()
    return parsed.select(
        "filename",
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(~failed, F.size("elements")).alias("elements_count"),
        F.lit(None).cast("string").alias("strategy"),
        F.when(failed, "not a JSON array of elements").alias("error"),
    )


def elements_of_json(parsed: DataFrame) -> DataFrame:
    """The elements table; files that cannot be read give no rows (see the log)."""
    named = parsed.withColumn("document", F.regexp_replace("filename", r"\.json$", ""))
    return unfold(named, ["document"], F.col("elements"), "e", "pos").select(
        "document", "pos", F.coalesce("e.type", F.lit("")).alias("type"), F.coalesce("e.text", F.lit("")).alias("text"), "e.metadata"
    )


def read_json_texts(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """(filename, content), one row per file; ``filename`` as in ``_metadata.file_name``, which is that of a URI.

    A folder of many files is listed by a task when the rows are asked for (see ``list_files``).
    """
    place = folders.Folder(spark, folder)
    if place.has_many():
        listed = place.list().filter(place.matching(pattern) & (F.col("length") > 0))
        found = place.read(listed, F.lit(True))
        return found.select(F.col("uri_name").alias("filename"), F.col("content").cast("string").alias("content"))
    # Not as whole texts: that source sets up a reader of its own for every file, which costs more than its content.
    texts = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return texts.select(F.col("_metadata.file_name").alias("filename"), F.col("content").cast("string").alias("content"))


def read_elements_json(spark: SparkSession, folder: str) -> DataFrame:
    return elements_of_json(parse_elements(read_json_texts(spark, folder)))


def chunks_of_json(texts: DataFrame) -> DataFrame:
    """Chunk records of JSON arrays of chunks (filename, content), metadata flattened."""
    parsed = texts.withColumn("chunks", F.from_json("content", T.ArrayType(CHUNK_JSON)))
    rows = unfold(parsed, ["filename"], F.col("chunks"), "c", "file_pos")
    return rows.select(
        "filename",
        "file_pos",
        "c.chunk_id",
        "c.metadata.document",
        "c.metadata.chunk_index",
        "c.original_content",
        "c.contextualized_content",
        "c.token_count",
        "c.metadata.chunk_type",
        "c.metadata.section_title",
        "c.metadata.page_number",
        "c.metadata.has_image",
        "c.metadata.image_base64",
        "c.metadata.image_description",
        "c.metadata.filetype",
        "c.metadata.element_count",
    )


def read_chunks_json(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records of one file, or of all ``*_chunks.json`` files of a folder."""
    pattern = "*" if path.endswith(".json") else "*_chunks.json"
    return chunks_of_json(read_json_texts(spark, path, pattern))


def chunk_json(chunks: DataFrame) -> Column:
    """One chunk record as a JSON object, in the layout of the chunk files."""
    metadata = F.struct(*[f.name for f in CHUNK_JSON["metadata"].dataType.fields])
    return F.to_json(
        F.struct("chunk_id", "original_content", "contextualized_content", metadata.alias("metadata"), "token_count")
    )


def write_elements(elements: DataFrame, folder: str) -> None:
    """Elements as Parquet.  Rows of a document keep their order by ``pos``."""
    elements.write.mode("overwrite").parquet(folder)


def write_json(table: DataFrame, folder: str) -> None:
    """Elements or chunks as JSON lines, for other programs."""
    table.write.mode("overwrite").json(folder)


def element_json(elements: DataFrame) -> Column:
    """One element as a JSON object, in the layout of the element files."""
    return F.to_json(F.struct(*[f.name for f in ELEMENT_JSON.fields]))


def write_element_files(elements: DataFrame, folder: str) -> None:
    """One JSON array per document, as ``parse_elements`` reads it: ``report.pdf`` goes to ``report.json``."""
    rows = elements.select(json_name(F.col("document")).alias("file"), "pos", element_json(elements).alias("content"))
    write_files(rows, folder, [F.col("pos")], **JSON_ARRAY)


def write_chunk_files(chunks: DataFrame, folder: str) -> None:
    """One JSON array per document, as ``read_chunks_json`` reads it: ``report.pdf`` goes to ``report_chunks.json``."""
    name = F.regexp_replace(json_name(F.col("document")), r"\.json$", "_chunks.json")
    rows = chunks.select(name.alias("file"), "chunk_index", chunk_json(chunks).alias("content"))
    write_files(rows, folder, [F.col("chunk_index")], **JSON_ARRAY)
