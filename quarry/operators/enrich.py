"""Model output as tables: requests out, responses joined back, fallbacks where none came.

``completions(task, request_id, response)`` holds generated texts, ``request_id`` being a
hash of what was asked; ``cache(text_sha, embedding)`` holds vectors.  No service is called
here: ``encode`` is a Column function, or the cache is filled by other means.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.encoder import hash_embedding
from quarry.functions.text import strip

# The request texts, as a model is to be asked.
CONTEXT_PROMPT = (
    "<document>\n",
    "\n</document>\n\n<chunk>\n",
    "\n</chunk>\n\nPlease give a short succinct context to situate this chunk within the overall document for the "
    "purposes of improving search retrieval of the chunk. Answer only with the succinct context and nothing else.",
)


@dataclass(frozen=True)
class Encoder:
    """Settings of a text encoder; ``encode(text)`` gives a vector column."""

    model: str = "hash"
    dimensions: int = 1024
    normalize: bool = True

    def __post_init__(self) -> None:
        if self.dimensions < 1:
            raise ValueError("an encoder has at least one dimension")

    def encode(self, text: Column) -> Column:
        return hash_embedding(text, self.dimensions, self.normalize)


def respond(requests: DataFrame, completions: DataFrame | None, task: str) -> DataFrame:
    """Requests with their ``response`` (stripped; null where there is none)."""
    if completions is None:
        return requests.withColumn("response", F.lit(None).cast("string"))
    answers = one_answer(completions, task).withColumn("response", strip(F.col("response")))
    return requests.join(answers, "request_id", "left")


def one_answer(completions: DataFrame, task: str) -> DataFrame:
    """request_id, response: of several answers to one request the least that is not empty, else empty."""
    answers = completions.filter(F.col("task") == task).groupBy("request_id")
    filled = F.min(F.when(F.col("response") != "", F.col("response")))
    return answers.agg(F.coalesce(filled, F.min("response")).alias("response"))


def unanswered(requests: DataFrame, completions: DataFrame, task: str) -> DataFrame:
    """Distinct requests for which no response is on file."""
    answers = completions.filter(F.col("task") == task).select("request_id")
    return requests.dropDuplicates(["request_id"]).join(answers, "request_id", "left_anti")


def ask(
    requests: DataFrame, completions: DataFrame, task: str, complete: Callable[[Column], Column]
) -> DataFrame:
    """The completions with the unanswered requests (request_id, prompt) answered.

    ``complete`` turns the prompt column into a response column, null where a call failed;
    such requests stay unanswered.  The caller writes the result back.
    """
    fresh = unanswered(requests, completions, task).select(
        F.lit(task).alias("task"), "request_id", complete(F.col("prompt")).alias("response")
    )
    return completions.select("task", "request_id", "response").unionByName(fresh.filter("response is not null"))


# -- context of chunks --------------------------------------------------------------


def context_fallback(document: Column, section_title: Column, page_number: Column) -> Column:
    """The sentence that stands in for a generated context; empty title and page 0 are left out."""
    section = F.when(section_title != "", F.concat(F.lit(" in the "), section_title, F.lit(" section")))
    page = F.when(page_number != 0, F.concat(F.lit(" on page "), page_number.cast("string")))
    return F.concat(
        F.lit("This chunk is from "), document, F.coalesce(section, F.lit("")), F.coalesce(page, F.lit("")), F.lit(".")
    )


def context_requests(chunks: DataFrame, parts: DataFrame) -> DataFrame:
    """(request_id, chunk_id, document): keys only, so that no document is repeated per chunk.

    A document counts by the hash of the hashes of its parts, so its text need not stand together.
    """
    hashes = F.array_sort(F.collect_list(F.struct("part", F.sha2("text", 256).alias("sha"))))
    documents = parts.groupBy("document").agg(hashes.alias("parts")).select(
        "document", F.sha2(F.array_join("parts.sha", "\n"), 256).alias("document_sha")
    )
    identity = F.sha2(F.concat("document_sha", F.lit("\n"), "original_content"), 256)
    return chunks.join(documents, "document").select(identity.alias("request_id"), "chunk_id", "document")


def whole_texts(parts: DataFrame) -> DataFrame:
    """(document, text): the parts of a document joined by blank lines, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("part", "text")))
    joined = parts.groupBy("document").agg(ordered.alias("parts"))
    return joined.select("document", F.array_join("parts.text", "\n\n").alias("text"))


def context_prompts(requests: DataFrame, chunks: DataFrame, parts: DataFrame) -> DataFrame:
    """The full request texts, for requests that have to be sent: only their documents are put together."""
    head, middle, tail = (F.lit(p) for p in CONTEXT_PROMPT)
    asked = whole_texts(parts.join(requests.select("document").distinct(), "document", "left_semi"))
    return (
        requests.join(chunks.select("chunk_id", "original_content"), "chunk_id")
        .join(asked, "document")
        .select("request_id", "chunk_id", F.concat(head, "text", middle, "original_content", tail).alias("prompt"))
    )


def with_context(chunks: DataFrame, parts: DataFrame | None = None, completions: DataFrame | None = None) -> DataFrame:
    """Chunks with a ``context`` column: the generated sentence or the fallback."""
    fallback = context_fallback(F.col("document"), F.col("section_title"), F.col("page_number"))
    if completions is None or parts is None:
        return chunks.withColumn("context", fallback)
    answers = respond(context_requests(chunks, parts), completions, "context").select("chunk_id", "response")
    return chunks.join(answers, "chunk_id", "left").withColumn("context", F.coalesce("response", fallback)).drop(
        "response"
    )


# -- vectors of texts ---------------------------------------------------------------


def text_keys(texts: DataFrame, text: str = "text") -> DataFrame:
    return texts.withColumn("text_sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def embedding_misses(texts: DataFrame, cache: DataFrame, text: str = "text") -> DataFrame:
    """Distinct texts that are not in the cache, each once."""
    distinct = text_keys(texts, text).select("text_sha", F.col(text).alias("text")).dropDuplicates(["text_sha"])
    return distinct.join(cache.select("text_sha"), "text_sha", "left_anti")


def fill_cache(
    texts: DataFrame, cache: DataFrame, encode: Callable[[Column], Column], text: str = "text"
) -> DataFrame:
    """The cache with the missing texts encoded, to be written back by the caller."""
    fresh = embedding_misses(texts, cache, text).select("text_sha", encode(F.col("text")).alias("embedding"))
    return cache.select("text_sha", "embedding").unionByName(fresh)


def embed_texts(texts: DataFrame, cache: DataFrame, dimensions: int, text: str = "text") -> DataFrame:
    """Texts with the vectors of the cache; a text without one gets all zeros."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dimensions)
    return (
        text_keys(texts, text)
        .join(cache.groupBy("text_sha").agg(F.min("embedding").alias("embedding")), "text_sha", "left")
        .withColumn("embedding", F.coalesce("embedding", zeros))
        .drop("text_sha")
    )


def with_vectors(
    texts: DataFrame, encode: Callable[[Column], Column], cache: DataFrame | None = None, text: str = "text"
) -> DataFrame:
    """Texts with their ``embedding``: from the cache, encoded where it has none."""
    fresh = encode(F.col(text))
    if cache is None:
        return texts.withColumn("embedding", fresh)
    kept = cache.groupBy("text_sha").agg(F.min("embedding").alias("embedding"))
    found = text_keys(texts, text).join(kept, "text_sha", "left")
    return found.withColumn("embedding", F.coalesce("embedding", fresh)).drop("text_sha")


def cache_statistics(texts: DataFrame, text: str = "text") -> DataFrame:
    """Calls, hits and misses of a cache that starts empty and forgets nothing."""
    # Counting per text first keeps a text with very many copies out of one task.
    per_text = text_keys(texts, text).groupBy("text_sha").agg(F.count(F.lit(1)).alias("calls"))
    return per_text.agg(
        F.coalesce(F.sum("calls"), F.lit(0)).alias("calls"),
        F.coalesce(F.sum(F.col("calls") - 1), F.lit(0)).alias("hits"),
        F.count(F.lit(1)).alias("misses"),
    )
