"""Lists of hits brought together: rank fusion, expansion, mean scores, reranking.

All tables here hold at most a few times ``k`` rows per query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.rows import unfold
from quarry.functions.text import strip
from quarry.operators.enrich import respond
from quarry.operators.ranking import ranked

# Damping of rank fusion, characters of a candidate in a rerank request,
# characters of a preview.
FUSION_DAMPING = 60
CANDIDATE_CHARS = 500
PREVIEW_CHARS = 200

# The request texts, as a model is to be asked.
HYDE_PROMPT = (
    "Write a short, detailed paragraph that would be a perfect answer to this question.\n"
    "Write the content directly as if from a reference document. No preamble.\n\nQuestion: ",
    "\n\nAnswer:",
)
EXPAND_PROMPT = (
    "Generate ",
    " different ways to phrase this search query.\nEach variation should capture the same intent but use different "
    "words.\nReturn ONLY the variations, one per line, no numbering.\n\nOriginal: ",
    "\n\nVariations:",
)
RERANK_PROMPT = (
    "Given the query and documents below, rank the documents by relevance.\nReturn ONLY a comma-separated list of "
    "document numbers in order of relevance (most relevant first).\n\nQuery: ",
    "\n\nDocuments:\n",
    "\n\nRanking (comma-separated numbers):",
)


def reciprocal_rank(rank: Column, weight: float) -> Column:
    return F.lit(weight) * (F.lit(1.0) / (FUSION_DAMPING + rank))


def rank_fusion(dense: DataFrame, lexical: DataFrame, k: int, dense_weight: float = 0.7) -> DataFrame:
    """(query_id, rank, chunk_id, score, by_words) from two ranked lists (query_id, rank, chunk_id).

    ``by_words``: only the lexical list has the chunk.
    """

    def votes(hits: DataFrame, weight: float, by_words: bool) -> DataFrame:
        vote = reciprocal_rank(F.col("rank"), weight).alias("vote")
        return hits.select("query_id", "chunk_id", vote, F.lit(by_words).alias("by_words"))

    fused = (
        votes(dense, dense_weight, False)
        .unionByName(votes(lexical, 1 - dense_weight, True))
        .groupBy("query_id", "chunk_id")
        .agg(F.sum("vote").alias("score"), F.min("by_words").alias("by_words"))
    )
    return ranked(fused, k).select("query_id", "rank", "chunk_id", "score", "by_words")


def hyde_requests(queries: DataFrame) -> DataFrame:
    head, tail = (F.lit(p) for p in HYDE_PROMPT)
    prompt = F.concat(head, "query", tail)
    return queries.select("query_id", "query", F.sha2(prompt, 256).alias("request_id"), prompt.alias("prompt"))


def hyde_texts(queries: DataFrame, completions: DataFrame | None) -> DataFrame:
    """(query_id, search_text, hyde_query): the made-up answer, or the query itself without one."""
    answered = respond(hyde_requests(queries), completions, "hyde")
    return answered.select(
        "query_id", F.coalesce("response", "query").alias("search_text"), F.col("response").alias("hyde_query")
    )


def expand_requests(queries: DataFrame, variants: int) -> DataFrame:
    head, middle, tail = (F.lit(p) for p in EXPAND_PROMPT)
    prompt = F.concat(head, F.lit(str(variants)), middle, "query", tail)
    return queries.select("query_id", "query", F.sha2(prompt, 256).alias("request_id"), prompt.alias("prompt"))


def expand_queries(queries: DataFrame, completions: DataFrame | None, variants: int = 3) -> DataFrame:
    """(query_id, variant, search_text): the query (variant 0) and up to ``variants`` rewordings."""
    lines = F.filter(F.transform(F.split("response", "\n"), strip), lambda line: line != "")
    others = F.coalesce(F.slice(lines, 1, variants), F.array().cast("array<string>"))
    answered = respond(expand_requests(queries, variants), completions, "expand")
    return unfold(answered, ["query_id"], F.concat(F.array("query"), others), "search_text", "variant").select(
        "query_id", "variant", "search_text"
    )


def mean_scores(hits: DataFrame, k: int, keep: str | None = None, first: str | None = None) -> DataFrame:
    """Per query and chunk the mean of the scores of the lists that have the chunk, then the ``k`` best.

    ``keep`` is a column taken from the list that comes first in ``first``.
    """
    extra = [F.min_by(keep, first).alias(keep)] if keep else []
    means = hits.groupBy("query_id", "chunk_id").agg(F.avg("score").alias("score"), *extra)
    return ranked(means, k)


def rerank_requests(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """One request per query from its candidates (query_id, rank, content)."""
    entry = F.concat(
        F.lit("\n[Document "), F.col("rank"), F.lit("]\n"), F.left("content", F.lit(CANDIDATE_CHARS)), F.lit("\n")
    )
    listed = (
        candidates.groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("entries"))
        .select("query_id", F.array_join("entries.entry", "").alias("entries"))
    )
    head, middle, tail = (F.lit(p) for p in RERANK_PROMPT)
    prompt = F.concat(head, "query", middle, "entries", tail)
    return queries.join(listed, "query_id").select(
        "query_id", F.sha2(prompt, 256).alias("request_id"), prompt.alias("prompt")
    )


def parsed_ranking(response: Column, count: Column) -> Column:
    """Numbers from 1 to ``count`` in a response, in order, each once."""
    numbers = F.transform(F.regexp_extract_all(response, F.lit(r"\d+"), F.lit(0)), lambda n: n.try_cast("int"))
    return F.array_distinct(F.filter(numbers, lambda n: n.between(1, count)))


def rerank(candidates: DataFrame, responses: DataFrame, k: int = 5) -> DataFrame:
    """Candidates (query_id, rank, …) in the order of a model's ranking text, the first ``k``.

    ``responses(query_id, response)``; candidates it does not list follow in their old
    order, and a query without a response keeps the old order.  Scores stay.
    """
    listed = candidates.groupBy("query_id").agg(F.max("rank").alias("candidates"))
    order = unfold(
        responses.join(listed, "query_id"),
        ["query_id"],
        parsed_ranking(F.col("response"), F.col("candidates")),
        "old_rank",
        "place",
    )
    placed = candidates.withColumnRenamed("rank", "old_rank").join(order, ["query_id", "old_rank"], "left")
    best = W.partitionBy("query_id").orderBy(F.col("place").asc_nulls_last(), "old_rank")
    return (
        placed.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .drop("place", "old_rank")
    )


def result_cards(results: DataFrame) -> DataFrame:
    """What a reader is shown of a result."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("N/A")).alias(name)

    preview = F.concat(F.translate(F.left("content", F.lit(PREVIEW_CHARS)), "\n", " "), F.lit("..."))
    return results.select(
        "query_id",
        "rank",
        F.format_string("%.4f", "score").alias("score"),
        "chunk_id",
        shown("document"),
        shown("chunk_type"),
        shown("page_number"),
        F.nullif("section_title", F.lit("")).alias("section_title"),
        preview.alias("preview"),
    )


def results_json(results: DataFrame) -> DataFrame:
    """Results as JSON objects: id, score, content and all other columns as metadata."""
    metadata = [c for c in results.columns if c not in ("query_id", "rank", "chunk_id", "score", "content")]
    return results.select(
        "query_id",
        "rank",
        F.to_json(F.struct("chunk_id", "score", "content", F.struct(*metadata).alias("metadata"))).alias("json"),
    )
