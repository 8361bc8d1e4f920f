"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from public_tokenizers import path as tokenizer

from quarry.llm import (
    adaptive_quality,
    chat,
    decontaminate,
    mixture,
    packing,
    periodic,
    pieces,
    pii_crf,
    probminhash,
    reshard,
    site_tree,
    spelling,
    toxicity,
)
from quarry.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by their nearest labelled examples."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that stem from a benchmark item."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "start_word", "end_word")


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taken words per document; longer documents have somewhat higher inclusion odds."""
    mixed = mixture.mix(table(spark, sf_dir, "documents"), odds_weight=F.log2(F.col("size") + 2))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return site_tree.extract(table(spark, sf_dir, "pages"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents: those of the patterns, and all."""
    docs = table(spark, sf_dir, "documents")
    found = pii_crf.spans(docs, pii_crf.fit(docs))

    def of(kind: str, column: Column) -> Column:
        return F.filter(column, lambda s: s["kind"] == kind)

    def written(column: Column) -> Column:
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(column, one), ",")

    both = F.concat("base", "added")
    counts = [F.size(of(k, F.col("base"))).cast("long").alias(f"n_{k}") for k in pii_crf.KINDS]
    # All spans again by kind as listed, then start.
    every = F.flatten(F.array(*[F.sort_array(of(k, both)) for k in pii_crf.KINDS]))
    return found.select(
        "doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(every).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as rows of packed token ids."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the formatted conversations, read back from the formatted text."""
    rows = table(spark, sf_dir, "conversations")
    records = rows.select(
        F.to_variant_object(F.struct("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"), "turn")).alias("record")
    )
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(1).select(
        F.to_variant_object(F.struct(F.lit(-7).alias("conv_id"), said.alias("prompt"), said.alias("response"))).alias("record")
    )
    formatted = chat.format_turns(chat.canonical_turns(records.unionByName(extra)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return (
        chat.read_back(formatted)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.length(learned).cast("long").alias("loss_chars"),
            F.sha2(learned, 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


def op8_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of 12 old shards in 16 new ones of equal bytes."""
    found = reshard.assign(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


def op9_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every document."""
    found = probminhash.classes(table(spark, sf_dir, "documents"))
    kept = (F.col("key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return found.select("doc_id", "class_id", kept.alias("stays"))


def op10_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by thresholds of each language and source."""
    return adaptive_quality.assess(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all frequent words of the documents, some of which lost a letter."""
    return spelling.variants(table(spark, sf_dir, "documents"), spelling.slip)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, some of which stutter."""
    found = periodic.find_runs(table(spark, sf_dir, "documents"), periodic.stutter)
    written = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    )
    # The longest run: of equals the first by start, then period.
    first = F.element_at(F.sort_array(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))), 1)
    none = F.size("runs") == 0
    longest = found.select(
        "doc_id", "runs", "collapsed", F.size("runs").cast("long").alias("n_runs"), F.when(~none, first).alias("r")
    ).select("*", F.col("r.start").alias("start"), (-F.col("r.col1")).alias("length"), F.col("r.period").alias("period"))
    return longest.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.floor(1000 * F.col("length") / F.col("period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents, and of the texts decoded from them."""
    vocabulary = pieces.read_vocabulary(tokenizer("piece_bpe_32k.model"))
    decoded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_decontaminate, op3_mixture, op4_site_tree, op5_pii, op6_packing, op7_chat_format, op8_reshard,
        op9_probminhash, op10_adaptive_quality, op11_spelling, op12_periodic, op13_pieces,
    )
}
