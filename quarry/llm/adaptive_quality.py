"""Quality rules whose thresholds follow the data.

Each document gets integer measures. Their distributions are kept as log-linear histograms per language and source: a
count per bucket, with buckets of width one below 64 and of at most 1/32 of the value above. Such sketches merge by adding
counts, give the same answer in whatever order they are merged, and their size is bounded by the range of a measure, not by
the number of documents. Thresholds are fences read from the quantiles, and documents are filtered by a join with them. A
source with few documents uses the merged sketch of its language, and a rare language the sketch of everything.

Only DataFrame functions are used. One scan computes the measures; counts are added up before they are shuffled, so a
source with a third of all rows is no more than a few hundred counts per task.

Defined results: null text counts as empty; an empty text has zero in all measures and fails the base rule; repeated rows
count as often as they come, each with the same verdict; null language or source is a group of its own; an empty table gives
an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import BLANKS, WORD, stored, text_or_empty

SYMBOLS = "#*$%&|<>"
#: A group with fewer documents takes the thresholds of the next larger one.
MIN_DOCUMENTS = 200
#: Fence: the 90th percentile plus this many times its distance from the median.
REACH = 2
#: Least distance that a fence keeps from the 90th (or 10th) percentile, in the units of the measure.
LEAST_GAP = {"symbols": 50, "repeats": 200, "dup_lines": 500, "word_length": 300}
LOWER = ("word_length",)
MIN_WORDS = 50


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.col("text")
    words = docs.select(
        "doc_id",
        F.col("lang"),
        F.col("source"),
        text_or_empty().alias("text"),
    ).select(
        "doc_id",
        "lang",
        "source",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )
    # A hash for each window of three words; the windows are sorted by it only where two are alike.
    windows = words.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))),
                lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
            ),
        ).alias("grams"),
    )
    ordered = windows.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("grams")) < F.size("grams"),
            F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
        ),
    ).drop("grams")
    places = ordered.withColumn(
        "places",
        F.filter(
            F.transform(
                "ordered",
                lambda x, j: F.when(
                    (F.get("ordered", j - 1)["g"] == x["g"]) | (F.get("ordered", j + 1)["g"] == x["g"]), x["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        ),
    ).drop("ordered")
    # Windows in order of place: each covers three words less those the one before it covers.
    covered = F.aggregate(
        F.sort_array("places"),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def rates() -> dict[str, Column]:
    """Measures that are compared with thresholds: whole numbers, so that sketches are exact in any order."""

    def ratio(a: str, b: str, scale: int) -> Column:
        return F.when(F.col(b) > 0, F.expr(f"({scale} * {a}) div {b}")).otherwise(F.lit(0)).cast("long")

    return {
        "symbols": ratio("n_symbols", "word_chars", 1000),
        "repeats": ratio("n_repeat_words", "n_words", 1000),
        "dup_lines": ratio("n_dup_lines", "n_lines", 1000),
        "word_length": ratio("word_chars", "n_words", 100),
    }


#: The least value of the log-linear bucket of v: its six leading bits.
BUCKET = "shiftleft(shiftright(v, greatest(length(bin(v)) - 6, 0)), greatest(length(bin(v)) - 6, 0))"


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n. Adding up n over rows merges the sketches."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("v")) for k, v in rates().items()]))
    return (
        measured.select("lang", "source", values.alias("m"))
        .select("lang", "source", "m.measure", F.col("m.v").alias("v"))
        .withColumn("bucket", F.expr(BUCKET))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def thresholds(sketch: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """level (0: source, 1: language, 2: all), lang, source, measure, low, high, from merged sketches."""
    levels = [
        (0, F.col("lang"), F.col("source")),
        (1, F.col("lang"), F.lit(None).cast("string")),
        (2, F.lit(None).cast("string"), F.lit(None).cast("string")),
    ]
    copies = F.explode(
        F.array(*[F.struct(F.lit(n).alias("level"), a.alias("lang"), b.alias("source")) for n, a, b in levels])
    )
    merged = (
        sketch.select(copies.alias("g"), "measure", "bucket", "n")
        .groupBy("g", "measure", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    group = Window.partitionBy("g", "measure")
    below = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn(
        "total", F.sum("n").over(group)
    )

    def quantile(percent: int) -> Column:
        return F.min(F.when(100 * F.col("upto") >= percent * F.col("total"), F.col("bucket")))

    cut = below.groupBy("g", "measure").agg(
        F.max("total").alias("total"), *[quantile(p).alias(f"q{p}") for p in (10, 50, 90)]
    )
    gap = F.create_map(*[x for k, v in LEAST_GAP.items() for x in (F.lit(k), F.lit(v))])[F.col("measure")]
    high = F.col("q90") + F.greatest(REACH * (F.col("q90") - F.col("q50")), gap)
    low = F.when(
        F.col("measure").isin(*LOWER), F.col("q10") - F.greatest(REACH * (F.col("q50") - F.col("q10")), gap)
    )
    return cut.where((F.col("total") >= min_documents) | (F.col("g.level") == 2)).select(
        "g.level", "g.lang", "g.source", "measure", low.cast("long").alias("low"), high.cast("long").alias("high")
    )


def assess(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """measures() with base_failed, the rates, the fences that held (struct per measure), and kept."""
    measured = stored(measures(docs).withColumns({f"{k}_rate": v for k, v in rates().items()}))
    found = thresholds(sketches(measured), min_documents)
    names = list(LEAST_GAP)
    wide = found.groupBy("level", "lang", "source").agg(
        *[
            F.max(F.when(F.col("measure") == k, F.struct("low", "high"))).alias(k)
            for k in names
        ]
    )
    wide = stored(wide)

    def level(n: int, *keys: str) -> DataFrame:
        return wide.where(F.col("level") == n).select(
            *[F.col(k).alias(f"{k}_{n}") for k in keys], *[F.col(k).alias(f"{k}_fence_{n}") for k in names]
        )

    source, lang, everything = level(0, "lang", "source"), level(1, "lang"), level(2)
    joined = (
        measured.join(
            source,
            measured["lang"].eqNullSafe(source["lang_0"]) & measured["source"].eqNullSafe(source["source_0"]),
            "left",
        )
        .join(lang, measured["lang"].eqNullSafe(lang["lang_1"]), "left")
        .join(everything, F.lit(True), "left")
    )
    fences = {f"{k}_fence": F.coalesce(*[F.col(f"{k}_fence_{n}") for n in (0, 1, 2)]) for k in names}
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.lit(True)
    for k in names:
        fence, rate = F.col(f"{k}_fence"), F.col(f"{k}_rate")
        within &= (rate <= fence["high"]) & F.coalesce(rate >= fence["low"], F.lit(True))
    return (
        joined.withColumns(fences)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & within)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            *[f"{k}_rate" for k in names], *[F.col(f"{k}_fence.high").alias(f"{k}_high") for k in names],
        )
    )


def keep(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is kept by assess(); a null doc_id is an id like any other."""
    good = assess(docs, min_documents).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(good["kept_id"]), "left_semi")
