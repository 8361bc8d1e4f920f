"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources in order of code points, null last, have weights that repeat a given cycle, and share all words; a
target stops at ``MAX_COPIES`` times the words of its source and the excess is shared by weight among the others until none
is above. With the sources ordered by the share at which they are full, that is one running sum (water filling).

Sampling: a source whose target is r times its words takes every document floor(r) times for certain. The rest is an
unequal-probability sample: each document has inclusion odds, those of the remaining share times its own weight, and a
uniform number from a hash of its row; documents are ranked by the odds of the uniform number divided by the inclusion
odds, and taken in that order while their words fit into what remains. One more document, that which comes nearest to the
gap left, closes the sample, if it brings the words nearer to the target.

Scale: the order within a source is never sorted in one task. Documents fall into about sqrt(n) ranges of their rank; the
words of the ranges are added up, and only the range in which the target is reached is put in order. The tables of sources
and ranges are written first, so that Spark knows their size when it joins them.

Defined results: null or blank text has size 0 and takes 0 words; null source is a source of its own; null doc_id hashes like
a value; repeated rows are numbered, and each is taken or not by itself; ties in rank go by doc_id; an empty table
gives an empty result; further columns are ignored. Reruns agree, since the random numbers are hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import WORD, row_key, stored, text_or_empty

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Passes over the ranked documents; each takes up those that fit into what the pass before left.
PASSES = 3
SEED = 20240229


def source_key(source: Column) -> Column:
    """A key without nulls: '0' and the name, or '1' for null, which sorts last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source_key, source_size, n_docs, target, from rows (source_key, size). One row per source passes the window."""
    per = stored(
        sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    )
    place = F.row_number().over(Window.orderBy("source_key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    fill = (max_copies * F.col("source_size")) / F.col("weight")
    weighed = per.withColumn("weight", weight).withColumn("fill", fill)
    # Sources in the order in which they are full: those before it are at their limit, the rest share by weight.
    before = Window.orderBy("fill", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = weighed.withColumns(
        {
            "level": (
                F.sum("source_size").over(whole) - F.coalesce(F.sum(max_copies * F.col("source_size")).over(before), F.lit(0))
            )
            / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        }
    ).withColumn("open", F.col("level") < F.col("fill"))
    # Once a source is open, all later ones are, at the level of the first open one.
    held = F.min(F.when(F.col("open"), F.struct("fill", "source_key", "level"))).over(whole)["level"]
    limit = (max_copies * F.col("source_size")).cast("double")
    return level.withColumn("held", held).select(
        "source_key",
        "source_size",
        "n_docs",
        F.when(F.col("held").isNull() | (F.col("held") >= F.col("fill")), limit)
        .otherwise(F.col("held") * F.col("weight"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    odds_weight: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, row_key, size, source_size, target, taken, copies.

    ``odds_weight``: a Column over doc_id, text, size that multiplies a document's inclusion odds; 1 if not given.
    """
    text = text_or_empty()
    sized = docs.select(
        "doc_id", row_key(docs).alias("row_key"), source_key(F.col("source")).alias("source_key"), text.alias("text")
    ).select(
        "doc_id",
        "row_key",
        "source_key",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"),
        (F.lit(1.0) if odds_weight is None else odds_weight.cast("double")).alias("w"),
    )
    # Repeated rows are told apart by a number of their own, so that no two rows have one rank.
    again = Window.partitionBy("row_key").orderBy("size")
    sized = sized.withColumn("again", F.row_number().over(again))
    # 52 bits of a hash, in the middle of their step: never 0 or 1.
    bits = F.shiftrightunsigned(F.xxhash64("row_key", "again", F.lit(seed)), 12)
    sized = stored(sized.withColumn("u", (bits + 0.5) / float(1 << 52)))

    full = F.col("source_size") > 0
    aims = targets(sized, weights, max_copies)
    aims = aims.withColumn("whole", F.when(full, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    aims = aims.withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    aims = stored(aims.withColumn("share", F.when(full, F.col("rest") / F.col("source_size")).otherwise(F.lit(0.0))))

    odds = F.col("u") / (1 - F.col("u"))
    inclusion = F.col("w") * F.col("share") / (1 - F.col("share"))
    # Without weights the odds of the rank, times those of the share, are u again: ranges of it are about equal.
    even = F.col("rank") * F.col("share") / (1 - F.col("share"))
    ranked = (
        sized.join(aims, "source_key")
        .withColumn("rank", F.when((F.col("share") > 0) & (F.col("size") > 0), odds / inclusion))
        .withColumn("part", F.floor(even / (1 + even) * F.ceil(F.sqrt("n_docs"))))
    )
    ranked = ranked.withColumn("me", F.struct("rank", "doc_id", "row_key", "again"))
    taken = F.lit(False)
    state = aims.select("source_key", F.col("rest").alias("gap_0"))
    for n in range(PASSES):
        open_rows = ranked.join(state, "source_key").where(F.col("rank").isNotNull() & ~taken & (F.col("size") <= F.col(f"gap_{n}")))
        state = stored(state.join(_fill(open_rows, f"gap_{n}", n), "source_key", "left"))
        state = state.withColumn(f"gap_{n + 1}", F.col(f"gap_{n}") - F.coalesce(f"words_{n}", F.lit(0)))
        fits = (F.col("size") <= F.col(f"gap_{n}")) & F.coalesce(F.col("me") < F.col(f"stop_{n}"), F.lit(True))
        taken = taken | fits
    chosen = ranked.join(state, "source_key").withColumn("by_rank", F.col("rank").isNotNull() & taken)
    gap = F.col(f"gap_{PASSES}")
    miss = F.abs(gap - F.col("size"))
    closing = stored(
        chosen.where(~F.col("by_rank") & F.col("rank").isNotNull() & (miss < gap))
        .groupBy("source_key")
        .agg(F.min(F.struct(miss.alias("miss"), "me")).alias("c"))
        .select("source_key", F.col("c.me").alias("closing"))
    )
    closes = F.coalesce(F.col("me") == F.col("closing"), F.lit(False))
    copies = F.col("whole") + (F.col("by_rank") | closes).cast("long")
    return chosen.join(closing, "source_key", "left").select(
        "doc_id",
        "row_key",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).alias("taken"),
        copies.alias("copies"),
    )


def _fill(rows: DataFrame, gap: str, n: int) -> DataFrame:
    """Per source: stop_n, the first row in order of rank that no longer fits into the gap (null if all do), and words_n before it."""
    so_far = Window.partitionBy("source_key").orderBy("part")
    parts = (
        rows.groupBy("source_key", "part")
        .agg(F.sum("size").alias("words"), F.first(gap).alias("gap"))
        .withColumn("upto", F.sum("words").over(so_far))
    )
    over = F.col("upto") > F.col("gap")
    # The first range that does not fit whole, and the words of the ranges before it.
    edge = stored(
        parts.groupBy("source_key").agg(
            F.min(F.when(over, F.struct("part", (F.col("upto") - F.col("words")).alias("before")))).alias("e"),
            F.sum("words").alias("all"),
        )
    )
    order = Window.partitionBy("source_key").orderBy("me").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.join(edge, "source_key").where(F.col("part") == F.col("e.part"))
    inside = inside.withColumn("upto", F.col("e.before") + F.sum("size").over(order))
    cut = (
        inside.where(F.col("upto") > F.col(gap))
        .groupBy("source_key")
        .agg(F.min(F.struct("me", (F.col("upto") - F.col("size")).alias("words"))).alias("c"))
    )
    return edge.join(cut, "source_key", "left").select(
        "source_key", F.col("c.me").alias(f"stop_{n}"), F.coalesce("c.words", "all").alias(f"words_{n}")
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    counts = mix(docs, **options).groupBy("row_key").agg(F.sum("copies").alias("n")).where("n > 0")
    counts = stored(counts.select(F.col("row_key").alias("__row"), F.col("n").alias("__n")))
    marked = docs.withColumn("__row", row_key(docs))
    # Rows that are alike count together and are one row here, which comes as often as all of them.
    one = marked.join(counts, "__row").dropDuplicates(["__row"])
    return one.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*docs.columns)
