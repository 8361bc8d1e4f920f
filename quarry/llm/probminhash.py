"""Near-duplicate documents by ProbMinHash, banding and exact verification.

**Shingles** are runs of five words of the lower-cased text. Words are runs without blanks and ASCII marks; since an edit may
also change marks, two texts are compared with and without marks as parts of words, and the larger similarity holds.

**Sketches.** The shingles without marks, and those with marks where they differ, have weight 1, so that candidates are found by
the similarities that links have; where shingles are repeated, a third sketch gives those without marks 1 + ln(occurrences). Each
shingle is a Poisson process whose
rate is its weight; an arrival falls into one of ``REGISTERS`` registers by chance, and a register keeps the shingle that came
first. Two texts agree in a register with the probability Jaccard similarity of their weights, which is the plain Jaccard
similarity where each text has equal weights. Arrivals are drawn only up to a time at which all registers are filled (early
termination; if one is empty, up to twice that time), so a sketch costs about m ln m arrivals, however long the text.

**Candidates.** Registers are cut into bands; texts that agree in a whole band, of any of their sketches, are candidates. Exact copies are one node from
the start.

**Representatives.** The representative of a crowded band value is the member with most company in all its bands: the original
of a group of edited copies rather than one of the copies. Every member is compared with the representatives of its bands on the whole
texts (``verified``: sorted so that a representative comes before its members; one with many is repeated for parts of them). A pair is a
link if the Jaccard similarity of its five-word shingles is 0.8 or more. A member keeps one membership; a further
representative of the same member gives one pair of representatives. So links are at most the texts and the pairs of representatives.

**Left over** are the members of a band value that, its representative aside, are not in one class yet. Among them the candidates are found exactly,
without pairs of a whole group: of two sets x and y (x the larger) with similarity s, the rarest shingle both
have comes early in both, at most (|x| + |y|) s / (1 + s) before the end. So only those rare prefixes are joined, by shingle and by the
sizes that a partner of a shingle at this place may have (in steps of two in a hundred). A copy with too many shingles of its own meets nobody, however large
its group. What remains is compared on the whole texts again.

**Classes** are connected components: of the pairs of representatives, then of the classes that left-over links join. The least label
spreads over links, with pointer jumping, each round a written table.

Scale: texts are shuffled only if they have company (a sieve of at most ``SIEVE`` numbers goes to all workers and lets no other
text pass to the shuffle, but for rare collisions); everything kept between steps is a table in the shared folder.

Defined results: null text counts as empty; equal texts (also empty ones) are one class; texts of one to four words are one
shingle; a null doc_id is carried along, and is the class only if the class has no other id; repeated rows are in one
class; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored, text_key, text_or_empty
from quarry.llm.shingles import STEP, Words, mixed, shingle_hashes

WORDS_IN_SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 4, 24
REGISTERS = ROWS * BANDS
#: Members, and characters, that are compared with one copy of their representative's text, about.
PIECE, PIECE_CHARS = 400, 8_000_000
SIEVE = 1 << 20
#: Arrivals are drawn until a time by which a register is empty with probability exp(-SURE) / REGISTERS.
SURE = 2.5
#: Arrivals that are drawn at once, about (some ten numbers of 8 bytes each); a long text has more, by itself.
TOGETHER = 200_000
#: A text has about this many arrivals, and one more for each shingle.
ARRIVALS = int(REGISTERS * (np.log(REGISTERS) + SURE))
#: Sizes of shingle sets are joined in steps of this ratio.
SIZE_STEP = 1.02


def weighted_shingles(text: str | None, known: Words) -> tuple[np.ndarray, np.ndarray]:
    found, times = np.unique(shingle_hashes(known.hashes(text), WORDS_IN_SHINGLE), return_counts=True)
    return found, 1.0 + np.log(times)


def prob_min_hash(texts: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """For each (shingles, weights), none of them empty, a row with the shingle that arrives first in each register."""
    shingles, weights = (np.concatenate(x) for x in zip(*texts, strict=True))
    owner = np.repeat(np.arange(len(texts)), [len(x) for x, _ in texts])
    until = registers * (np.log(registers) + SURE) / np.array([w.sum() for _, w in texts])
    first = np.zeros(len(texts) * registers, np.int64)
    best = np.full(len(texts) * registers, np.inf)
    active, now, drawn = np.arange(len(shingles)), np.zeros(len(shingles)), np.zeros(len(shingles), np.int64)
    while len(active):
        # About as many arrivals as come before the end, for all shingles that are not there yet.
        count = ((until[owner[active]] - now[active]) * weights[active]).astype(np.int64) + 1
        ends = np.cumsum(count)
        begins = ends - count
        which = np.repeat(active, count)
        nth = np.arange(ends[-1]) - np.repeat(begins - drawn[active], count) + 1
        bits = mixed(shingles[which] + nth.astype(np.uint64) * STEP)
        gap = np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / -weights[which]
        at = np.cumsum(gap)
        at += np.repeat(now[active] - (at[begins] - gap[begins]), count)
        now[active], drawn[active] = at[ends - 1], drawn[active] + count
        # The bits that the time leaves over choose the register.
        cell = ((bits & np.uint64(0x7FF)) * np.uint64(registers) >> np.uint64(11)).astype(np.int64)
        cell += owner[which] * registers
        before = best[cell]
        np.minimum.at(best, cell, at)
        wins = (at == best[cell]) & (at < before)
        first[cell[wins]] = which[wins]
        active = active[now[active] < until[owner[active]]]
        while not len(active):
            # What came before the end is settled; texts with a register that had nothing go on to twice the time.
            late = (best.reshape(len(texts), registers) > until[:, None]).any(axis=1)
            if not late.any():
                break
            until[late] *= 2
            active = np.flatnonzero(late[owner] & (now < until[owner]))
    return shingles[first].reshape(len(texts), registers)


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """One hash per band of each signature (a row), different for different bands."""
    bands = signatures.reshape(-1, BANDS, ROWS)
    total = np.tile(np.arange(BANDS, dtype=np.uint64) * STEP, (len(bands), 1))
    for i in range(ROWS):
        total = mixed(total + bands[:, :, i])
    return total.view(np.int64)


def shingle_sets(text: str | None, known: Words, marked: Words) -> tuple[np.ndarray, np.ndarray]:
    """The sorted five-word shingles of a text without and with marks."""
    return tuple(np.unique(shingle_hashes(w.hashes(text), WORDS_IN_SHINGLE)) for w in (known, marked))


def variants(text: str | None, known: Words, marked: Words) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[int, int]]:
    """The (shingles, weights) of a text that are sketched, and how many shingles it has without and with marks."""
    found, weights = weighted_shingles(text, known)
    every = [(found, np.ones(len(found)))]
    if (weights > 1).any():
        every.append((found, weights))
    with_marks = np.unique(shingle_hashes(marked.hashes(text), WORDS_IN_SHINGLE))
    if not np.array_equal(found, with_marks):
        every.append((with_marks, np.ones(len(with_marks))))
    return [x for x in every if len(x[0])], (len(found), len(with_marks))


def _signatures(found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return band_hashes(prob_min_hash(found)) if found else np.zeros((0, BANDS), np.int64)


def _bands(texts: Iterator[str | None], known: Words, marked: Words) -> Iterator[tuple[np.ndarray, int, int]]:
    """For each text: its bands (each once), and how many shingles it has without and with marks."""
    waiting, found, cost = [], [], 0

    def flush() -> Iterator[tuple[np.ndarray, int, int]]:
        hashes = _signatures(found)
        at = 0
        for n, *sizes in waiting:
            yield np.unique(hashes[at : at + n]), *sizes
            at += n
        waiting.clear(), found.clear()

    for text in texts:
        each, sizes = variants(text, known, marked)
        more = sum(ARRIVALS + len(x) for x, _ in each)
        if cost + more > TOGETHER:
            yield from flush()
            cost = 0
        waiting.append((len(each), *sizes))
        found.extend(each)
        cost += more
    yield from flush()


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, marked = Words(), Words(marks=True)
    for batch in batches:
        rows = list(_bands((text.as_py() for text in batch.column("text")), known, marked))
        ends = np.cumsum([0, *(len(r[0]) for r in rows)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *(r[0] for r in rows)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("key"),
                batch.column("n_chars"),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            ["doc_id", "key", "n_chars", "bands", "plain", "marked"],
        )


def nodes(docs: DataFrame) -> DataFrame:
    """node, key, doc_id (least), n_chars, bands, plain, marked (shingles without and with marks): one row per distinct text, written."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), text_or_empty().alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))
    sketches = rows.mapInArrow(_sketch_batches, "doc_id long, key binary, n_chars long, bands array<long>, plain long, marked long")
    one = sketches.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first(F.struct("n_chars", "bands", "plain", "marked")).alias("s"))
    # The number of a node is fixed once it is written.
    return stored(one.select(F.monotonically_increasing_id().alias("node"), "key", "doc_id", "s.*"))


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that links lead to, for every node that has a link."""
    edges = stored(
        links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select(F.col("e.a").alias("node"), F.col("e.b").alias("other"))
        .distinct()
    )
    labels = stored(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    total = None
    while True:
        # A label is taken over from the neighbours, then from the node that the label names.
        near = edges.join(labels.select(F.col("node").alias("other"), "label"), "other")
        least = (
            near.select("node", "label").unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        )
        least = stored(least)
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = stored(
            least.join(jump, "label", "left").select(
                "node", F.least("label", F.coalesce("further", "label")).alias("label")
            )
        )
        # Labels only ever fall: the same sum means that nothing changed.
        seen = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if seen == total or seen is None:
            return labels
        total = seen


def alike(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether two texts, given by ``shingle_sets``, are similar without or with marks."""
    for a, b in zip(x, y, strict=True):
        less, more = sorted((len(a), len(b)))
        # both >= SIMILARITY * union, in whole numbers of a hundredth.
        if not less or 100 * less < round(100 * SIMILARITY) * more:
            continue
        both = len(np.intersect1d(a, b, assume_unique=True))
        if 100 * both >= round(100 * SIMILARITY) * (less + more - both):
            return True
    return False


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from rows sorted by (a, part): first that of a itself (b null), then those of its members."""
    known, marked = Words(), Words(marks=True)
    head, of = None, None
    for batch in batches:
        found = []
        for a, part, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "b", "text")), strict=True):
            sets = shingle_sets(text, known, marked)
            if b is None:
                head, of = sets, (a, part)
            elif of != (a, part):
                raise RuntimeError("a member came without its representative")
            elif alike(head, sets):
                found.append((a, b))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[n] for x in found], pa.int64()) for n in (0, 1)], ["a", "b"]
        )


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the distinct (a, b) whose texts (node, n_chars, text) are similar, written; an a may have any number of b."""
    lengths = texts.select(F.col("node").alias("b"), "n_chars")
    load = pairs.join(lengths, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    parts = F.greatest(F.ceil(F.col("n") / PIECE), F.ceil(F.col("chars") / PIECE_CHARS), F.lit(1)).cast("int")
    load = stored(load.select("a", parts.alias("parts")))
    members = (
        pairs.join(load, "a")
        .withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
        .join(texts.select(F.col("node").alias("b"), "text"), "b")
        .select("a", "part", "b", "text")
    )
    heads = (
        load.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(texts.select(F.col("node").alias("a"), "text"), "a")
        .select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    )
    dealt = members.unionByName(heads).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return stored(dealt.mapInArrow(_compare_batches, "a long, b long"))


def _prefix_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, marked = Words(), Words(marks=True)
    for batch in batches:
        rows = [shingle_sets(text.as_py(), known, marked) for text in batch.column("text")]
        columns = []
        for n in (0, 1):
            ends = np.cumsum([0, *(len(r[n]) for r in rows)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *(r[n] for r in rows)]).view(np.int64)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("label"), *columns], ["node", "label", "plain", "marked"])


def prefix_pairs(texts: DataFrame) -> DataFrame:
    """Distinct (a, b) of (node, label, text) with unlike labels, among them every similar pair, by rare prefixes."""
    sets = stored(texts.select("node", "label", "text").mapInArrow(
        _prefix_sets, "node long, label long, plain array<long>, marked array<long>"
    ))
    each = sets.select(
        "node", "label", F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(c).alias("s")) for n, c in enumerate(("plain", "marked"))])).alias("k")
    ).select("node", "label", "k.kind", F.size("k.s").cast("long").alias("size"), F.explode("k.s").alias("shingle"))
    often = stored(each.groupBy("kind", "shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    # The similarity as a fraction num / den.
    num, den = round(100 * SIMILARITY), 100
    size = F.col("size")
    spare = size - F.ceil(size * num / den).cast("long") + 1
    ranked = (
        each.join(often, ["kind", "shingle"])
        .groupBy("node", "label", "kind", "size")
        .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("rare"))
        # What no other text has comes first in the order and needs no row.
        .withColumn("own", size - F.size("rare"))
        .select("node", "label", "kind", "size", "own", F.posexplode(F.slice("rare", 1, F.greatest(spare - F.col("own"), F.lit(0)).cast("int"))).alias("n", "r"))
        .select("node", "label", "kind", "size", (F.col("own") + F.col("n")).alias("at"), F.col("r.shingle").alias("shingle"))
    )
    ranked = stored(ranked)
    step = lambda c: F.floor(F.log(c.cast("double")) / F.log(F.lit(SIZE_STEP))).cast("int")
    # What two sets must share: (|x| + |y|) num / (num + den), which leaves this most for |y| at a place of x.
    most = F.floor(((size - F.col("at")) * (num + den) - size * num) / num).cast("long")
    larger = (
        ranked.withColumn("low", F.ceil(size * num / den).cast("long"))
        .withColumn("high", F.least(size, most))
        .where("low <= high")
        .select("kind", "shingle", F.col("node").alias("a"), F.col("label").alias("label_a"), F.col("size").alias("size_a"), "low", "high", F.explode(F.sequence(step(F.col("low")), step(F.col("high")))).alias("step"))
    )
    smaller = ranked.where((size - F.col("at")) * (num + den) >= 2 * num * size).select(
        "kind", "shingle", F.col("node").alias("b"), F.col("label").alias("label_b"), F.col("size").alias("size_b"), F.col("at").alias("at_b"), step(size).alias("step")
    )
    fits = (
        (F.col("label_a") != F.col("label_b"))
        & F.col("size_b").between(F.col("low"), F.col("high"))
        & ((F.col("size_a") > F.col("size_b")) | (F.col("a") > F.col("b")))
        & ((F.col("size_b") - F.col("at_b")) * (num + den) >= num * (F.col("size_a") + F.col("size_b")))
    )
    return larger.join(smaller, ["kind", "shingle", "step"]).where(fits).select("a", "b").distinct()


def joined(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From verified (a, b) with representatives a: (node, head), one membership for each b, and pairs of heads that a b or a link joins."""
    of = links.groupBy("b").agg(F.sort_array(F.collect_set("a")).alias("heads"))
    of = stored(of)
    members = of.select(F.col("b").alias("node"), F.col("heads")[0].alias("head"))
    ties = of.select(F.col("heads")[0].alias("a"), F.explode(F.slice("heads", 2, F.greatest(F.size("heads") - 1, F.lit(0)))).alias("b"))
    # A head that is itself a member is tied to its own head.
    heads = of.select(F.explode("heads").alias("node")).distinct()
    own = members.join(heads, "node").select(F.col("head").alias("a"), F.col("node").alias("b"))
    return members, stored(ties.unionByName(own).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes(docs); (node, label), label a node of the same class, for those in a class of two or more; the left-over links (a, b)."""
    every = nodes(docs)
    banded = every.select("node", F.explode("bands").alias("band"))
    crowds = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = stored(banded.join(crowds, "band"))
    company = stored(crowded.groupBy("node").agg(F.sum("n").alias("company")))
    first = F.max(F.struct("company", (-F.col("node")).alias("last"))).alias("first")
    heads = stored(crowded.join(company, "node").groupBy("band").agg(first).select("band", (-F.col("first.last")).alias("head")))
    placed = stored(crowded.join(heads, "band").where("node <> head").select("band", "head", "node"))

    which = F.pmod(F.xxhash64("key", "doc_id"), F.lit(SIEVE))
    needed = stored(company.join(every.drop("bands"), "node").withColumn("which", which))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), text_or_empty().alias("text"))
    # At most SIEVE numbers.
    passed = rows.join(F.broadcast(needed.select("which").distinct()), which == F.col("which"), "left_semi")
    texts = stored(
        passed.select("key", "text").join(needed.select("node", "key", "n_chars"), "key").dropDuplicates(["node"])
    ).select("node", "n_chars", "text")

    sizes = needed.select("node", "plain", "marked")
    pairs = placed.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    sized = pairs.join(sizes.toDF("a", "plain_a", "marked_a"), "a").join(sizes.toDF("b", "plain_b", "marked_b"), "b")
    near = lambda c: 100 * F.least(f"{c}_a", f"{c}_b") >= round(100 * SIMILARITY) * F.greatest(f"{c}_a", f"{c}_b")
    members, ties = joined(verified(stored(sized.where(near("plain") | near("marked")).select("a", "b")), texts))
    tied = components(ties)
    main = members.select(F.col("head").alias("node")).distinct().join(tied, "node", "left_anti")
    heads = stored(tied.unionByName(main.withColumn("label", F.col("node"))))
    own = members.join(heads.withColumnRenamed("node", "head"), "head").select("node", "label")
    label = stored(heads.unionByName(own).distinct())

    seen = placed.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_bands = seen.groupBy("band").agg(F.min("label").alias("one"), F.max("label").alias("other")).where("one <> other")
    left = stored(seen.join(open_bands.select("band"), "band").select("node", "label").distinct())
    later = verified(stored(prefix_pairs(left.join(texts, "node"))), texts)
    # Left-over links join whole classes.
    side = lambda c: left.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}"))
    between = later.join(side("a"), "a").join(side("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()
    whole = components(between).withColumnRenamed("label", "whole").withColumnRenamed("node", "label")
    alone = left.join(label, "node", "left_anti").select("node", "label")
    final = label.unionByName(alone).join(whole, "label", "left").select("node", F.coalesce("whole", "label").alias("label"))
    return every, stored(final), later


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), class_id (least doc_id of the class), kept_key (text of the row that stays)."""
    every, label, _ = links(docs)
    labelled = every.join(label, "node", "left").select(
        "key", "doc_id", F.coalesce("label", "node").alias("label")
    )
    labelled = stored(labelled)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    heads = stored(labelled.groupBy("label").agg(first).select("label", "first.doc_id", F.col("first.key").alias("kept_key")))
    by_key = stored(
        labelled.select("key", "label").join(heads.withColumnRenamed("doc_id", "class_id"), "label").drop("label")
    )
    members = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    return members.join(by_key, "key").select("doc_id", "key", "class_id", "kept_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class: that of the least doc_id; of repeated rows, one."""
    row_key = lambda i, k: F.unhex(F.md5(F.concat_ws(":", F.hex(k), i.cast("string"))))
    kept = classes(docs).where("key = kept_key and doc_id <=> class_id")
    wanted = stored(kept.select(row_key(F.col("doc_id"), F.col("key")).alias("__row")).distinct())
    marked = docs.withColumn("__row", row_key(F.col("doc_id").cast("long"), text_key()))
    return marked.join(wanted, "__row").dropDuplicates(["__row"]).drop("__row")
