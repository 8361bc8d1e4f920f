"""Spelling variants: words that differ from a more frequent word by one edit.

**Words** are maximal runs of letters of texts, A to Z lower-cased, of ``LEAST_LENGTH`` code points or more that occur ``LEAST_COUNT`` times or more.
They are counted per batch of texts first, so that a frequent word is shuffled once per batch.

**Neighbourhoods.** Two words are near if one inserted, deleted or replaced code point makes one of the other. Of a pair, one side generates the
other: the longer word by deletion, and of two of equal length the one whose differing code point is the lower, by replacement with each higher
code point of the alphabet. The edits are made as numbers only: the hash of a word is a sum over its places, so that of an edited word
follows from it in one step.

**Bloom filters.** Edits are probed against filters of the vocabulary, one shard per length (longer words share the last), each of blocks of 512
bits: one part of the hash chooses the block, others ``PROBES`` bits in it. All shards together have at most
``MOST_BYTES`` (or ``BITS`` bits a word if that is less) and are broadcast. Only positive edits become strings; they are shuffled to an
exact join with the vocabulary, which removes false ones. A vocabulary for which the filters are too small makes more false positives, and never loses a pair.

**Forms.** The form of a word is its near word of largest n (of equals the smallest), if that has at least ``RATIO`` times its n. As n grows by
this factor along forms, roots are found by pointer jumping in a few rounds, each a written table.

Defined results: null and empty texts have no words; repeated rows count each; a null doc_id takes part in counts (and ``change`` gets it as None); an empty table gives an empty result; further columns are ignored. Words without a near word have n_near 0, no form, and are their own root.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored
from quarry.llm.shingles import BASE, STEP, mixed

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
BITS, PROBES, MOST_BYTES = 16, 6, 64 * 1024 * 1024
#: Words of this length or longer share a shard.
LAST_SHARD = 40
#: Blocks of a filter that are filled together, and words that one task probes, about.
SEGMENT, WORDS_A_TASK = 64, 10_000
#: Edits that are probed at once; distinct words that are counted before they are passed on.
TOGETHER, COUNTED = 1_000_000, 200_000
BLOCK_BYTES = 64

Change = Callable[[int | None, str], str]


def as_it_is(doc_id: int | None, word: str) -> str:
    return word


def slip(doc_id: int | None, word: str) -> str:
    """One in 97 words of a document (by checksum of id and word) loses a code point."""
    checksum = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if checksum % 97:
        return word
    at = checksum % len(word)
    return word[:at] + word[at + 1 :]


def lower(text: str) -> str:
    """``text`` with A to Z alone lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def vocabulary(docs: DataFrame, change: Change = as_it_is) -> DataFrame:
    """word, n, of all words that are long and frequent enough, written."""
    pattern = re.compile(RUN)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
            )
            total.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in Counter(pattern.findall(lower(text or ""))).items():
                    word = change(doc_id, word)
                    if len(word) >= LEAST_LENGTH:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield flush()
        yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, "word string, n long")
    return stored(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


def places(length: int) -> np.ndarray:
    """The factor of each place of a word."""
    return np.cumprod(np.full(length, BASE, np.uint64))


def coded(words: list[str], length: int) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length).astype(np.uint64)


def number(code: np.ndarray) -> np.ndarray:
    return mixed(code * STEP)


def bit_places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and its places (in columns) in a block."""
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    again = mixed(hashes * STEP)
    return block, np.stack([(again >> np.uint64(9 * n)) & np.uint64(511) for n in range(PROBES)], axis=-1).astype(np.int64)


def shard_of(length: int) -> int:
    return min(length, LAST_SHARD)


class Filters:
    """Blocked Bloom filters by shard: ``blocks`` of each, and all bytes in one array, shard after shard."""

    def __init__(self, words: dict[int, int], most_bytes: int = MOST_BYTES) -> None:
        """``words``: how many there are of each shard."""
        total = sum(words.values()) or 1
        share = min(BITS, 8 * most_bytes / total)
        self.blocks = {shard: max(1, int(n * share / 512)) for shard, n in sorted(words.items())}
        self.first, at = {}, 0
        for shard, blocks in self.blocks.items():
            self.first[shard], at = at, at + blocks
        self.bits = np.zeros(at * BLOCK_BYTES, np.uint8)

    def has(self, hashes: np.ndarray, shard: int) -> np.ndarray:
        if shard not in self.blocks:
            return np.zeros(hashes.shape, bool)
        block, places = bit_places(hashes, self.blocks[shard])
        byte = (self.first[shard] + block)[..., None] * BLOCK_BYTES + (places >> 3)
        return ((self.bits[byte] >> (places & 7).astype(np.uint8)) & 1).all(axis=-1)


def hashed(words: list[str]) -> np.ndarray:
    """The hash of each word."""
    out = np.zeros(len(words), np.uint64)
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        out[at] = mixed((number(coded([words[n] for n in at], length)) * places(length)).sum(axis=1))
    return out


def build_filters(words: DataFrame, most_bytes: int = MOST_BYTES) -> Filters:
    """The filters of a vocabulary; they are filled in tasks, a segment of blocks each, and fit in ``most_bytes`` on the driver."""
    shard = F.least(F.length("word"), F.lit(LAST_SHARD)).cast("int").alias("shard")
    filters = Filters({r["shard"]: r["n"] for r in words.groupBy(shard).agg(F.count(F.lit(1)).alias("n")).collect()}, most_bytes)
    blocks, first = filters.blocks, filters.first

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column("word").to_pylist()
            hashes = hashed(some)
            shards = np.array([shard_of(len(w)) for w in some], np.int64)
            where, bits = np.zeros(len(some), np.int64), np.zeros((len(some), PROBES), np.int64)
            for s in np.unique(shards).tolist():
                at = shards == s
                block, bits[at] = bit_places(hashes[at], blocks[s])
                where[at] = first[s] + block
            flat = np.unique(((where % SEGMENT) * 512)[:, None] + bits + (where // SEGMENT * (SEGMENT * 512))[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat // (SEGMENT * 512), pa.int64()), pa.array(flat % (SEGMENT * 512), pa.int64())], ["segment", "bit"]
            )

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(SEGMENT * 512, bool)
        bits[rows["bit"].to_numpy()] = True
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    placed = words.select("word").mapInArrow(place, "segment long, bit long")
    size = SEGMENT * BLOCK_BYTES
    # All segments together have at most ``most_bytes``.
    for r in placed.groupBy("segment").applyInPandas(fill, "segment long, bits binary").collect():
        part = filters.bits[r["segment"] * size : (r["segment"] + 1) * size]
        part[:] = np.frombuffer(r["bits"], np.uint8)[: len(part)]
    return filters


def edits(words: list[str], length: int, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[int, str]]:
    """(place in ``words``, edited word) of the edits that the filters hold, for words of one length."""
    code = coded(words, length)
    factor = places(length)
    value = number(code)
    terms = value * factor
    whole = terms.sum(axis=1)

    # Deletions: what comes after moves one place down. Of equal neighbours, the first goes.
    back = np.uint64(pow(BASE, -1, 1 << 64))
    after = np.cumsum(terms[:, ::-1], axis=1)[:, ::-1] - terms
    before = whole[:, None] - after - terms
    there = filters.has(mixed(before + after * back), shard_of(length - 1))
    there[:, 1:] &= code[:, 1:] != code[:, :-1]
    for n, at in zip(*np.nonzero(there), strict=True):
        yield n, words[n][:at] + words[n][at + 1 :]

    # Replacements by higher signs.
    new = number(alphabet)
    step = max(1, TOGETHER // (len(words) * len(alphabet)))
    for begin in range(0, length, step):
        part = slice(begin, begin + step)
        n, at, sign = np.nonzero(code[:, part, None] < alphabet)
        at += begin
        there = filters.has(mixed(whole[n] - terms[n, at] + new[sign] * factor[at]), shard_of(length))
        for n, at, sign in zip(n[there].tolist(), at[there].tolist(), sign[there].tolist(), strict=True):
            yield n, words[n][:at] + chr(int(alphabet[sign])) + words[n][at + 1 :]


def near_words(words: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """word, n, other, other_n: all pairs of near words, each in both directions, written."""
    context = words.sparkSession.sparkContext
    signs = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("s")).where("s <> ''").distinct()
    # Words have letters of a fixed set of some 90 signs.
    alphabet = np.array(sorted(ord(r["s"]) for r in signs.collect()), np.uint64)
    shared = context.broadcast((build_filters(words, most_bytes), alphabet))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, alphabet = shared.value
        for batch in batches:
            by_length: dict[int, list[int]] = {}
            every, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            for n, word in enumerate(every):
                by_length.setdefault(len(word), []).append(n)
            for length, members in by_length.items():
                some = max(1, TOGETHER // (length * max(1, len(alphabet))))
                for begin in range(0, len(members), some):
                    part = members[begin : begin + some]
                    found = list(edits([every[n] for n in part], length, alphabet, filters))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([every[part[n]] for n, _ in found], pa.string()),
                            pa.array([counts[part[n]] for n, _ in found], pa.int64()),
                            pa.array([w for _, w in found], pa.string()),
                        ],
                        ["word", "n", "other"],
                    )

    # Every word costs about as many probes as it has signs times half the alphabet, so the table is dealt by rows, not bytes.
    dealt = words.repartition(max(1, -(-words.count() // WORDS_A_TASK)), "word")
    positive = dealt.mapInArrow(probe, "word string, n long, other string")
    pairs = stored(positive.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other"))
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.select("word", "n", "other", "other_n").unionByName(turned)


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): forms followed to the last, by jumps of double length."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        longer = stored(longer)
        moved = longer.where("moved").limit(1).count()
        at = longer.drop("moved")
        if not moved:
            return at


def variants(docs: DataFrame, change: Change = as_it_is, most_bytes: int = MOST_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n for all words of the vocabulary."""
    words = vocabulary(docs, change)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_words(words, most_bytes).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    all_words = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= RATIO * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("f"),
    )
    all_words = stored(all_words.select("word", "n", "n_near", "f.form", "f.form_n"))
    root = roots(all_words.where("form IS NOT NULL"))
    return all_words.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
