"""Token ids in packed matrices by best-fit-decreasing.

Texts are tokenized with a public byte-level vocabulary (its file is a parameter, read once by the driver and sent to the
workers) and packed into rows of ``LENGTH`` ids. A text longer than a row is cut into whole rows and a rest; rests and shorter texts are
placed, longest first, into the row with the least room that still holds them. A segment tree over the amounts of room
finds that row in log(LENGTH) steps.

A row holds the ids and the positions as little-endian 16-bit numbers (``matrix`` makes arrays of them), the cumulative segment
lengths, and for each segment the document, where in the document's ids it starts, and the place where positions begin again
at 0. ``unpack`` puts every document together again.

Packing works on the rows of a task, some millions of ids at a time, so nothing is shuffled and memory does not grow with the
table; a lost task repeats exactly.

Defined results: null and empty texts have no ids and are in no row; repeated rows are packed each; texts of one length
keep their order; an empty table gives no rows; a null doc_id is carried as null; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
#: Ids that are packed together in a task, about.
BLOCK_IDS = 4_000_000
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: An id that the vocabulary leaves free.
PADDING = 50256
# Fixed value: how the vocabulary's texts were cut before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

ROWS = (
    "ids binary, positions binary, n_tokens int, cu_seqlens array<int>, doc_ids array<long>, starts array<int>, "
    "resets array<int>"
)


class RoomTree:
    """A segment tree over amounts of room: which amounts some row has left."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def least(self, need: int) -> int:
        """The least room that holds ``need``, or -1."""
        count, at = self.count, need + self.size
        if count[at]:
            return need
        # Up to where a right sibling has rows, then down along the left.
        while at > 1:
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.size:
                    at *= 2
                    if not count[at]:
                        at += 1
                return at - self.size
            at >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of places in ``lengths``; every length is at most the capacity."""
    rows: list[list[int]] = []
    tree, with_room = RoomTree(capacity), [[] for _ in range(capacity + 1)]
    for n in sorted(range(len(lengths)), key=lambda n: -lengths[n]):
        size = lengths[n]
        room = tree.least(size)
        if room < 0:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = with_room[room].pop()
            tree.add(room, -1)
        rows[row].append(n)
        if room > size:
            with_room[room - size].append(row)
            tree.add(room - size, 1)
    return rows


def pack(texts: list[tuple[int | None, np.ndarray]], length: int = LENGTH) -> Iterator[tuple]:
    """Rows as in ``ROWS`` from (doc_id, ids)."""
    pieces = [(doc, start, ids[start : start + length]) for doc, ids in texts for start in range(0, len(ids), length)]
    for row in best_fit_decreasing([len(p[2]) for p in pieces], length):
        parts = [pieces[n] for n in row]
        ends = np.cumsum([0, *(len(p[2]) for p in parts)])
        ids = np.full(length, PADDING, "<u2")
        ids[: ends[-1]] = np.concatenate([p[2] for p in parts])
        positions = np.zeros(length, "<u2")
        positions[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
        yield (
            ids.tobytes(), positions.tobytes(), int(ends[-1]), ends.tolist(),
            [p[0] for p in parts], [p[1] for p in parts], ends[:-1].tolist(),
        )


def read_vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_encoders: dict[bytes, tiktoken.Encoding] = {}


def encoder(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """One encoder per worker and vocabulary."""
    digest = hashlib.sha256()
    for piece, n in sorted(ranks.items()):
        digest.update(f"{n}:{len(piece)}:".encode() + piece)
    key = digest.digest()
    if key not in _encoders:
        _encoders[key] = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def packed(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """Rows of packed ids of all documents."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    if max(ranks.value.values()) >= PADDING or not 0 < length < 1 << 16:
        raise ValueError("ids and positions must fit into 16 bits, with the padding free")
    schema = pa.schema(
        [
            ("ids", pa.binary()), ("positions", pa.binary()), ("n_tokens", pa.int32()), ("cu_seqlens", pa.list_(pa.int32())),
            ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("resets", pa.list_(pa.int32())),
        ]
    )

    def rows(texts: list) -> Iterator[pa.RecordBatch]:
        made = list(pack(texts, length))
        for begin in range(0, len(made), 1000):
            part = zip(*made[begin : begin + 1000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(part, schema, strict=True)], schema=schema
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, waiting, n = encoder(ranks.value).encode_ordinary, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not (text := text.as_py()):
                    continue
                ids = np.array(encode(text), "<u2")
                waiting.append((doc_id.as_py(), ids))
                n += len(ids)
                if n >= BLOCK_IDS:
                    yield from rows(waiting)
                    waiting, n = [], 0
        if waiting:
            yield from rows(waiting)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, ROWS)


def unpack(rows: DataFrame) -> DataFrame:
    """doc_id, start, ids (binary): the segments again, in the order of whose start a document's ids are whole."""
    at = F.posexplode("doc_ids").alias("n", "doc_id")
    begin, end = F.get("cu_seqlens", F.col("n")), F.get("cu_seqlens", F.col("n") + 1)
    return rows.select("ids", "cu_seqlens", "starts", at).select(
        "doc_id", F.get("starts", F.col("n")).alias("start"), F.substring("ids", 2 * begin + 1, 2 * (end - begin)).alias("ids")
    )


def matrix(ids: list[bytes]) -> np.ndarray:
    """Packed binary cells as a matrix."""
    return np.stack([np.frombuffer(x, "<u2") for x in ids])
