"""A deterministic text encoder that needs no service: signed hashing of words."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import spaced_words

# Words that are looked at once, and numbers of vectors that are summed at once (8 bytes each).
MAX_WORDS = 200_000
MAX_CELLS = 500_000

# Words of which a worker keeps the hash.
KEPT_WORDS = 50_000


@functools.lru_cache(KEPT_WORDS)
def _word_hash(word: str) -> int:
    """The first 10 hex digits of a word's MD5."""
    return int.from_bytes(hashlib.md5(word.encode()).digest()[:5], "big")


def hash_vectors(tokens: pa.Array, dimensions: int, normalize: bool = True) -> pa.Array:
    """The vectors of lists of words, some rows and some words at a time, so that memory does not grow with the batch."""
    step = max(1, MAX_CELLS // dimensions)
    found = [_vectors(tokens.slice(at, step), dimensions, normalize) for at in range(0, len(tokens), step)]
    values = pa.array(np.concatenate(found) if found else np.zeros(0, "float32"))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(tokens) + 1, dtype="int32") * dimensions), values)


def _vectors(tokens: pa.Array, dimensions: int, normalize: bool) -> np.ndarray:
    lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    row, flat = np.repeat(np.arange(len(tokens)), lengths), tokens.flatten()
    total = np.zeros(len(tokens) * dimensions)
    for at in range(0, len(flat), MAX_WORDS):
        coded = flat.slice(at, MAX_WORDS).dictionary_encode()
        hashes = np.array([_word_hash(w) for w in coded.dictionary.to_pylist()], dtype="int64")
        place = (hashes >> 8) % dimensions
        sign = np.where(hashes & 0x80, -1.0, 1.0)
        code = coded.indices.to_numpy()
        np.add.at(total, row[at : at + MAX_WORDS] * dimensions + place[code], sign[code])
    total = total.reshape(len(tokens), dimensions)
    if normalize:
        size = np.sqrt((total**2).sum(axis=1, keepdims=True))
        total = np.divide(total, size, out=np.zeros_like(total), where=size != 0)
    return total.astype("float32").ravel()


def hash_embedding(text: Column, dimensions: int = 1024, normalize: bool = True) -> Column:
    """Each word adds +1 or -1 to one of ``dimensions`` places; the sum is scaled to length 1.

    Place: the first 8 hex digits of the word's MD5, modulo ``dimensions``; sign: minus
    from hex digit 8 upwards in the ninth place.  Words are found in the JVM, come as one text a row, and stay in Arrow; of
    each run of words the distinct ones are hashed once.
    """

    @F.arrow_udf("array<float>")
    def embed(spaced: pa.Array) -> pa.Array:
        return hash_vectors(pc.split_pattern(spaced, " "), dimensions, normalize)

    return embed(spaced_words(F.coalesce(text, F.lit(""))))
