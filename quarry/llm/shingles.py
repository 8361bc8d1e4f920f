"""Word shingles as hashes, in numpy, for the operators that compare passages."""

from __future__ import annotations

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)
FACTOR = np.uint64(0xD6E8FEB86659FD93)
BASE = 0x2545F4914F6CDD1D


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes about half of the output."""
    x = x ^ (x >> np.uint64(32))
    x *= FACTOR
    x ^= x >> np.uint64(32)
    x *= FACTOR
    x ^= x >> np.uint64(32)
    return x


class Words:
    """Hashes of the words of lower-cased texts, a whole text at a time.

    A word hashes to the sum of (number of its byte) x (power of the byte's place): differences of one running sum, moved to
    place 0 by inverse powers. The powers grow with the longest text seen.
    """

    def __init__(self, marks: bool = False) -> None:
        """``marks``: whether ASCII marks are parts of words, or stand between them as blanks do."""
        self.numbers = mixed(np.arange(1, 257, dtype=np.uint64) * STEP)
        self.blank = np.zeros(256, bool)
        self.blank[[32, 9, 10, 11, 12, 13]] = True
        if not marks:
            self.blank[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        size = 1 << max(16, n.bit_length())
        for name, base in (("powers", BASE), ("inverses", pow(BASE, -1, 1 << 64))):
            setattr(self, name, np.cumprod(np.full(size, base, np.uint64)))

    def parts(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word of a text in UTF-8: hash, first byte, byte after the last; and the running sum."""
        data = np.frombuffer(data, np.uint8)
        if len(data) >= len(self.powers):
            self._grow(len(data) + 1)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~self.blank[data]
        edge = np.diff(inside)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.numbers[data] * self.powers[: len(data)], out=running[1:])
        return mixed((running[end] - running[begin]) * self.inverses[begin]), begin, end, running

    def hashes(self, text: str | None) -> np.ndarray:
        return self.parts((text or "").lower().encode("utf-8", "surrogatepass"))[0]


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; fewer words are one run; none gives none."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    total = hashes[: len(hashes) - size + 1].copy()
    for i in range(1, size):
        total *= FACTOR
        total ^= total >> np.uint64(29)
        total += hashes[i : len(hashes) - size + 1 + i]
    return mixed(total)
