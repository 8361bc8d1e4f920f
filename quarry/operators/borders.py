"""Where a group of elements ends: the one place that states the grouping rules.

A group is fixed by a *node* ``(start, overlap)``: its first element and how many
tokens it repeats from the group before.  ``Grouping.close`` finds the next node.
Only numbers come here (tokens, kinds and, for similarity grouping, vectors); texts
stay in the JVM.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT, TITLE, ALONE = 0, 1, 2

# Tokens of the mark in front of repeated text, and the similarity from
# which a group that is still too small is kept open.
OVERLAP_MARK = "[...] "
OVERLAP_MARK_TOKENS = 5
KEEP_SMALL_SIMILARITY = 0.5


@dataclass(frozen=True)
class ChunkParams:
    """Defaults are those of the library; ``PIPELINE_PARAMS`` those of a full run."""

    strategy: str = "basic"
    min_tokens: int = 300
    max_tokens: int = 1000
    overlap: float = 0.0
    similarity: float = 0.70

    def __post_init__(self) -> None:
        if self.strategy not in ("basic", "semantic"):
            raise ValueError(f"unknown strategy {self.strategy!r}: use 'basic' or 'semantic'")
        if not 0 <= self.overlap < 1:
            raise ValueError("overlap is a share of a group: 0 <= overlap < 1")


PIPELINE_PARAMS = ChunkParams(min_tokens=400, max_tokens=800, overlap=0.15)


class Grouping:
    """The elements of one document (or block), ready to be walked group by group.

    Sums of tokens up to each element, and the next title and the next table or image after each, are made once; by size, the
    border of a group is then found by two searches in the sums, however many elements it has.
    """

    def __init__(self, params: ChunkParams, tokens, kinds, vectors=None):
        self.params = params
        tokens, kinds = np.asarray(tokens, dtype="int64"), np.asarray(kinds, dtype="int64")
        self.kinds = kinds.tolist()
        self.sums = [0, *np.cumsum(tokens).tolist()]
        self.titles, self.alone = (self._following(kinds == kind) for kind in (TITLE, ALONE))
        self.vectors = None
        if params.strategy == "semantic":
            self.vectors = [np.asarray(v, dtype="float64") for v in vectors]
            self.lengths = [math.sqrt(v.dot(v)) for v in self.vectors]

    @staticmethod
    def _following(marked: np.ndarray) -> list[int]:
        """For each place the first marked one from there on; the number of elements if there is none."""
        n = len(marked)
        places = np.where(marked, np.arange(n), n)
        return [*np.minimum.accumulate(places[::-1])[::-1].tolist(), n]

    def __len__(self) -> int:
        return len(self.kinds)

    def close(self, start: int, overlap: int) -> tuple[int, int]:
        """Node after the group at ``(start, overlap)``; ``start`` past the end if it is the last."""
        if self.kinds[start] == ALONE:
            return start + 1, 0
        if self.vectors is not None:
            return self._close_by_likeness(start, overlap)
        p, n, before = self.params, len(self), self.sums[start] - overlap
        # The first element at which the group is large enough, and from there on the first that would make it too large.
        enough = bisect.bisect_left(self.sums, p.min_tokens + before, start + 1)
        full = max(enough, bisect.bisect_right(self.sums, p.max_tokens + before, start + 2) - 1)
        at = min(self.alone[start + 1], self.titles[min(enough, n)], full, n)
        if at == n or self.kinds[at] != TEXT:
            return at, 0
        return at, self._repeated(self.sums[at] - self.sums[start], overlap)

    def _close_by_likeness(self, start: int, overlap: int) -> tuple[int, int]:
        p, before = self.params, self.sums[start] - overlap
        # The repeated text counts as one element of the group, so it weighs in the mean.
        members = 1 + (overlap > 0)
        centre, length = self.vectors[start], self.lengths[start]
        for at in range(start + 1, self.alone[start + 1]):
            size = self.sums[at] - before
            together = length * self.lengths[at]
            alike = float(centre.dot(self.vectors[at])) / together if together else 0.0
            keep = size < p.min_tokens and alike >= KEEP_SMALL_SIMILARITY
            if (self.sums[at + 1] - before > p.max_tokens or alike < p.similarity) and not keep:
                return at, self._repeated(self.sums[at] - self.sums[start], overlap)
            members += 1
            centre = (centre * (members - 1) + self.vectors[at]) / members
            length = math.sqrt(centre.dot(centre))
        return self.alone[start + 1], 0

    def _repeated(self, own: int, overlap: int) -> int:
        whole = own + (overlap + OVERLAP_MARK_TOKENS if overlap else 0)
        return int(whole * self.params.overlap)

    def groups(self, own: int, start: int, overlap: int):
        """Groups that begin among the first ``own`` elements: (start, stop, overlap, title, back).

        ``title`` is the last Title up to the group's first element.  ``back`` is the group
        from which on the texts before are needed for the repeated text: mostly the one
        before, earlier ones only where that is shorter than what is repeated; -1 if the
        repeated text may reach beyond the first group.
        """
        title, seen, found, sizes = -1, 0, [], []
        while start < min(own, len(self)):
            while self.titles[seen] <= start:
                title = self.titles[seen]
                seen = title + 1
            stop, following = self.close(start, overlap)
            back, needed = len(found) - 1, overlap
            while back >= 0 and needed > sizes[back] and found[back][2]:
                needed = found[back][2]
                back -= 1
            found.append((start, stop, overlap, title, back))
            sizes.append(self.sums[stop] - self.sums[start])
            start, overlap = stop, following
        return found

    def exits(self, own: int, nodes) -> list[tuple[int, int, int, int]]:
        """For each entry node, the first node beyond the first ``own`` elements."""
        leaves: dict[tuple[int, int], tuple[int, int]] = {}
        for entry in nodes:
            path, node = [], entry
            while node[0] < own and node not in leaves:
                path.append(node)
                node = self.close(*node)
            leave = leaves.get(node, node)
            leaves.update((step, leave) for step in path)
        return [(*entry, leaves.get(entry, entry)[0] - own, leaves.get(entry, entry)[1]) for entry in nodes]


# A group: the groups whose texts it is made of (itself last; places count from the first one's first element), its title's
# place (null: not among the elements seen), and where its elements lie: places of stretches of the document.
CHAIN_TYPE = "array<struct<start:int,stop:int,overlap:int>>"
PARTS_TYPE = "array<struct<stretch:int,begin:int,stop:int>>"
GROUP_TYPE = f"array<struct<chain:{CHAIN_TYPE},title:int,parts:{PARTS_TYPE}>>"
EXIT_TYPE = "array<struct<at:int,overlap:int,exit_at:int,exit_overlap:int>>"


def _rows(column: pa.Array) -> Iterator[np.ndarray]:
    """The numbers of each row of a list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
    return (flat[a:b] for a, b in zip(ends, ends[1:]))


def _vector_rows(column: pa.Array) -> Iterator[list[np.ndarray]]:
    inner = column.flatten()
    vectors = list(_rows(inner))
    ends = np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
    return (vectors[a:b] for a, b in zip(ends, ends[1:]))


def _lists(ends: list[int], fields: dict[str, pa.Array]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _ints(rows: list[tuple], names: tuple[str, ...]) -> dict[str, pa.Array]:
    return {name: pa.array([r[n] for r in rows], pa.int32()) for n, name in enumerate(names)}


class _Groups:
    """Groups of many rows, put together as one Arrow column."""

    def __init__(self) -> None:
        self.chain, self.parts, self.titles = [], [], []
        self.chain_ends, self.part_ends, self.row_ends = [0], [0], [0]

    def add(self, grouping: Grouping, stretches: np.ndarray, places: np.ndarray, own: int, skip: int, at: int, overlap: int):
        """The groups of a row that begin among the elements from ``skip`` to ``own``."""
        found = grouping.groups(own, at, overlap)
        borders = np.append(np.flatnonzero(np.diff(stretches)) + 1, len(stretches)).tolist()
        stretches, places = stretches.tolist(), places.tolist()
        near = 0
        for n, (start, stop, overlap, title, back) in enumerate(found):
            if start < skip:
                continue
            first = n if overlap == 0 else max(back, 0)
            low = found[first][0]
            self.chain += [(s - low, e - low, o) for s, e, o, _, _ in found[first : n + 1]]
            self.chain_ends.append(len(self.chain))
            self.titles.append(title - low if title >= 0 else None)
            while borders[near] <= low:
                near += 1
            begin, border = low, near
            while begin < stop:
                end = min(stop, borders[border])
                self.parts.append((stretches[begin], places[begin], places[end - 1] + 1))
                begin, border = end, border + 1
            self.part_ends.append(len(self.parts))
        self.row_ends.append(len(self.titles))

    def column(self) -> pa.Array:
        return _lists(
            self.row_ends,
            {
                "chain": _lists(self.chain_ends, _ints(self.chain, ("start", "stop", "overlap"))),
                "title": pa.array(self.titles, pa.int32()),
                "parts": _lists(self.part_ends, _ints(self.parts, ("stretch", "begin", "stop"))),
            },
        )


def group_column(params: ChunkParams, light: dict[str, Column], own: Column, skip: Column, at: Column, overlap: Column) -> Column:
    """The groups of each row as an array column.

    ``light``: arrays ``tokens``, ``kinds``, for similarity grouping ``vectors``, and the ``stretches`` that the elements
    belong to with their ``places`` in them.
    """
    semantic = params.strategy == "semantic"
    names = ["tokens", "kinds", "stretches", "places"]

    def work(tokens, kinds, stretches, places, own, skip, at, overlap, vectors=None) -> pa.Array:
        found = _Groups()
        rows = zip(*map(_rows, (tokens, kinds, stretches, places)), *(x.to_pylist() for x in (own, skip, at, overlap)))
        for (t, k, s, l, o, b, a, c), v in zip(rows, _vector_rows(vectors) if semantic else itertools.repeat(None)):
            found.add(Grouping(params, t, k, v), s, l, o, b, a, c)
        return found.column()

    columns = [*[light[n] for n in names], own, skip, at, overlap]
    if semantic:

        @F.arrow_udf(GROUP_TYPE)
        def alike(
            t: pa.Array, k: pa.Array, s: pa.Array, l: pa.Array, o: pa.Array, b: pa.Array, a: pa.Array, c: pa.Array, v: pa.Array
        ) -> pa.Array:
            return work(t, k, s, l, o, b, a, c, v)

        return alike(*columns, light["vectors"])

    @F.arrow_udf(GROUP_TYPE)
    def by_size(
        t: pa.Array, k: pa.Array, s: pa.Array, l: pa.Array, o: pa.Array, b: pa.Array, a: pa.Array, c: pa.Array
    ) -> pa.Array:
        return work(t, k, s, l, o, b, a, c)

    return by_size(*columns)


def exit_column(params: ChunkParams, light: dict[str, Column], own: Column, nodes: Column) -> Column:
    """For the entry nodes of each row, where their chains of groups leave the row."""
    semantic = params.strategy == "semantic"

    def work(tokens, kinds, own, nodes, vectors=None) -> pa.Array:
        found, ends = [], [0]
        rows = zip(_rows(tokens), _rows(kinds), own.to_pylist(), nodes.to_pylist())
        for (t, k, o, entry), v in zip(rows, _vector_rows(vectors) if semantic else itertools.repeat(None)):
            found += Grouping(params, t, k, v).exits(o, [(n["at"], n["overlap"]) for n in entry])
            ends.append(len(found))
        return _lists(ends, _ints(found, ("at", "overlap", "exit_at", "exit_overlap")))

    if semantic:

        @F.arrow_udf(EXIT_TYPE)
        def alike(t: pa.Array, k: pa.Array, o: pa.Array, n: pa.Array, v: pa.Array) -> pa.Array:
            return work(t, k, o, n, v)

        return alike(light["tokens"], light["kinds"], own, nodes, light["vectors"])

    @F.arrow_udf(EXIT_TYPE)
    def by_size(t: pa.Array, k: pa.Array, o: pa.Array, n: pa.Array) -> pa.Array:
        return work(t, k, o, n)

    return by_size(light["tokens"], light["kinds"], own, nodes)
