"""Encoding texts into the ids of a SentencePiece BPE model, and decoding them, in vectorised merge rounds.

**Symbols.** Blanks become the mark U+2581 and one more is put in front of a text that is not empty. At first each code point is a symbol.

**Words.** No merge crosses a place whose two code points stand side by side in no piece of the vocabulary, so a text falls apart into
words there. If, as is usual, no piece has the mark after another sign, texts are first cut before marks, and each distinct string between
such cuts is merged once for many texts.

**Merge rounds** run over all words of many texts at once, which lie in flat arrays of symbols, words and ranks of neighbouring pairs (the
rank of a pair is that of the piece it makes, by falling score). In each round every word takes its least rank (a segmented minimum). All
pairs of this rank are merged at once, from the left and without overlap, where that cannot differ from merging one by one: where the piece is the
only one of its rank and makes no piece of a lower or equal rank with a neighbour. Otherwise the leftmost pair alone is merged. Then the arrays are
compacted, the ranks beside merges are looked up anew, and words without a pair that makes a piece leave. The result is that of
merging the best pair, the leftmost of equals, until none is left. What is not done after ``MOST_ROUNDS`` rounds (long runs of blanks, all pieces
of which have one score) is finished by a queue of pairs, which takes the same merges one by one.

**Bytes.** A code point that is no piece is written as the pieces of its UTF-8 bytes. Decoding joins the pieces, marks as blanks but
for the first, and reads runs of byte pieces as UTF-8; each byte that is no part of a code point becomes U+FFFD.

Scale: one pass without a shuffle; the vocabulary alone is broadcast. Texts are worked on in chunks of ``CHUNK`` code points, a longer text by itself.

Defined results: null and empty texts have no ids, and no ids are the empty text; repeated rows are encoded each; a null doc_id is carried along; an
empty table gives an empty result; further columns are ignored. Models with other pieces than normal ones, bytes and control signs, with
text normalisation or without bytes are refused.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_TEXT = " ⁇ "
#: Code points that are worked on at once, and that distinct strings kept for later chunks may have.
CHUNK, KEPT = 300_000, 5_000_000
MOST_ROUNDS = 100
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """The tables of a model, from the bytes of its file."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        read = sentencepiece_model_pb2.ModelProto()
        read.ParseFromString(model)
        kinds = type(read.pieces[0])
        trainer, normal = read.trainer_spec, read.normalizer_spec
        known = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        if (
            trainer.model_type != trainer.BPE
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not (normal.add_dummy_prefix and normal.escape_whitespaces)
            or any(p.type not in known for p in read.pieces)
        ):
            raise ValueError("not a plain BPE model with bytes")
        count = len(read.pieces)
        score = {p.piece: p.score for p in read.pieces if p.type == kinds.NORMAL}
        number = {p.piece: n for n, p in enumerate(read.pieces) if p.type == kinds.NORMAL}
        longer = [p for p in number if len(p) > 1]
        signs = sorted({sign for p in longer for sign in p})
        # Signs that are only parts of pieces are symbols after the pieces.
        for sign in signs:
            number.setdefault(sign, len(number) + count)
        self.count, self.symbols = count, max(number.values()) + 1
        single = [(ord(p), n) for p, n in number.items() if len(p) == 1]
        self.sign_codes, self.sign_numbers = (np.array(x, np.int32) for x in zip(*single, strict=True))
        self.byte_ids = np.zeros(256, np.int32)
        for n, p in enumerate(read.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = n

        # Pairs that make a piece.
        rank = {s: r for r, s in enumerate(sorted({score[p] for p in longer}, reverse=True))}
        pairs = [
            (number[p[:k]] * self.symbols + number[p[k:]], rank[score[p]], number[p])
            for p in longer
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        ]
        pairs.sort()
        self.pair_codes = np.array([p[0] for p in pairs], np.int64)
        self.pair_ranks, self.pair_makes = (np.array([p[n] for p in pairs], np.int32) for n in (1, 2))
        # A rank may be merged at once if one piece has it, and that piece makes none of a lower or equal rank.
        self.at_once = np.ones(len(rank) + 1, bool)
        made = np.bincount([rank[score[p]] for p in longer], minlength=len(rank) + 1)
        self.at_once[made > 1] = False
        own = np.full(self.symbols, -1, np.int64)
        for p in longer:
            own[number[p]] = rank[score[p]]
        for part in (self.pair_codes // self.symbols, self.pair_codes % self.symbols):
            early = own[part] >= self.pair_ranks
            self.at_once[own[part[early]]] = False

        # Which neighbouring code points stand side by side in a piece; class 0: in no longer piece at all.
        self.class_codes = np.array([ord(s) for s in signs], np.int32)
        at = {s: n + 1 for n, s in enumerate(signs)}
        self.beside = np.zeros((len(signs) + 1, len(signs) + 1), bool)
        for p in longer:
            for a, b in zip(p, p[1:], strict=False):
                self.beside[at[a], at[b]] = True
        self.cut_before_marks = not any(re.search(f"[^{MARK}]{MARK}", p) for p in longer)

        # What a piece writes, and whether it is a byte, or nothing.
        written = []
        for n, p in enumerate(read.pieces):
            if p.type == kinds.BYTE:
                written.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == kinds.CONTROL:
                written.append(b"")
            elif p.type == kinds.UNKNOWN:
                written.append(UNKNOWN_TEXT.encode())
            else:
                written.append(p.piece.replace(MARK, " ").encode())
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.written_ends = np.cumsum([0, *map(len, written)])
        self.is_byte = np.array([p.type == kinds.BYTE for p in read.pieces])
        self.is_control = np.array([p.type == kinds.CONTROL for p in read.pieces])
        self.starts_with_mark = np.array([p.type == kinds.NORMAL and p.piece.startswith(MARK) for p in read.pieces])


class Merger:
    """Encodes strings by a vocabulary; one per task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.sign = np.full(0x110000, -1, np.int32)
        self.sign[vocabulary.sign_codes] = vocabulary.sign_numbers
        self.sort = np.zeros(0x110000, np.int16)
        self.sort[vocabulary.class_codes] = np.arange(1, len(vocabulary.class_codes) + 1)
        self.pattern = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if vocabulary.cut_before_marks else r"(?s).+")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends, self.kept = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and number of the pieces that pairs make; the rank is NONE where there is none."""
        codes = left.astype(np.int64) * self.v.symbols + right
        at = np.minimum(np.searchsorted(self.v.pair_codes, codes), len(self.v.pair_codes) - 1)
        there = (self.v.pair_codes[at] == codes) & (left >= 0) & (right >= 0)
        return np.where(there, self.v.pair_ranks[at], NONE), self.v.pair_makes[at]

    def merged(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges of the words that begin at ``starts``, and the place in ``codes`` where each begins."""
        final = self.sign[codes]
        alive = np.ones(len(codes), bool)
        first = np.zeros(len(codes), bool)
        first[starts] = True
        sort = self.sort[codes]
        first[1:] |= ~self.v.beside[sort[:-1], sort[1:]]
        # Symbols that have a neighbour in their word.
        last = np.append(first[1:], True)
        place = np.flatnonzero(~(first & last))
        symbol, word = final[place], np.cumsum(first)[place]
        rank, makes = self._beside(symbol, word)
        for _ in range(MOST_ROUNDS):
            # The least rank of each word; words without any leave.
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            low = np.minimum.reduceat(rank, begins) if len(begins) else rank[:0]
            count = np.diff(np.append(begins, len(word)))
            done = low == NONE
            if done.any():
                stays = np.repeat(~done, count)
                final[place[~stays]] = symbol[~stays]
                place, symbol, word, rank, makes = (x[stays] for x in (place, symbol, word, rank, makes))
                low, count = low[~done], count[~done]
            if not len(place):
                return final[alive], np.flatnonzero(alive)
            # Pairs of that rank: every other one of those that overlap, or the leftmost.
            at = np.flatnonzero(rank == np.repeat(low, count))
            fresh = np.diff(at, prepend=-2) != 1
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            every_other = (np.arange(len(at)) - head) % 2 == 0
            leftmost = np.diff(word[at], prepend=-1) != 0
            at = at[np.where(self.v.at_once[rank[at]], every_other, leftmost)]
            symbol[at] = makes[at]
            alive[place[at + 1]] = False
            stays = np.ones(len(place), bool)
            stays[at + 1] = False
            place, symbol, word, rank, makes = (x[stays] for x in (place, symbol, word, rank, makes))
            merged = at - np.arange(len(at))
            fresh = np.zeros(len(place) + 1, bool)
            fresh[merged] = fresh[merged - 1] = True
            changed = np.flatnonzero(fresh[:-1])
            rank[changed], makes[changed] = self._beside(symbol, word, changed)
        bounds = [*np.flatnonzero(np.diff(word, prepend=-1)), len(word)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            self._queue(symbol[a:b], place[a:b], final, alive)
        return final[alive], np.flatnonzero(alive)

    def _beside(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each symbol (or of those at some places) with the next one of its word."""
        at = np.arange(len(symbol)) if at is None else at
        after = np.minimum(at + 1, len(symbol) - 1)
        rank, makes = self.pairs(symbol[at], symbol[after])
        rank[(after == at) | (word[after] != word[at])] = NONE
        return rank, makes

    def _queue(self, symbol: np.ndarray, place: np.ndarray, final: np.ndarray, alive: np.ndarray) -> None:
        """The rest of one word, a merge at a time."""
        symbol, n = symbol.tolist(), len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        v, waiting = self.v, []

        def offer(left: int, right: int) -> None:
            if left < 0 or right < 0 or symbol[left] < 0 or symbol[right] < 0:
                return
            code = symbol[left] * v.symbols + symbol[right]
            at = int(np.searchsorted(v.pair_codes, code))
            if at < len(v.pair_codes) and v.pair_codes[at] == code:
                heapq.heappush(waiting, (int(v.pair_ranks[at]), left, symbol[left], symbol[right], right, int(v.pair_makes[at])))

        for k in range(n - 1):
            offer(k, k + 1)
        while waiting:
            _, left, a, b, right, makes = heapq.heappop(waiting)
            if symbol[left] != a or symbol[right] != b or after[left] != right:
                continue
            symbol[left], symbol[right] = makes, None
            alive[place[right]] = False
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            after[right] = -2
            offer(before[left], left)
            offer(left, after[left])
        for k in range(n):
            if symbol[k] is not None:
                final[place[k]] = symbol[k]

    def learn(self, strings: list[str]) -> None:
        """Encode distinct strings and keep their ids."""
        codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
        ends = np.cumsum([len(s) for s in strings])
        symbols, places = self.merged(codes, np.append(0, ends[:-1]))
        # Signs that are no piece are written in bytes.
        foreign = (symbols < 0) | (symbols >= self.v.count)
        width = np.ones(len(symbols), np.int64)
        code = codes[places]
        width[foreign] = 1 + (code[foreign] > 0x7F) + (code[foreign] > 0x7FF) + (code[foreign] > 0xFFFF)
        ids = np.repeat(symbols, width)
        if foreign.any():
            written = "".join(map(chr, code[foreign].tolist())).encode("utf-8", "surrogatepass")
            ids[np.repeat(foreign, width)] = self.v.byte_ids[np.frombuffer(written, np.uint8)]
        upto = np.append(0, np.cumsum(width))
        held = upto[np.searchsorted(places, ends)]
        self.known.update(zip(strings, range(len(self.ends) - 1, len(self.ends) - 1 + len(strings)), strict=True))
        self.ends = np.concatenate([self.ends, self.ends[-1] + held])
        self.ids = np.concatenate([self.ids, ids])
        self.kept += len(codes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the ends of each text's (after a 0)."""
        if self.kept > KEPT:
            self.forget()
        cut = [self.pattern.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        every = list(itertools.chain.from_iterable(cut))
        new = [s for s in dict.fromkeys(every) if s not in self.known]
        if new:
            self.learn(new)
        which = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        begin, count = self.ends[which], self.ends[which + 1] - self.ends[which]
        stop = np.append(0, np.cumsum(count))
        ids = self.ids[np.arange(stop[-1]) - np.repeat(stop[:-1] - begin, count)]
        return ids, stop[np.cumsum([0, *(len(strings) for strings in cut)])]


def decode_bytes(v: Vocabulary, ids: np.ndarray) -> str:
    """The text of ids where some run of byte pieces is not UTF-8, or with control signs, which end such runs."""
    parts, waiting = [], bytearray()

    def flush() -> None:
        while waiting:
            for n in (1, 2, 3, 4):
                try:
                    sign = bytes(waiting[:n]).decode()
                except UnicodeDecodeError:
                    continue
                break
            else:
                n, sign = 1, "�"
            parts.append(sign)
            del waiting[:n]

    fresh = True
    for n in ids.tolist():
        text = v.written[v.written_ends[n] : v.written_ends[n + 1]].tobytes()
        if v.is_byte[n]:
            waiting += text
            continue
        fresh = fresh and not waiting and not any(parts)
        flush()
        if not v.is_control[n]:
            text = text.decode()
            if fresh and v.starts_with_mark[n]:
                text, fresh = text[1:], False
            parts.append(text)
    flush()
    return "".join(parts)


def decode_texts(v: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """The texts of ids that lie between ``ends``."""
    begin, count = v.written_ends[ids], np.diff(v.written_ends)[ids]
    stop = np.append(0, np.cumsum(count))
    data = v.written[np.arange(stop[-1]) - np.repeat(stop[:-1] - begin, count)].tobytes()
    controls = np.append(0, np.cumsum(v.is_control[ids]))
    texts = []
    for a, b in zip(ends, ends[1:], strict=False):
        if a == b:
            texts.append("")
            continue
        try:
            if controls[a] < controls[b]:
                raise ValueError
            texts.append(data[stop[a] + int(v.starts_with_mark[ids[a]]) : stop[b]].decode())
        except ValueError:
            texts.append(decode_bytes(v, ids[a:b]))
    return texts


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as model:
        return Vocabulary(model.read())


def _chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows of ``most`` together, or of one larger row."""
    begin, total = 0, 0
    for n, size in enumerate(sizes):
        if n > begin and total + size > most:
            yield begin, n
            begin, total = n, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids of the whole text of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _chunks([len(t) for t in texts], CHUNK):
                ids, ends = merger.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids, text of rows with ids; null ids are none."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            lists = batch.column("ids")
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten().to_numpy()
            ends = np.append(0, np.cumsum(sizes))
            for a, b in _chunks(sizes.tolist(), CHUNK):
                texts = decode_texts(v, flat[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, ids array<int>, text string")
