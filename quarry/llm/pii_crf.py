"""Personal data by patterns and a skip-chain conditional random field.

**Base spans** are matches of fixed patterns (e-mail, IP address, card, phone) with their checks.

**The field** labels the tokens (runs without white space) that have a digit or an ``@``: none, or one of the four kinds. Its potentials are

- the token's shape and the words beside it,
- a table for two such tokens that stand side by side,
- one weight per label for tokens that agree, however far apart: the same last seven digits, the same six digits where there are no
  more, or else equal but for marks. Two that agree are linked; three or more are each linked to a hub, a node for what they share, so
  that all are two steps apart and links grow with the tokens, not their pairs. A hub has one of the given labels of its tokens, if any.

The weights are fitted by pseudo-likelihood with the base spans as labels, on the candidate tokens of at most ``FIT_DOCUMENTS`` documents (those
with the least hash of their id, a bounded sample for fitting only). A token without a base span that agrees with one of
a base span is not known to be none of the kinds, and is left out of the fit. In every document, tokens of base spans are given, and loopy belief
propagation passes messages along all edges, so that a number that is a phone number in one place is one in others too,
even where no pattern matches. Messages are passed until none changes by ``SETTLED``; should they swing, steps become smaller after
``FREE_ROUNDS`` until they settle. Tokens with a belief of at least ``SURE`` and a given or believed twin add spans; base spans stay as they are.

All of it is a scan; only the fit collects a bounded table of token features.

Defined results: null text counts as empty and has no spans; offsets count code points; added spans never overlap base
spans or each other; repeated rows get a row each; an empty table gives an empty result (nothing is fitted, and only
base spans are found); further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
FIT_DOCUMENTS = 20_000
FIT_TOKENS = 30_000
SURE = 0.9
SETTLED, FREE_ROUNDS = 1e-4, 100
#: Before any data, agreeing tokens are taken to share a label with this weight.
SKIP_PRIOR = 2.0

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of digits begins where a run of digits begins.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"\S+")
TRIM = ".,;:!?\"'()[]{}<>|"
CONTEXT = 64
SHAPES = 40
FEATURES = SHAPES + 2 * CONTEXT


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in order of kind, then start."""
    spans = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            spans.append((0, start, last))
        at = text.find("@", max(at + 1, last))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x) <= 4000 and int(x) <= 255 for x in m[0].split(".")):
                spans.append((1, *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    spans.append((3, *m.span()))
    return spans


def shape(token: str) -> list[int]:
    """Features of the token itself, as places below SHAPES."""
    digits = [c for c in token if "0" <= c <= "9"]
    n = len(digits)
    parts = token.strip(TRIM).split(".")
    found = [0, 1 + min(n, 20)]
    tests = (
        "@" in token,
        token.startswith("+"),
        "(" in token or ")" in token,
        "-" in token,
        "." in token.strip(TRIM),
        any(c.isalpha() for c in token),
        n > len(token) / 2,
        13 <= n <= 19 and luhn("".join(digits)),
        len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p[:4]) <= 255 for p in parts),
        "@" in token and "." in token.partition("@")[2],
        n == 3,
        7 <= n <= 15,
        ":" in token or "/" in token or "=" in token,
    )
    return found + [22 + k for k, t in enumerate(tests) if t]


class Tokens:
    """The candidate tokens of a text, their features, given labels, and edges."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]) -> None:
        every = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
        places = [n for n, (_, _, t) in enumerate(every) if "@" in t or DIGIT.search(t)]
        self.spans = [every[n] for n in places]
        self.features = []
        for n in places:
            before = every[n - 1][2].lower().strip(TRIM) if n else ""
            after = every[n + 1][2].lower().strip(TRIM) if n + 1 < len(every) else ""
            side = lambda w: zlib.crc32((w if w.isalpha() else "#").encode("utf-8", "replace")) % CONTEXT
            self.features.append([*shape(every[n][2]), SHAPES + side(before), SHAPES + CONTEXT + side(after)])
        self.given = np.full(len(places), -1)
        starts = np.array([s[0] for s in self.spans], np.int64)
        ends = np.array([s[1] for s in self.spans], np.int64)
        for kind, start, end in reversed(spans):
            self.given[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end, "left")] = kind
        self.chain = [(k - 1, k) for k in range(1, len(places)) if places[k] == places[k - 1] + 1]
        self.places = places
        self.agreeing = self._agreeing()

    def _agreeing(self) -> list[list[int]]:
        """Groups of tokens that agree, other than two side by side."""
        groups: dict[tuple, list[int]] = {}
        for k, (_, _, token) in enumerate(self.spans):
            digits = "".join(c for c in token if "0" <= c <= "9")
            # Tokens that are equal have the same digits, and those the same end.
            key = ("digits", digits[-7:]) if len(digits) >= 6 else ("word", token.lower().strip(TRIM))
            groups.setdefault(key, []).append(k)
        return [m for m in groups.values() if len(m) > 1 and self.places[m[-1]] - self.places[m[0]] > 1]

    def twins(self, label: np.ndarray) -> np.ndarray:
        """Whether a token agrees with one of its own kind that is not beside it."""
        twin = np.zeros(len(label), bool)
        for members in self.agreeing:
            for kind in {int(label[k]) for k in members} - {NONE}:
                own = [k for k in members if label[k] == kind]
                first, last = self.places[own[0]], self.places[own[-1]]
                twin[[k for k in own if self.places[k] - first > 1 or last - self.places[k] > 1]] = True
        return twin


class Field:
    """Weights of the field: features x labels, neighbours, and agreement."""

    def __init__(self) -> None:
        self.unary = np.zeros((FEATURES, NONE + 1))
        self.pair = np.zeros((NONE + 1, NONE + 1))
        self.agree = np.full(NONE + 1, SKIP_PRIOR)

    def fit(self, rows: list) -> None:
        """Pseudo-likelihood: each token's label given those of its neighbours, by gradient steps (Adam)."""
        x = np.zeros((len(rows), FEATURES))
        label = np.array([r["label"] for r in rows])
        left, right = np.zeros((len(rows), NONE + 1)), np.zeros((len(rows), NONE + 1))
        twins = np.array([r["twins"] for r in rows], np.float64)
        for n, r in enumerate(rows):
            x[n, r["features"]] = 1
            if r["left"] >= 0:
                left[n, r["left"]] = 1
            if r["right"] >= 0:
                right[n, r["right"]] = 1
        target = np.eye(NONE + 1)[label]
        weights = [self.unary, self.pair, self.agree]
        means = [np.zeros_like(w) for w in weights]
        squares = [np.zeros_like(w) for w in weights]
        for step in range(1, 301):
            scores = x @ self.unary + left @ self.pair + right @ self.pair.T + twins * self.agree
            scores -= scores.max(axis=1, keepdims=True)
            p = np.exp(scores)
            error = target - p / p.sum(axis=1, keepdims=True)
            slopes = [
                x.T @ error - 1.0 * self.unary,
                left.T @ error + (right.T @ error).T - 1.0 * self.pair,
                (twins * error).sum(axis=0) - 1.0 * (self.agree - SKIP_PRIOR),
            ]
            for w, g, m, s in zip(weights, slopes, means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g**2 - s)
                w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)

    def beliefs(self, tokens: Tokens) -> np.ndarray:
        """Label probabilities of all tokens, by loopy belief propagation with damped messages."""
        n = len(tokens.spans)
        own = np.array([self.unary[f].sum(axis=0) for f in tokens.features])
        known = tokens.given >= 0
        own[known] = np.where(np.arange(NONE + 1) == tokens.given[known][:, None], 0.0, -50.0)
        agree, hubs = [], []
        for members in tokens.agreeing:
            if len(members) == 2:
                agree.append(tuple(members))
                continue
            kinds = {int(tokens.given[k]) for k in members} - {-1}
            agree += [(k, n + len(hubs)) for k in members if tokens.given[k] < 0]
            hubs.append([0.0 if not kinds or k in kinds else -1e9 for k in range(NONE + 1)])
        if hubs:
            own = np.concatenate([own, hubs])
        edges = [*tokens.chain, *agree]
        if edges:
            a, b = np.array(edges).T
            tables = np.concatenate(
                [
                    np.repeat(self.pair[None], len(tokens.chain), axis=0),
                    np.repeat(np.diag(self.agree)[None], len(agree), axis=0),
                ]
            )
            source, goal = np.concatenate([a, b]), np.concatenate([b, a])
            tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            message = np.zeros((len(source), NONE + 1))
            step, change, n_rounds = 0.5, np.inf, 0
            while change > SETTLED:
                total = own.copy()
                np.add.at(total, goal, message)
                out = (total[source] - message[back])[:, :, None] + tables
                top = out.max(axis=1)
                new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                change = step * np.abs(new - message).max()
                message += step * (new - message)
                n_rounds += 1
                if n_rounds > FREE_ROUNDS:
                    step *= 0.9
            np.add.at(own, goal, message)
        own = own[:n] - own[:n].max(axis=1, keepdims=True)
        p = np.exp(own)
        return p / p.sum(axis=1, keepdims=True)

    def added(self, text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans that the field adds to the base spans."""
        if not ("@" in text or DIGIT.search(text)):
            return []
        tokens = Tokens(text, spans)
        if not any(tokens.given[k] < 0 for members in tokens.agreeing for k in members):
            return []  # no token could have a twin
        p = self.beliefs(tokens)
        label = np.where(tokens.given >= 0, tokens.given, np.where(p.max(axis=1) >= SURE, p.argmax(axis=1), NONE))
        twin = tokens.twins(label)
        side = {b: a for a, b in tokens.chain}
        found: list[list] = []
        for k, (start, end, token) in enumerate(tokens.spans):
            if tokens.given[k] >= 0 or label[k] == NONE:
                continue
            start += len(token) - len(token.lstrip(TRIM))
            end -= len(token) - len(token.rstrip(TRIM))
            joined = found and side.get(k) == found[-1][3] and found[-1][0] == label[k]
            if joined:
                found[-1][2:] = [end, k, found[-1][4] or twin[k]]
            else:
                found.append([int(label[k]), start, end, k, bool(twin[k])])
        taken = [(s, e) for _, s, e in spans]
        return [
            (kind, start, end)
            for kind, start, end, _, has_twin in found
            if has_twin and start < end and not any(s < end and start < e for s, e in taken)
        ]


_ROW = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPANS = "doc_id long, base array<struct<kind:string, start:long, end:long>>, added array<struct<kind:string, start:long, end:long>>"
TOKENS = "doc_id long, at int, features array<int>, label int, left int, right int, twins array<int>"


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if not text or not ("@" in text or DIGIT.search(text)):
                continue
            tokens = Tokens(text, base_spans(text))
            label = np.where(tokens.given >= 0, tokens.given, NONE).tolist()
            left, right = [-1] * len(label), [-1] * len(label)
            twins = [[0] * (NONE + 1) for _ in label]
            for a, b in tokens.chain:
                left[b], right[a] = label[a], label[b]
            for members in tokens.agreeing:
                having = np.bincount([label[k] for k in members], minlength=NONE + 1)
                for k in members:
                    others = [kind for kind in range(NONE) if having[kind] > (label[k] == kind)]
                    # What agrees with a kind only by itself has twins of unknown label.
                    for kind in others or ([NONE] if label[k] == NONE else []):
                        twins[k][kind] += 1
            rows += [
                {"doc_id": doc_id, "at": k, "features": f, "label": label[k], "left": left[k], "right": right[k], "twins": twins[k]}
                for k, f in enumerate(tokens.features)
                if label[k] < NONE or not any(twins[k][:NONE])
            ]
        ints = pa.list_(pa.int32())
        kind = pa.schema(
            [("doc_id", pa.int64()), ("at", pa.int32()), ("features", ints), ("label", pa.int32()), ("left", pa.int32()),
             ("right", pa.int32()), ("twins", ints)]
        )
        yield pa.RecordBatch.from_pylist(rows, schema=kind)


def fit(docs: DataFrame, most: int = FIT_DOCUMENTS) -> Field:
    """A field from a bounded sample of documents."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = stored(ids.where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # most rows at most
    sample = rows.mapInArrow(_token_rows, TOKENS).orderBy(F.xxhash64("doc_id"), "doc_id", "at").limit(FIT_TOKENS).collect()
    field = Field()
    if sample:
        field.fit(sample)
    return field


def spans(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, base and added spans, each in order of kind, then start."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = lambda found: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found]
        for batch in batches:
            base, added = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                found = base_spans(text)
                base.append(name(found))
                added.append(name(sorted(sent.value.added(text, found))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(_ROW)), pa.array(added, pa.list_(_ROW))],
                ["doc_id", "base", "added"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, SPANS)
