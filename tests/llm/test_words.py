"""Spelling variants, periodic runs and pieces against brute force, the library itself and edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path as tokenizer
from test_llm import edge, empty, frame, prose  # noqa: F401

from quarry.llm import periodic, pieces, spelling
from quarry.llm.common import WORD

MODEL = tokenizer("piece_bpe_32k.model")

# Pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    make = [
        lambda: " " * rng.randrange(300) + rng.choice(["", "x"]),
        lambda: "".join(rng.choices("abcest", k=rng.randrange(400))),
        lambda: "".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(40)),
        lambda: rng.choice("ae-=_.*#/") * rng.randrange(500),
        lambda: rng.choice(["ab", "the", "int ", "\n", "  x", "▁ "]) * rng.randrange(200),
        lambda: "".join(rng.choices("0123456789abcdefABCDEF+/=", k=600)),
        lambda: "".join(rng.choices("abcdefghinorst ▁  \n\t.,!?é😀ÀЖ中\x00<0x41>AB01", k=rng.randrange(200))),
        lambda: "<s> </s> <unk> <0x0A>",
    ]
    return [rng.choice(make)() for _ in range(n)]


def test_ids_are_those_of_the_library(vocabulary, library):
    texts = ["", *odd_texts(1, 1500), " " * 3000, "".join(random.Random(2).choices("abcdefghijklm", k=5000))]
    merger = pieces.Merger(vocabulary)
    ids, ends = merger.encode(texts)
    split = [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]
    assert split == library.encode(texts)
    assert pieces.decode_texts(vocabulary, ids, ends) == [library.decode(x) for x in split]
    # Again, from what is known by now.
    assert (merger.encode(texts)[0] == ids).all()


def test_rounds_and_queue_agree(vocabulary, monkeypatch):
    texts = odd_texts(3, 300)
    want = pieces.Merger(vocabulary).encode(texts)[0]
    monkeypatch.setattr(pieces, "MOST_ROUNDS", 2)
    assert (pieces.Merger(vocabulary).encode(texts)[0] == want).all()


def test_any_ids_are_decoded_as_the_library_does(vocabulary, library):
    rng = random.Random(4)
    rows = [
        np.array([rng.choice([rng.randrange(32000), rng.randrange(300), rng.randrange(3)]) for _ in range(rng.randrange(12))], np.int32)
        for _ in range(5000)
    ]
    ends = np.cumsum([0, *map(len, rows)])
    assert pieces.decode_texts(vocabulary, np.concatenate(rows), ends) == [library.decode(r.tolist()) for r in rows]


def test_round_trip_of_tables(spark, edge, empty, vocabulary, library, monkeypatch):  # noqa: F811
    monkeypatch.setattr(pieces, "CHUNK", 1000)
    both = pieces.decode(pieces.encode(edge, vocabulary), vocabulary).collect()
    texts = Counter(r["text"] or "" for r in edge.collect())
    assert Counter(r["text"] for r in both) == texts
    assert all(r["ids"] == library.encode(r["text"]) for r in both)
    assert sum(r["doc_id"] is None for r in both) == 1
    assert pieces.decode(pieces.encode(empty, vocabulary), vocabulary).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(nothing, vocabulary).first()["text"] == ""


# Periodic runs


def brute_runs(w: list[str]) -> list[tuple[int, int, int]]:
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                # A multiple of the smallest period has the same stretch.
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def stuttering(rng: random.Random) -> list[str]:
    kind, n = rng.random(), rng.randrange(120)
    if kind < 0.4:
        return rng.choices("ab", k=n)
    if kind < 0.6:
        return rng.choices("abcdefgh", k=n)
    if kind < 0.7:
        return ["x"] * n
    words: list[str] = []
    while len(words) < n:
        words += (rng.choices("abcßé", k=rng.randrange(1, 14)) * rng.randrange(1, 9))[: rng.randrange(1, 100)]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        docs = [stuttering(rng) for _ in range(rng.randrange(1, 12))]
        rows = periodic._found(list(range(len(docs))), docs).to_pylist()
        for words, row in zip(docs, rows, strict=True):
            want = brute_runs(words)
            assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == want
            gone = {i for s, n, q in want for i in range(s + q, s + n)}
            assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_a_grammar_derives_its_documents():
    rng = random.Random(6)
    docs = [stuttering(rng) for _ in range(30)]
    number: dict[str, int] = {}
    words = np.array([number.setdefault(w, len(number)) for d in docs for w in d])
    ends = np.cumsum([0, *map(len, docs)])
    left, right, first, roots = periodic.repair(words, ends)

    def text(symbol: int) -> list[int]:
        return [~symbol] if symbol < 0 else text(left[symbol]) + text(right[symbol])

    for d, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
        assert a == b or text(int(roots[d])) == words[a:b].tolist()
    for rule in range(len(left)):
        assert text(rule) == words[first[rule] : first[rule] + len(text(rule))].tolist()


def test_runs_of_tables(spark, edge, empty):  # noqa: F811
    docs = frame(spark, ["a b " * 40, "x " * 5, "x " * 6, None, ("u v w " * 4) + "end", prose(300, 1) + " " + "p q " * 5])
    rows = {r["doc_id"]: r for r in periodic.find_runs(docs).collect()}
    assert [len(rows[n]["runs"]) for n in range(6)] == [1, 0, 1, 0, 1, 1]
    assert tuple(rows[0]["runs"][0]) == (0, 80, 2) and rows[0]["collapsed"] == "a b"
    assert tuple(rows[4]["runs"][0]) == (0, 12, 3) and rows[4]["collapsed"] == "u v w end"
    assert tuple(rows[5]["runs"][0]) == (300, 10, 2)
    assert periodic.find_runs(edge).count() == edge.count()
    assert periodic.find_runs(edge, periodic.stutter).count() == edge.count()
    assert periodic.find_runs(empty).count() == 0


def test_stutter():
    words = re.findall(WORD, prose(100, 3))
    changed = [periodic.stutter(n, words) for n in range(200)]
    assert 5 < sum(c != words for c in changed) < 40 and all(len(c) == 100 for c in changed)
    assert periodic.stutter(None, words) == words and periodic.stutter(1, []) == []


# Spelling variants


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts: dict[str, int]) -> dict[str, tuple]:
    near: dict[str, list[str]] = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w: str) -> str:
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def spelled(rng: random.Random) -> list[str]:
    some = ["".join(rng.choices("abcé", k=rng.randrange(5, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "ÿÿÿÿÿ", "ÿÿÿÿÿÿ", "z" * 45, "z" * 44, "z" * 43 + "y"]
    texts = []
    for _ in range(40):
        words = []
        for _ in range(60):
            w = rng.choice(some[: rng.choice([5, 20, len(some)])])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "x", "ab", w[at].upper()]) + w[at + 1 :]
            words.append(w)
        texts.append(rng.choice([" ", ", ", "1", "_"]).join(words))
    chain = "kalmo " * 60 + "kalmox " * 25 + "kalmoxe " * 11 + "kalmoxen " * 4
    return [*texts, *texts[:5], None, "", chain]


@pytest.mark.parametrize("most_bytes", [spelling.MOST_BYTES, 64])
def test_variants_equal_brute_force(spark, most_bytes):
    texts = spelled(random.Random(7))
    counts: Counter[str] = Counter()
    for n, t in enumerate(texts):
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            counts[spelling.slip(n, "".join(c.lower() if "A" <= c <= "Z" else c for c in w))] += 1
    want = brute_variants({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    # Filters that are full let everything pass to the exact join.
    got = spelling.variants(frame(spark, texts), spelling.slip, most_bytes).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want
    assert len(got) == len(want) and any(root not in (w, form) for w, (form, root, *_) in want.items())


def test_filters_hold_their_words(spark):
    rng = random.Random(8)
    words = list({"".join(rng.choices("abcdefghij", k=rng.randrange(5, 60))) for _ in range(5000)})
    filters = spelling.build_filters(spark.createDataFrame([(w, 3) for w in words], "word string, n long"))
    hashes = spelling.hashed(words)
    assert all(filters.has(hashes[n : n + 1], spelling.shard_of(len(w)))[0] for n, w in enumerate(words))
    other = spelling.hashed(["".join(rng.choices("klmnop", k=20)) for _ in range(5000)])
    assert filters.has(other, 20).mean() < 0.02


def test_variants_edge(spark, edge, empty):  # noqa: F811
    got = {r["word"]: r for r in spelling.variants(edge.unionByName(edge)).collect()}
    assert "x" * 50_000 in got and got["x" * 50_000]["n_near"] == 0
    assert spelling.variants(empty).count() == 0
    assert [f.name for f in spelling.variants(empty).schema] == ["word", "form", "root", "n", "n_near", "form_n"]
