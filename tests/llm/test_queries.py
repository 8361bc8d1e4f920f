"""Registered queries against brute force over the smallest tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import pytest
import sentencepiece
from public_tokenizers import path as tokenizer

from quarry.llm import pii_crf
from quarry.llm.queries import REGISTERED

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALLEST}/documents.parquet'").fetchall()
    return dict(rows)


def test_personal_data(spark, texts):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for r in REGISTERED["op5_pii"](spark, SMALLEST).collect():
        want = []
        for kind, pattern in kinds.items():
            for m in re.finditer(pattern, texts[r["doc_id"]]):
                digits = re.sub("[^0-9]", "", m[0])
                if (
                    kind == "email"
                    or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                    or (kind == "card" and 13 <= len(digits) <= 19 and pii_crf.luhn(digits))
                    or (kind == "phone" and 9 <= len(digits) <= 15)
                ):
                    want.append(f"{kind}:{m.start()}:{m.end()}")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(",")) | {""}


def test_shards(spark, texts):
    rows = REGISTERED["op8_reshard"](spark, SMALLEST).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots: dict = {}
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data)) and r["law"] == "bytes"
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_mixture(spark, texts):
    taken: dict = {}
    for r in REGISTERED["op3_mixture"](spark, SMALLEST).collect():
        size = len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]]))
        assert r["size"] == size and r["taken"] in (0, size, 2 * size, 3 * size)
        key = (r["source_size"], r["target"])
        taken[key] = taken.get(key, 0) + r["taken"]
    assert sum(t for _, t in taken) == pytest.approx(sum(s for s, _ in taken))


def test_toxicity_and_packing_cover_all(spark, texts):
    assert {r["doc_id"] for r in REGISTERED["op1_toxicity"](spark, SMALLEST).collect()} == set(texts)
    packed = {d for r in REGISTERED["op6_packing"](spark, SMALLEST).collect() for d in r["doc_ids"]}
    assert packed == {d for d, t in texts.items() if t}


def test_pieces_are_those_of_the_library(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    rows = REGISTERED["op13_pieces"](spark, SMALLEST).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], num_threads=1)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
