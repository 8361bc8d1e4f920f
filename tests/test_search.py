import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.encoder import hash_embedding
from quarry.operators import cells, fusion, lexical, ranking, vector
from quarry.sources.bucketed import BucketedTable, ConcurrentWrite
from quarry.operators.index import VectorTable, combined_filter, compile_filter, index_stats, latest, prepare_vectors, upsert
from quarry.plans.retriever import Retriever
from quarry.schemas import VECTORS


def docs(spark, texts):
    return spark.createDataFrame([(f"doc{i + 1}", t) for i, t in enumerate(texts)], "doc_id string, text string")


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


# -- lexical ---------------------------------------------------------------------------


def test_corpus_stats(spark):
    index = lexical.forward_index(docs(spark, ["The tall grey heron", "The small otter dives"]))
    assert lexical.corpus_stats(index).first().asDict() == {"n_docs": 2, "avg_doc_len": 4.0}


def test_postings(spark):
    index = lexical.forward_index(docs(spark, ["b a b", "", "--"]))
    rows = {(r.doc_id, r.doc_len, r.term, r.tf) for r in lexical.postings(index).collect()}
    assert rows == {("doc1", 3, "a", 1), ("doc1", 3, "b", 2)}
    assert lexical.corpus_stats(index).first().asDict() == {"n_docs": 3, "avg_doc_len": 1.0}


def test_idf_rare_above_common(spark):
    index = lexical.forward_index(docs(spark, ["the tall grey heron", "the small otter", "the mole dives"]))
    idf = {r.term: r.idf for r in lexical.term_idf(index).collect()}
    assert idf["heron"] > idf["the"]
    assert idf["the"] == pytest.approx(math.log(0.5 / 3.5 + 1))


def test_score_needs_a_shared_word(spark):
    index = lexical.forward_index(
        docs(spark, ["river rowing is hard", "night rowing club races", "baking bread and cakes"])
    )
    pairs = spark.createDataFrame([(0, "doc1"), (0, "doc3"), (0, "doc1"), (1, "doc2")], "query_id long, doc_id string")
    queries = asked(spark, "rowing", "club river")
    rows = lexical.score(index, queries, pairs).collect()
    scores = {(r.query_id, r.doc_id): r.score for r in rows}
    assert len(rows) == 3 and scores[0, "doc3"] == 0.0 and scores[0, "doc1"] > 0 and scores[1, "doc2"] > 0
    kept = lexical.statistics(index)
    assert {(r.query_id, r.doc_id): r.score for r in lexical.score(index, queries, pairs, kept=kept).collect()} == scores
    found = {(r.query_id, r.doc_id): r.score for r in lexical.search(index, queries, 3).collect()}
    assert all(found[pair] == pytest.approx(score) for pair, score in scores.items() if score)
    again = lexical.search(index, queries, 3, kept=kept).collect()
    assert {(r.query_id, r.doc_id): r.score for r in again} == found


PROGRAMS = ["granite carving manual", "granite boulder hill", "marble carving manual"]


@pytest.mark.parametrize("bound", [1, 1_000_000])
def test_search(spark, monkeypatch, bound):
    monkeypatch.setattr(lexical, "MAX_SENT_TERMS", bound)
    index = lexical.forward_index(docs(spark, PROGRAMS))
    hits = lexical.search(index, asked(spark, "granite carving", "xyz unknown"), 2).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.doc_id) for r in hits] == [(0, 1, "doc1"), (0, 2, "doc2")]
    assert hits[0].score > hits[1].score


def test_search_nothing(spark):
    index = lexical.forward_index(docs(spark, PROGRAMS))
    assert lexical.search(index, asked(spark)).count() == 0
    assert lexical.search(index, asked(spark, "", "?")).count() == 0


@pytest.mark.parametrize("slice_cells", [7, 4_000_000])
def test_search_like_brute_force(spark, monkeypatch, slice_cells):
    monkeypatch.setattr(ranking, "MAX_HELD_SCORES", slice_cells)
    monkeypatch.setattr(lexical, "MAX_HELD_SCORES", slice_cells)
    monkeypatch.setattr(lexical, "MAX_SENT_QUERIES", 2 if slice_cells == 7 else 100)
    monkeypatch.setattr(ranking, "MAX_HELD_HITS", 5 if slice_cells == 7 else 1_000_000)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    queries = [" ".join(rng.choice("abcdxyz") for _ in range(rng.randint(1, 5))) for _ in range(5)]
    tokens = [t.split() for t in texts]
    average = sum(map(len, tokens)) / len(tokens)

    def score(query, doc):
        total = 0.0
        for word in query.split():  # a repeated word counts again
            df = sum(word in t for t in tokens)
            if df:
                tf = doc.count(word)
                idf = math.log((len(tokens) - df + 0.5) / (df + 0.5) + 1)
                total += idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(doc) / average))
        return total

    expected = set()
    for q, query in enumerate(queries):
        best = sorted((-round(score(query, t), 9), f"doc{i + 1}") for i, t in enumerate(tokens) if score(query, t) > 0)
        expected |= {(q, rank + 1, doc, round(-s, 6)) for rank, (s, doc) in enumerate(best[:7])}
    index = lexical.forward_index(docs(spark, texts))
    hits = lexical.search(index, asked(spark, *queries), 7).collect()
    assert {(r.query_id, r.rank, r.doc_id, round(r.score, 6)) for r in hits} == expected


# -- dense -----------------------------------------------------------------------------


@pytest.mark.parametrize("metric", vector.METRICS)
def test_dense_like_brute_force(spark, metric):
    rng = np.random.default_rng(1)
    rows = rng.integers(-2, 3, size=(70, 4)).astype("float64")
    rows[3] = 0
    asked_rows = rows[:9]

    def score(a, b):
        if metric == "dotproduct":
            return float(a @ b)
        if metric == "euclidean":
            return float(np.linalg.norm(a - b))
        size = np.linalg.norm(a) * np.linalg.norm(b)
        return float(a @ b / size) if size else 0.0

    expected = set()
    for q, query in enumerate(asked_rows):
        sign = 1 if metric == "euclidean" else -1
        best = sorted((sign * round(score(r, query), 9), f"v{i:02d}") for i, r in enumerate(rows))[:6]
        expected |= {(q, rank + 1, i, round(sign * s, 6)) for rank, (s, i) in enumerate(best)}
    table = spark.createDataFrame([(f"v{i:02d}", r.tolist()) for i, r in enumerate(rows)], "id string, embedding array<float>")
    queries = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(asked_rows)], "query_id long, embedding array<float>")
    for sent in (100, 3):  # sent to every task; cut into blocks
        hits = vector.dense_topk(table, queries, 6, metric, max_sent=sent).collect()
        assert {(r.query_id, r.rank, r.id, round(r.score, 6) + 0.0) for r in hits} == expected


@pytest.mark.parametrize("sent", [100, 2])
def test_conditions_of_each_query(spark, sent):
    columns = "id string, embedding array<float>, document string, chunk_type string, page_number int, has_image boolean"
    table = spark.createDataFrame(
        [
            ("a", [1.0, 0.0], "one", "text", 1, False),
            ("b", [1.0, 0.1], "two", "text", 5, True),
            ("c", [1.0, 0.2], "two", "table", 9, None),
            ("d", [1.0, 0.3], None, None, None, None),
        ],
        columns,
    )
    wanted = {
        0: ((None,) * 5, "abcd"),
        1: (("two", None, None, None, None), "bc"),
        2: (("", "text", None, None, None), "ab"),
        3: ((None, None, 2, 8, None), "b"),
        4: ((None, None, None, None, True), "b"),
        5: (("nowhere", None, None, None, None), ""),
        6: ((None, "table", 5, None, None), "c"),
    }
    names = ("document", "chunk_type", "min_page", "max_page", "has_image")
    types = ("string", "string", "int", "int", "boolean")
    schema = "query_id long, embedding array<float>, " + ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
    queries = spark.createDataFrame([(i, [1.0, 0.0], *c) for i, (c, _) in wanted.items()], schema)
    for metric in vector.METRICS:
        found = vector.dense_topk(table, queries, 4, metric, max_sent=sent).collect()
        got = {(r.query_id, r.id) for r in found}
        assert got == {(i, x) for i, (_, ids) in wanted.items() for x in ids}


def test_dense_nothing_and_unknown(spark):
    table = spark.createDataFrame([("a", [1.0])], "id string, embedding array<float>")
    queries = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert vector.dense_topk(table, queries).count() == 0
    with pytest.raises(ValueError):
        vector.dense_topk(table, queries, metric="manhattan")


# -- index -----------------------------------------------------------------------------


def record(spark, **known):
    base = {"chunk_id": "c0", "document": "d", "chunk_index": 0, "original_content": "text"}
    fields = (
        "chunk_id string, document string, chunk_index int, chunk_type string, section_title string, page_number int, "
        "element_count int, token_count int, has_image boolean, image_description string, filetype string, "
        "original_content string, embedding array<float>"
    )
    names = [f.split()[0] for f in fields.split(", ")]
    values = {**base, "embedding": [1.0, 0.0], **known}
    return spark.createDataFrame([tuple(values.get(n) for n in names)], fields)


def test_prepare_vectors(spark):
    row = prepare_vectors(record(spark, original_content="é" * 5000, image_description="", filetype="")).first()
    assert (row.id, row.chunk_type, row.section_title, row.page_number, row.has_image) == ("c0", "text", "", 0, False)
    assert len(row.original_content) == 5000 and row.image_description is None and row.filetype is None
    cut = prepare_vectors(record(spark, original_content="é" * 5000, image_description="d" * 9), None, 2000, 3).first()
    assert (len(cut.original_content), cut.image_description) == (2000, "ddd")
    long = prepare_vectors(record(spark, image_description="x" * 1500, filetype="png")).first()
    assert (len(long.image_description), long.filetype) == (1500, "png")


def test_filters(spark):
    pages = spark.createDataFrame([(f"d{i}", i, i % 2 == 0) for i in range(12)], "document string, page_number int, has_image boolean")

    def kept(filters):
        return [r.page_number for r in pages.filter(compile_filter(filters)).orderBy("page_number").collect()]

    assert kept(None) == list(range(12))
    assert kept({"page_number": {"$gte": 5, "$lte": 10}}) == [5, 6, 7, 8, 9, 10]
    assert kept({"$and": [{"document": {"$eq": "d3"}}, {"has_image": {"$eq": False}}]}) == [3]
    for wrong in ({"colour": {"$eq": 1}}, {"page_number": {"$in": [1]}}, {"page_number": 3}):
        with pytest.raises(ValueError):
            compile_filter(wrong)


def test_combined_filter():
    assert combined_filter() is None and combined_filter(document="", chunk_type="") is None
    made = combined_filter("test", "text", 1, None, False)
    assert made == {
        "$and": [
            {"document": {"$eq": "test"}},
            {"chunk_type": {"$eq": "text"}},
            {"page_number": {"$gte": 1}},
            {"has_image": {"$eq": False}},
        ]
    }


def test_latest_wins(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    sent = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "id string, v int, seq int")
    assert {tuple(r) for r in upsert(stored, sent, [F.col("seq")]).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    assert latest(sent, [F.col("seq")]).count() == 2


def test_vector_table(spark, tmp_path):
    table = VectorTable(spark, str(tmp_path / "index"), dimensions=2)
    assert table.stats() == {"total_vectors": 0, "dimensions": 2}
    two = prepare_vectors(record(spark).unionByName(record(spark, chunk_id="c1")))
    assert table.index_chunks(two) == {"upserted": 2, "total_vectors": 2, "dimensions": 2}
    again = table.index_chunks(two.unionByName(two))
    assert again == {"upserted": 4, "total_vectors": 2, "dimensions": 2}
    assert VectorTable(spark, str(tmp_path / "index"), 2).read().count() == 2
    assert index_stats(table.read()).first().asDict() == {"total_vectors": 2, "dimensions": 2}
    held = table.read()
    first = prepare_vectors(record(spark)).withColumn("original_content", F.lit("first"))
    table.index_chunks(first.unionByName(first.withColumn("original_content", F.lit("second"))))
    assert held.count() == 2 and held.filter("original_content = 'second'").count() == 0
    assert table.read().filter("original_content = 'second'").count() == 1
    table.clean_up()
    assert table.read().count() == 2
    with pytest.raises(Exception, match="vectors must have 2 numbers"):
        table.index_chunks(prepare_vectors(record(spark, embedding=[1.0])))
    assert table.stats()["total_vectors"] == 2
    table.delete_all_vectors()
    assert table.stats()["total_vectors"] == 0
    table.delete_index()
    with pytest.raises(FileNotFoundError):
        table.read()


def test_sparse_topk_follows_matches(spark, monkeypatch):
    """The best of many documents by looking at few entries: equal to scoring all, whatever the blocks."""
    rng = random.Random(4)
    common, rare = [f"c{n}" for n in range(30)], [f"r{n}" for n in range(400)]
    texts = [" ".join(rng.choices(common, k=rng.randrange(1, 30)) + rng.choices(rare, k=2)) for _ in range(1500)]
    queries = [" ".join([rng.choice(rare), rng.choice(common), rng.choice(common)]) for _ in range(60)]
    index = lexical.forward_index(docs(spark, texts)).coalesce(1).cache()
    every = lexical.score(index, asked(spark, *queries), asked(spark, *queries).select("query_id").crossJoin(index.select("doc_id")))
    want = ranking.ranked(every.filter("score > 0"), 3, item="doc_id").select("query_id", "rank", "doc_id").collect()
    looked = {}
    for block in (7, 256):
        monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", block)
        touched = spark.sparkContext.accumulator(0)
        got = lexical.search(index, asked(spark, *queries), 3, touched=touched).collect()
        assert {(r.query_id, r.rank, r.doc_id) for r in got} == {tuple(r) for r in want}
        looked[block] = touched.value
    matches = sum(sum(w in set(t.split()) for w in q.split()) for q in queries for t in texts)
    # Blocks that cannot have a better document are passed by; nothing is done per document and query.
    assert looked[7] < matches / 2 and looked[256] <= matches < 1500 * 60 * 3


@pytest.mark.parametrize("metric", vector.METRICS)
def test_cells_give_what_a_scan_gives(spark, tmp_path, metric):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(30, 8)) * 6
    rows = [(f"v{n:04d}", (middles[n % 30] + rng.normal(size=8) * 0.3).tolist(), n % 4) for n in range(1800)]
    # Ties, vectors without a direction, and one that is missing.
    rows += [(f"t{n}", rows[n % 3][1], 1) for n in range(9)] + [("zero", [0.0] * 8, 0), ("none", None, 0)]
    vectors = spark.createDataFrame(rows, "id string, embedding array<double>, part int")
    asked_vectors = [(n, (middles[n] + rng.normal(size=8) * 0.3).tolist()) for n in range(20)] + [(20, rows[0][1]), (21, [0.0] * 8)]
    queries = spark.createDataFrame(asked_vectors, "query_id long, embedding array<double>")
    table = cells.CellTable(spark, str(tmp_path / "cells"), metric)
    table.build(vectors, 40)
    told = lambda hits: sorted((r.query_id, r.rank, r.id, round(r.score, 8)) for r in hits.collect())
    want = vector.dense_topk(vectors, queries, 5, metric)
    assert told(table.search(queries, 5)) == told(want)
    some = vector.dense_topk(vectors.filter("part = 1"), queries, 5, metric)
    assert told(table.search(queries, 5, F.col("part") == 1)) == told(some)
    if metric != "dotproduct":
        # Most cells cannot have a better vector for a query near one of them.
        known = table.cells()
        best = -want.filter("query_id = 3").agg(F.max("score")).first()[0] if metric == "euclidean" else want.filter("query_id = 3").agg(F.min("score")).first()[0]
        assert (table.promise(np.array([asked_vectors[3][1]]), known) >= best).sum() < len(known.numbers) / 2


def test_small_distances_are_exact(spark):
    far = [1e6, 1e6, 1e6]
    rows = [("a", far), ("b", [1e6, 1e6, 1e6 + 1e-4]), ("c", [1e6, 1e6, 1e6 + 3e-4]), *[(f"z{n}", [float(n), 0.0, 0.0]) for n in range(20)]]
    vectors = spark.createDataFrame(rows, "id string, embedding array<double>")
    query = spark.createDataFrame([(1, far)], "query_id long, embedding array<double>")
    got = vector.dense_topk(vectors, query, 3, "euclidean").orderBy("rank").collect()
    assert [r.id for r in got] == ["a", "b", "c"] and got[1].score == pytest.approx(1e-4, rel=1e-3)


def bucketed(spark, path, buckets=8):
    table = BucketedTable(spark, str(path), T.StructType.fromDDL("id string, v int"), "id", buckets)
    table.clear()
    return table


def pairs(spark, rows):
    return spark.createDataFrame(rows, "id string, v int")


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    table = bucketed(spark, tmp_path / "t")
    table.merge(pairs(spark, [(f"k{n}", 0) for n in range(200)]), [F.col("v")])
    before, held = table.manifest().folders, table.read()
    assert all(before)
    touched = table.merge(pairs(spark, [("k1", 1), ("k1", 3), ("k1", 2), ("new", 5)]), [F.col("v")])
    after = table.manifest().folders
    assert 1 <= len(touched) <= 2 and {n for n in range(8) if before[n] != after[n]} == set(touched)
    got = {r.id: r.v for r in table.read().collect()}
    assert got == {**{f"k{n}": 0 for n in range(200)}, "k1": 3, "new": 5}
    assert {r.v for r in held.collect()} == {0} and held.count() == 200
    # Ids are looked for in their own buckets.
    looked = table.read_keys(pairs(spark, [("k1", 0), ("nobody", 0)]))
    assert [tuple(r) for r in looked.collect()] == [("k1", 3)]
    assert len(looked.inputFiles()) <= 2 < len(table.read().inputFiles())
    # Compaction and another number of buckets keep the rows; old files go with clean_up.
    wider = BucketedTable(spark, table.path, table.schema, "id", 16)
    wider.compact()
    assert len(wider.manifest().folders) == 16 and {r.id: r.v for r in wider.read().collect()} == got
    wider.merge(pairs(spark, [("k1", 9)]), [F.col("v")])
    wider.clean_up()
    assert len(wider._names(f"{table.path}/manifest")) == 1 and len(wider._names(f"{table.path}/data")) == 2
    assert {r.id: r.v for r in wider.read().collect()} == {**got, "k1": 9}
    assert wider.merge(pairs(spark, []), [F.col("v")]) == []


def test_two_writers(spark, tmp_path, monkeypatch):
    table = bucketed(spark, tmp_path / "t")
    table.merge(pairs(spark, [(f"k{n}", 0) for n in range(40)]), [F.col("v")])
    write, others = table._write, [[("k7", 1)], [("k8", 1), ("k7", 2)]]

    def slow(rows):
        found = write(rows)
        if others:
            # Another writer comes between this one's files and its manifest.
            BucketedTable(spark, table.path, table.schema, "id").merge(pairs(spark, others.pop(0)), [F.col("v")])
        return found

    monkeypatch.setattr(table, "_write", slow)
    table.merge(pairs(spark, [("k7", 5), ("k9", 5)]), [F.col("v")])
    got = {r.id: r.v for r in table.read().collect()}
    assert (got["k7"], got["k8"], got["k9"]) == (5, 1, 5) and len(got) == 40


def test_a_dead_writer(spark, tmp_path):
    table = bucketed(spark, tmp_path / "t")
    table.replace(pairs(spark, [("a", 1)]))
    (tmp_path / "t" / "manifest" / "0000000003.json").write_text('{"folders": [')
    assert [tuple(r) for r in table.read().collect()] == [("a", 1)]
    with pytest.raises(ConcurrentWrite, match="recover"):
        table.replace(pairs(spark, []))
    table.recover()
    table.replace(pairs(spark, []))
    assert table.read().count() == 0


# -- retrieval -------------------------------------------------------------------------

CORPUS = ["granite carving", "marble carving", "baking bread", "baking with granite"]


def make_retriever(spark, completions=None, texts=CORPUS):
    rows = [(f"chunk_{i}", t, "even" if i % 2 == 0 else "odd", i) for i, t in enumerate(texts)]
    chunks = spark.createDataFrame(rows, "chunk_id string, original_content string, document string, page_number int")
    for name, kind in (
        ("chunk_index", "int"), ("chunk_type", "string"), ("section_title", "string"), ("element_count", "int"),
        ("token_count", "int"), ("has_image", "boolean"), ("image_description", "string"), ("filetype", "string"),
    ):
        chunks = chunks.withColumn(name, F.lit(None).cast(kind))
    encode = lambda text: hash_embedding(text, 32)
    vectors = prepare_vectors(chunks, encode(F.col("original_content")))
    assert set(vectors.columns) == {f.name for f in VECTORS.fields}
    made = Retriever(vectors, encode, completions)
    corpus = chunks.select("chunk_id", F.col("original_content").alias("content"))
    return made, corpus


def answers(spark, requests, task, response):
    return requests.select(F.lit(task).alias("task"), "request_id", F.lit(response).alias("response"))


def test_search_and_filters(spark):
    search, _ = make_retriever(spark)
    queries = asked(spark, "granite carving")
    assert search.search(queries, 2, include_metadata=False).columns == ["query_id", "rank", "chunk_id", "score"]
    first = search.search(queries, 2).orderBy("rank").first()
    assert (first.chunk_id, first.content, first.document) == ("chunk_0", "granite carving", "even")
    assert {r.document for r in search.search_by_document(queries, "odd").collect()} == {"odd"}
    assert {r.page_number for r in search.search_by_page_range(queries, 1, 2).collect()} == {1, 2}
    assert search.search_by_type(queries, "table").count() == 0
    assert search.search_combined(queries, min_page=1, document="even").first().chunk_id == "chunk_2"


def test_hybrid(spark):
    search, corpus = make_retriever(spark)
    queries = asked(spark, "granite carving")
    assert search.hybrid_search(queries, 3).count() == 3  # no lexical side yet
    search.index_for_bm25(corpus)
    assert search.hybrid_search(queries, 3).orderBy("rank").first().chunk_id == "chunk_0"
    # The lexical side knows no filter: its hits come with their full text and a source.
    filtered = search.hybrid_search(queries, 4, filters={"document": {"$eq": "odd"}}).collect()
    by_words = {r.chunk_id: (r.content, r.document) for r in filtered if r.source == "bm25"}
    assert by_words == {"chunk_0": ("granite carving", None)}


def test_rank_fusion_scores(spark):
    dense = spark.createDataFrame([(0, 1, "a"), (0, 2, "b")], "query_id long, rank int, chunk_id string")
    words = spark.createDataFrame([(0, 1, "b"), (0, 2, "c")], "query_id long, rank int, chunk_id string")
    scores = {r.chunk_id: r.score for r in fusion.rank_fusion(dense, words, 5).collect()}
    assert scores == {
        "a": pytest.approx(0.7 / 61), "b": pytest.approx(0.7 / 62 + 0.3 / 61), "c": pytest.approx(0.3 / 62)
    }


def test_expand(spark):
    queries = asked(spark, "test query")
    response = answers(spark, fusion.expand_requests(queries, 3), "expand", "\nvariation one\n\n variation two\nthree\nfour")
    rows = fusion.expand_queries(queries, response, 3).orderBy("variant").collect()
    assert [r.search_text for r in rows] == ["test query", "variation one", "variation two", "three"]
    assert [r.search_text for r in fusion.expand_queries(queries, None).collect()] == ["test query"]


def test_expanded_mean_is_over_variants_that_hit(spark):
    hits = spark.createDataFrame([(0, "a", 1.0), (0, "a", 0.5), (0, "b", 0.8)], "query_id long, chunk_id string, score double")
    rows = fusion.mean_scores(hits, 5).orderBy("rank").collect()
    assert [(r.chunk_id, r.score) for r in rows] == [("b", 0.8), ("a", 0.75)]


def test_hyde(spark):
    queries = asked(spark, "which one")
    response = answers(spark, fusion.hyde_requests(queries), "hyde", "baking bread")
    search, _ = make_retriever(spark, response)
    first = search.hyde_search(queries, 1).first()
    assert (first.chunk_id, first.hyde_query) == ("chunk_2", "baking bread")
    plain, _ = make_retriever(spark)
    rows = plain.hyde_search(queries, 2).collect()
    assert {r.chunk_id for r in rows} == {r.chunk_id for r in plain.search(queries, 2).collect()}
    assert all(r.hyde_query is None for r in rows)


@pytest.mark.parametrize(
    "response,expected",
    [
        ("3, 1, 2", ["chunk_2", "chunk_0", "chunk_1"]),
        ("2", ["chunk_1", "chunk_0", "chunk_2"]),
        ("0, 7, 3 3, 99999999999999999999", ["chunk_2", "chunk_0", "chunk_1"]),
        ("none", ["chunk_0", "chunk_1", "chunk_2"]),
        (None, ["chunk_0", "chunk_1", "chunk_2"]),
    ],
)
def test_rerank(spark, response, expected):
    rows = [(0, i + 1, f"chunk_{i}", 0.9 - i / 10, f"content {i}") for i in range(3)]
    results = spark.createDataFrame(rows, "query_id long, rank int, chunk_id string, score double, content string")
    responses = spark.createDataFrame([(0, response)], "query_id long, response string")
    ranked = fusion.rerank(results, responses, 3).orderBy("rank").collect()
    assert [r.chunk_id for r in ranked] == expected
    assert {r.chunk_id: r.score for r in ranked} == {r[2]: r[3] for r in rows}
    assert fusion.rerank(results.limit(0), responses, 3).count() == 0


def test_rerank_through_requests(spark):
    search, _ = make_retriever(spark)
    queries = asked(spark, "granite carving")
    results = search.search(queries, 4)
    response = answers(spark, fusion.rerank_requests(queries, results), "rerank", "2, 1")
    search.completions = response
    before, after = (r.orderBy("rank").collect() for r in (results, search.rerank(queries, results, 2)))
    assert [r.chunk_id for r in after] == [before[1].chunk_id, before[0].chunk_id]


def test_advanced(spark):
    queries = asked(spark, "granite carving", "baking")
    plain, _ = make_retriever(spark)
    off = plain.advanced_search(queries, 2, use_hyde=False, use_expansion=False, use_reranking=False).collect()
    assert {(r.query_id, r.rank, r.chunk_id) for r in off} == {
        (r.query_id, r.rank, r.chunk_id) for r in plain.search(queries, 2).collect()
    }
    # Without responses every method falls back to plain search: same means, same order.
    everything = plain.advanced_search(queries, 2).collect()
    assert {(r.query_id, r.rank, r.chunk_id) for r in everything} == {(r.query_id, r.rank, r.chunk_id) for r in off}


def test_cards_and_json(spark):
    search, _ = make_retriever(spark, texts=["line one\nline two"])
    results = search.search(asked(spark, "one"), 1)
    card = fusion.result_cards(results).first()
    assert (card.preview, card.document, card.section_title, card.chunk_type) == ("line one line two...", "even", None, "text")
    assert len(card.score.split(".")[1]) == 4
    assert '"content":"line one\\nline two"' in fusion.results_json(results).first().json


def test_null_and_odd_vectors(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 1.0])], "id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [0.0, 1.0])], "query_id long, embedding array<float>")
    found = {r.id: r.score for r in vector.dense_topk(rows, queries, 3).collect()}
    assert found == {"a": 0.0, "b": 0.0, "c": 1.0}
    odd = rows.unionByName(spark.createDataFrame([("d", [1.0, 0.0, 0.0, 1.0])], rows.schema))
    with pytest.raises(Exception, match="vectors must have 2 numbers"):
        vector.dense_topk(odd, queries, 3).collect()


def test_contents_come_from_few_folders(spark, tmp_path):
    """Hits are turned into bucket numbers; folders of other buckets are not read."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["granite", "marble", "baking", "bread", "carving", "rose", f"w{n}"], k=6)) for n in range(300)]
    records = spark.createDataFrame([(f"c{n}", t, t) for n, t in enumerate(texts)], "chunk_id string, original_content string, text string")
    for name, kind in (("document", "string"), ("chunk_type", "string"), ("section_title", "string"), ("filetype", "string"), ("image_description", "string"), ("chunk_index", "int"), ("page_number", "int"), ("element_count", "int"), ("token_count", "int"), ("has_image", "boolean")):
        records = records.withColumn(name, F.lit(None).cast(kind))
    encode = lambda text: hash_embedding(text, 16)
    table = VectorTable(spark, str(tmp_path / "index"), 16, buckets=64)
    table.index_chunks(prepare_vectors(records, encode(F.col("text"))))
    vectors, buckets = table.read_buckets()
    stored = Retriever(vectors, encode, buckets=buckets)
    plain = Retriever(table.read(), encode)
    queries = asked(spark, "granite carving", "w17 bread")
    corpus = records.select("chunk_id", F.col("text").alias("content"))
    for search in (stored, plain):
        search.index_for_bm25(corpus)
    found = stored.hybrid_search(queries, 3)
    want = sorted(map(str, plain.hybrid_search(queries, 3).collect()))
    got = found.collect()
    assert sorted(map(str, got)) == want and len(got) == 6

    def scans(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return scans(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return scans(node.plan())
        own = [node] if node.nodeName().startswith("Scan") and node.metrics().contains("numFiles") else []
        children = node.children()
        return own + [s for n in range(children.size()) for s in scans(children.apply(n))]

    read = [int(s.metrics().apply("numFiles").value()) for s in scans(found._jdf.queryExecution().executedPlan())]
    # The contents are read from the folders of six hits at most, of 64.
    assert len(table.read().inputFiles()) > 50 and 0 < max(read) <= 6


# -- memory of the workers ---------------------------------------------------------------


def test_vectors_of_a_large_batch_take_no_more_memory_than_those_of_a_small_one(monkeypatch):
    from quarry.functions import encoder

    rng = random.Random(4)
    rows = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(60))] for _ in range(400)] + [[], None]
    lists = pa.array(rows, pa.list_(pa.string()))
    whole = encoder.hash_vectors(lists, 16)
    assert len(whole) == len(rows) and whole[400].as_py() == [0.0] * 16

    def expected(words):
        vector = np.zeros(16)
        for word in words or []:
            digest = hashlib.md5(word.encode()).hexdigest()
            vector[int(digest[:8], 16) % 16] += 1.0 if digest[8] < "8" else -1.0
        return vector / (np.linalg.norm(vector) or 1.0)

    assert all(np.allclose(got, expected(words), atol=1e-6) for got, words in zip(whole.to_pylist(), rows))
    monkeypatch.setattr(encoder, "MAX_WORDS", 7)
    monkeypatch.setattr(encoder, "MAX_CELLS", 48)
    assert encoder.hash_vectors(lists, 16) == whole
    assert encoder.hash_vectors(lists.slice(3, 0), 16).to_pylist() == []


def test_words_seen_before_are_not_hashed_again(monkeypatch):
    from quarry.functions import encoder

    lists = pa.array([["pit", "stone", "pit"]], pa.list_(pa.string()))
    first = encoder.hash_vectors(lists, 16)
    monkeypatch.setattr(encoder.hashlib, "md5", None)
    assert encoder.hash_vectors(lists, 16) == first


def test_a_batch_for_the_index_is_encoded_once(spark, tmp_path, monkeypatch):
    plans = []

    def seen(table):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        return table.localCheckpoint()

    monkeypatch.setattr("quarry.operators.index.cut_lineage", seen)
    texts = spark.createDataFrame([("a", "one two"), ("b", None)], "chunk_id string, text string")
    records = record(spark).drop("chunk_id", "embedding").crossJoin(texts)
    table = VectorTable(spark, str(tmp_path / "t"), 4, buckets=2)
    table.index_chunks(prepare_vectors(records, hash_embedding(F.col("text"), 4)))
    assert plans[0].count("ArrowEvalPython") == 1
    assert table.stats()["total_vectors"] == 2
    with pytest.raises(Exception, match="vectors must have 4 numbers"):
        table.index_chunks(prepare_vectors(records, F.lit(None).cast("array<float>")))


def test_batches_are_taken_apart_in_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500))], ["x"])
    parts = list(ranking.slices([batch, batch.slice(0, 3)]))
    assert [p.num_rows for p in parts] == [1024, 1024, 452, 3]
    assert parts[1].column("x")[0].as_py() == 1024
    assert ranking.MAX_HELD_SCORES * 8 <= 4_000_000
