import pytest
from pyspark.sql import functions as F

from conftest import TABLE_2X2, metadata
from quarry.functions.encoder import hash_embedding
from quarry.operators import elements as E
from quarry.operators import enrich
from quarry.operators.borders import ChunkParams
from quarry.operators.asking import AnswerStore
from quarry.operators.chunking import chunk_elements
from quarry.schemas import EMBEDDING_CACHE
from quarry.sources.versioned import VersionedTable


def completions(spark, rows):
    return spark.createDataFrame(rows, "task string, request_id string, response string")


def test_valid_elements(make_elements):
    rows = [
        ("Image", "has text", metadata()),
        ("Image", "", metadata(image_base64="eA==")),
        ("Table", " ", metadata(text_as_html=TABLE_2X2)),
        (None, "text", metadata()),
        ("Title", None, metadata()),
    ]
    assert [r.pos for r in E.valid_elements(make_elements(rows)).collect()] == [1, 3]


def test_document_text_has_what_chunks_drop(make_elements):
    rows = [
        ("Image", " image text ", metadata()),
        ("Table", " ", metadata(text_as_html=TABLE_2X2)),
        ("Table", " plain ", metadata(text_as_html="  ")),
        ("Title", None, metadata()),
    ]
    elements = make_elements(rows)
    text = "image text\n\n| Stone | Weight |\n| --- | --- |\n| slate | heavy |\n\nplain"
    assert E.document_parts(elements).first().text == text
    parts = E.document_parts(elements, part_rows=2).orderBy("part").collect()
    assert "\n\n".join(p.text for p in parts) == text and len(parts) == 2


def test_images(spark, make_elements):
    images = ["YQ==", "Yg==", "Yw=="]
    elements = make_elements([("Image", "", metadata(image_base64=i, filetype="gif")) for i in images])
    requests = {r.image_base64: r for r in E.image_requests(elements).collect()}
    assert requests["YQ=="].media_type == "image/gif"
    answers = [("image", requests["YQ=="].request_id, " a cat "), ("image", requests["Yg=="].request_id, "")]
    rows = E.describe_images(elements, completions(spark, answers)).orderBy("pos").collect()
    assert [r.text for r in rows] == [
        "[IMAGE] a cat",
        "[IMAGE] [Image: description unavailable - empty response]",
        "[IMAGE] [Image: description unavailable]",
    ]
    assert rows[0].metadata.image_description == "a cat" and rows[0].metadata.has_image is True


@pytest.mark.parametrize("block_rows", [2, 20_000])
def test_running_values_over_blocks(make_elements, block_rows):
    kinds = ["NarrativeText", "Title", "Table", "NarrativeText", "Image", "NarrativeText", "Title", "Table"]
    rows = [(k, f"t{i}", metadata(image_base64="eA==")) for i, k in enumerate(kinds)]
    elements = make_elements(rows)
    titles = E.section_titles(elements, block_rows).orderBy("pos").collect()
    assert [r.section_title for r in titles] == [None, "t1", "t1", "t1", "t1", "t1", "t6", "t6"]
    segments = E.hard_segments(elements, block_rows).orderBy("pos").collect()
    assert [r.segment for r in segments] == [0, 0, 1, 1, 2, 2, 2, 3]


@pytest.mark.parametrize(
    "title,page,expected",
    [
        ("Intro", 3, "This chunk is from d in the Intro section on page 3."),
        ("", 0, "This chunk is from d."),
        (None, None, "This chunk is from d."),
    ],
)
def test_context_fallback(spark, title, page, expected):
    row = spark.createDataFrame([("d", title, page)], "d string, t string, p int")
    assert row.select(enrich.context_fallback(F.col("d"), F.col("t"), F.col("p"))).first()[0] == expected


def test_context_from_responses(spark, make_elements):
    elements = make_elements([("NarrativeText", "a b c", metadata()), ("NarrativeText", "d e f", metadata())])
    chunks = chunk_elements(elements, ChunkParams("basic", 1, 3))
    parts = E.document_parts(elements)
    requests = enrich.context_requests(chunks, parts)
    first = requests.filter("chunk_id = 'doc_chunk_0'").first()
    answers = completions(spark, [("context", first.request_id, " About a. ")])
    contexts = {r.chunk_id: r.context for r in enrich.with_context(chunks, parts, answers).collect()}
    assert contexts == {"doc_chunk_0": "About a.", "doc_chunk_1": "This chunk is from doc."}
    assert [r.chunk_id for r in enrich.unanswered(requests, answers, "context").collect()] == ["doc_chunk_1"]
    prompt = enrich.context_prompts(requests, chunks, parts).filter("chunk_id = 'doc_chunk_0'").first().prompt
    assert prompt.startswith("<document>\na b c\n\nd e f\n</document>\n\n<chunk>\na b c\n</chunk>\n\nPlease give")


def test_context_of_a_document_in_parts(spark, make_elements):
    elements = make_elements([("NarrativeText", "a b c", metadata()), ("NarrativeText", "d e f", metadata())])
    chunks, parts = chunk_elements(elements, ChunkParams("basic", 1, 3)), E.document_parts(elements, part_rows=1)
    assert parts.count() == 2
    requests = enrich.context_requests(chunks, parts)
    ids = {r.chunk_id: r.request_id for r in requests.collect()}
    assert sorted(ids) == ["doc_chunk_0", "doc_chunk_1"]
    prompts = {r.prompt.split("</document>")[0] for r in enrich.context_prompts(requests, chunks, parts).collect()}
    assert prompts == {"<document>\na b c\n\nd e f\n"}
    answers = completions(spark, [("context", ids["doc_chunk_1"], "The end.")])
    contexts = {r.chunk_id: r.context for r in enrich.with_context(chunks, parts, answers).collect()}
    assert contexts == {"doc_chunk_0": "This chunk is from doc.", "doc_chunk_1": "The end."}


def test_cache(spark):
    texts = spark.createDataFrame([("text1",), ("text1",), ("text2",)], "text string")
    assert enrich.cache_statistics(texts).first().asDict() == {"calls": 3, "hits": 1, "misses": 2}
    empty = spark.createDataFrame([], "text_sha string, embedding array<float>")
    assert enrich.cache_statistics(texts.limit(0)).first().asDict() == {"calls": 0, "hits": 0, "misses": 0}
    encoder = enrich.Encoder(dimensions=8)
    filled = enrich.fill_cache(texts, empty, encoder.encode)
    assert filled.count() == 2 and enrich.embedding_misses(texts, filled).count() == 0
    embedded = enrich.embed_texts(texts, filled, 8).collect()
    assert len(embedded) == 3 and all(any(r.embedding) for r in embedded)


def test_missing_vector_is_zero(spark):
    texts = spark.createDataFrame([("text1",)], "text string")
    empty = spark.createDataFrame([], "text_sha string, embedding array<float>")
    assert enrich.embed_texts(texts, empty, 512).first().embedding == [0.0] * 512


def test_hash_embedding(spark):
    rows = spark.createDataFrame([("a b a",), ("A, b; a!",), ("",), (None,)], "t string")
    plain, same, empty, null = [r[0] for r in rows.select(hash_embedding(F.col("t"), 16)).collect()]
    assert plain == same and sum(x * x for x in plain) == pytest.approx(1.0)
    assert empty == null == [0.0] * 16
    raw = rows.select(hash_embedding(F.col("t"), 16, normalize=False)).first()[0]
    assert sorted(abs(x) for x in raw if x) == [1.0, 2.0]


def test_ask_fills_what_is_missing(spark):
    requests = spark.createDataFrame([("1", "say a"), ("1", "say a"), ("2", "say b"), ("3", "fail")], "request_id string, prompt string")
    known = completions(spark, [("hyde", "2", "b"), ("other", "1", "x")])
    answer = lambda prompt: F.when(prompt != "fail", F.substring(prompt, 5, 9))
    filled = enrich.ask(requests, known, "hyde", answer)
    assert {tuple(r) for r in filled.collect()} == {("hyde", "2", "b"), ("other", "1", "x"), ("hyde", "1", "a")}


def test_stored_cache(spark, tmp_path):
    store = VersionedTable(spark, str(tmp_path / "cache"), EMBEDDING_CACHE)
    assert not store.exists()
    store.clear()
    texts = spark.createDataFrame([("a",), ("b",), ("a",)], "text string")
    for expected in (2, 2):
        store.replace(enrich.fill_cache(texts, store.read(), enrich.Encoder(dimensions=4).encode))
        assert store.read().count() == expected
    store.clear()
    assert store.read().count() == 0


def test_repeated_answers_count_once(spark):
    requests = spark.createDataFrame([("1",), ("2",)], "request_id string")
    known = completions(spark, [("hyde", "1", "b"), ("hyde", "1", "a"), ("hyde", "1", ""), ("hyde", "2", "")])
    assert {tuple(r) for r in enrich.respond(requests, known, "hyde").collect()} == {("1", "a"), ("2", "")}


def test_answers_are_kept_and_failures_are_rows(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "answers"))
    requests = spark.createDataFrame([(str(n), f"prompt {n}") for n in range(10)] + [("3", "prompt 3")], "request_id string, prompt string")

    def flaky(prompts):
        if "prompt 4" in prompts:
            raise TimeoutError("slow")
        return [None if p == "prompt 7" else p.upper() for p in prompts]

    log = {r.request_id: r for r in store.ask(requests.coalesce(1), "up", flaky, batch=2).collect()}
    failed = {k for k, r in log.items() if not r.answered}
    # One batch of two failed as a whole, and one request had no response; no other lost anything.
    assert len(log) == 10 and {"4", "7"} <= failed and len(failed) == 3
    assert log["4"].last_error == "TimeoutError: slow" and log["7"].last_error == "no response"
    for _ in range(3):
        store.ask(requests, "up", flaky, batch=1)
    log = {r.request_id: r for r in store.log().collect()}
    assert {k for k, r in log.items() if not r.answered} == {"4", "7"} and log["4"].attempts == log["7"].attempts == 3
    assert store.answers().count() == 10 + 3 + 2 and store.completions().count() == 8
    assert store.open_requests(requests, "up").count() == 0 and store.open_requests(requests, "other").count() == 10
    bad = store.ask(requests.filter("request_id = '1'"), "short", lambda prompts: []).first()
    assert not bad.answered and bad.last_error == "ValueError: 0 responses for 1 prompts"
