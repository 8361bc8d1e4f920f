import random

import pytest
from pyspark.sql import functions as F

import model
from conftest import SAMPLE, metadata
from quarry.operators import chunking
from quarry.operators.borders import PIPELINE_PARAMS, ChunkParams, Grouping
from quarry.operators.chunking import chunk_elements, chunk_records, chunk_rows, chunk_texts, rows_of_arrays
from quarry.plans import ingest
from quarry.schemas import ELEMENTS


def test_defaults():
    assert (ChunkParams().min_tokens, ChunkParams().max_tokens, ChunkParams().overlap) == (300, 1000, 0.0)
    assert (PIPELINE_PARAMS.min_tokens, PIPELINE_PARAMS.max_tokens, PIPELINE_PARAMS.overlap) == (400, 800, 0.15)
    assert ChunkParams().similarity == 0.70


def test_unknown_strategy():
    with pytest.raises(ValueError):
        ChunkParams("other")


def random_documents(seed, n_documents=12, longest=60):
    rng = random.Random(seed)
    documents = {}
    for d in range(n_documents):
        rows = []
        for _ in range(rng.randint(1, longest)):
            kind = rng.choices(["NarrativeText", "Title", "Table", "Image"], [12, 3, 1, 1])[0]
            words = [rng.choice(["a", "be", "sea,", "dog.", "été", "x_1", "(no)"]) for _ in range(rng.randint(0, 30))]
            rows.append((kind, " ".join(words) + rng.choice(["", " ", "."])))
        documents[f"d{d}"] = rows
    return documents


def elements_of(spark, documents):
    rows = []
    for name, elements in documents.items():
        for i, (kind, text) in enumerate(elements):
            rows.append((name, i, kind, text, metadata(image_base64="eA==" if kind == "Image" else None)))
    return spark.createDataFrame(rows, ELEMENTS)


def got(chunks):
    rows = chunks.select(
        "document", "chunk_index", "original_content", "section_title", "chunk_type", "element_count"
    ).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        found.setdefault(r[0], []).append(tuple(r[1:]))
    return found


def expected(documents, *args, vectors=None, **kwargs):
    found = {n: model.chunks(e, *args, vectors=vectors and vectors[n], **kwargs) for n, e in documents.items()}
    return {n: c for n, c in found.items() if c}


@pytest.mark.parametrize("ratio", [0.0, 0.15, 0.5])
@pytest.mark.parametrize("low,high", [(20, 60), (1, 10), (50, 50)])
def test_basic_like_model(spark, low, high, ratio):
    documents = random_documents(low * 7 + int(ratio * 100))
    chunks = chunk_elements(elements_of(spark, documents), ChunkParams("basic", low, high, ratio))
    assert got(chunks) == expected(documents, low, high, ratio)


@pytest.mark.parametrize("ratio", [0.0, 0.3])
def test_semantic_like_model(spark, ratio):
    documents = random_documents(5)
    rng = random.Random(3)
    vectors = {
        n: [[rng.choice([0.0, 1.0, -0.5, 0.25]) for _ in range(3)] for _ in e] for n, e in documents.items()
    }
    rows = [(n, i, v) for n, vs in vectors.items() for i, v in enumerate(vs)]
    table = spark.createDataFrame(rows, "document string, pos int, vector array<float>")
    elements = elements_of(spark, documents).join(table, ["document", "pos"])
    chunks = chunk_elements(elements, ChunkParams("semantic", 20, 60, ratio, 0.7))
    assert got(chunks) == expected(documents, 20, 60, ratio, threshold=0.7, vectors=vectors)


@pytest.mark.parametrize("ratio", [0.0, 0.3])
@pytest.mark.parametrize("alike", [False, True])
def test_long_documents_like_whole_ones(spark, ratio, alike):
    """Blocks of few rows give what one task over the whole document gives."""
    documents = random_documents(11, n_documents=3, longest=400)
    if alike:  # equal lines: the groups of neighbouring blocks never fall into step by themselves
        documents = {"same": [("NarrativeText", "one two three four five six seven")] * 500, "short": documents["d0"][:9]}
    elements = elements_of(spark, documents)
    params = ChunkParams("basic", 20, 60, ratio)
    in_blocks = chunk_elements(elements, params, block_rows=70)
    assert got(in_blocks) == expected(documents, 20, 60, ratio)


def test_long_documents_semantic(spark):
    documents = random_documents(2, n_documents=2, longest=300)
    rng = random.Random(1)
    rows = [(n, i, [rng.random() - 0.3 for _ in range(3)]) for n, e in documents.items() for i in range(len(e))]
    table = spark.createDataFrame(rows, "document string, pos int, vector array<float>")
    elements = elements_of(spark, documents).join(table, ["document", "pos"])
    params = ChunkParams("semantic", 20, 60, 0.2, 0.7)
    assert got(chunk_elements(elements, params, block_rows=70)) == got(chunk_elements(elements, params))


@pytest.mark.parametrize("ratio", [0.0, 0.15, 0.5])
@pytest.mark.parametrize("block_rows", [None, 70])
def test_groups_over_several_stretches(spark, monkeypatch, ratio, block_rows):
    """Texts stand in rows of few positions; groups of several rows, titles of earlier ones."""
    monkeypatch.setattr(chunking, "STRETCH", 5)
    documents = random_documents(21, n_documents=4, longest=200)
    documents["one title"] = [("Title", "Top"), *[("NarrativeText", f"word {n} of many, many words") for n in range(60)]]
    elements = elements_of(spark, documents)
    # Places left out of the numbering, and elements without a document.
    gaps = elements.withColumn("pos", F.col("pos") * 3 + F.when(F.col("pos") > 40, 100).otherwise(0))
    chunks = chunk_elements(gaps, ChunkParams("basic", 20, 60, ratio), block_rows)
    assert got(chunks) == expected(documents, 20, 60, ratio)
    nameless = gaps.withColumn("document", F.when(F.col("document") != "d0", F.col("document")))
    assert got(chunk_elements(nameless.filter("document is null"), ChunkParams("basic", 20, 60, ratio), block_rows))[""] == got(chunks)["d0"]


def test_a_way_through_hundreds_of_blocks(spark):
    """Ways through blocks are composed in rounds that grow with the digits of their number."""
    rng = random.Random(8)
    rows = [(rng.choice(["NarrativeText"] * 9 + ["Title"]), " ".join(["word"] * rng.randint(1, 9))) for _ in range(6000)]
    documents = {"long": rows, "short": rows[:30]}
    params = ChunkParams("basic", 5, 15, 0.4)
    blocks = chunking.blocks_of(chunking.stretches_of(elements_of(spark, documents)), params, 20)
    assert blocks.count() > 300
    nodes = chunking.entry_nodes(blocks, params).filter("document = 'long'").collect()
    assert sorted(r.block for r in nodes) == list(range(300))
    assert got(chunk_elements(elements_of(spark, documents), params, block_rows=20)) == expected(documents, 5, 15, 0.4)


def test_no_payload_by_document(spark):
    """Documents are gathered as numbers; texts and images only stand in rows of a stretch."""
    elements = elements_of(spark, random_documents(3))
    plan = chunk_elements(elements, ChunkParams("basic", 20, 60, 0.2))._jdf.queryExecution().optimizedPlan().toString()
    by_document = [line for line in plan.split("\n") if "Aggregate [document#" in line and "], [" in line and "stretch" not in line.split("], [")[0]]
    by_document = [line for line in by_document if "ordinal" not in line.split("], [")[0]]
    assert by_document and all("tokens" in line and "image_base64" not in line and "body" not in line for line in by_document)


def test_last_block_without_a_group_of_its_own(spark):
    documents = {"same": [("NarrativeText", "one two three four five six seven eight")] * 76}
    chunks = chunk_elements(elements_of(spark, documents), ChunkParams("basic", 20, 60, 0.1), block_rows=75)
    assert got(chunks) == expected(documents, 20, 60, 0.1)


def test_block_holds_a_group(spark):
    """A block shorter than a group may be is made longer."""
    documents = random_documents(12, n_documents=2, longest=300)
    assert got(chunk_elements(elements_of(spark, documents), ChunkParams("basic", 20, 60), block_rows=5)) == expected(
        documents, 20, 60, 0.0
    )


def test_images_are_not_lent(make_elements):
    """An image ends a group, so a block of images lends its first ones only."""
    image = ("Image", "", metadata(image_base64="eA==", filetype="png"))
    blocks = chunking.blocks_of(chunking.stretches_of(make_elements([image] * 200)), ChunkParams("basic", 20, 60), 100)
    assert {(r.block, r.own): r.lent for r in blocks.collect()} == {(0, 100): 0, (1, 100): 2}


def test_arrays_and_table_agree(spark):
    documents = random_documents(4)
    elements = elements_of(spark, documents)
    arrays = elements.groupBy("document").agg(F.array_sort(F.collect_list(F.struct("pos", "type", "text", "metadata"))).alias("elements"))
    params = ChunkParams("basic", 20, 60, 0.2)
    assert got(chunk_rows(rows_of_arrays(arrays), params)) == got(chunk_elements(elements, params))


def test_sample_document(make_elements):
    chunks = chunk_records(chunk_elements(make_elements(SAMPLE[:4]), ChunkParams("basic", 10, 100))).collect()
    assert len(chunks) >= 1
    assert [c.chunk_type for c in chunks].count("table") == 1
    table = next(c for c in chunks if c.chunk_type == "table")
    assert table.original_content == "| Stone | Weight |\n| --- | --- |\n| slate | heavy |"
    assert (table.section_title, table.page_number, table.has_image) == ("Overview", 2, None)
    text = next(c for c in chunks if c.chunk_type == "text")
    assert text.has_image is False and text.chunk_id == "doc_chunk_0"


def test_blank_chunk_leaves_a_gap(make_elements):
    blank = ("Table", "x", metadata(text_as_html="<table></table>"))
    rows = [("NarrativeText", "one", metadata()), blank, ("NarrativeText", "two", metadata())]
    chunks = chunk_elements(make_elements(rows), ChunkParams()).orderBy("chunk_index").collect()
    assert [(c.chunk_index, c.original_content) for c in chunks] == [(0, "one"), (2, "two")]


def test_below_minimum_may_exceed_maximum(make_elements):
    rows = [("NarrativeText", "a b", metadata()), ("NarrativeText", "c " * 50, metadata())]
    chunks = chunk_elements(make_elements(rows), ChunkParams("basic", 10, 20)).collect()
    assert len(chunks) == 1 and chunks[0].text_tokens == 52


def test_no_overlap_after_a_table():
    walk = Grouping(ChunkParams("basic", 1, 4, 0.5), [4, 1, 4, 4], [0, 2, 0, 0]).groups(4, 0, 0)
    assert [g[4] for g in walk] == [-1, 0, 1, 2]
    assert [g[:3] for g in walk] == [(0, 1, 0), (1, 2, 0), (2, 3, 0), (3, 4, 2)]


def test_repeated_text_may_reach_back_several_groups(spark):
    long = " ".join(f"w{i}" for i in range(40))
    documents = {"d": [("NarrativeText", t) for t in (long, "a", "b", "c d", "e", long, "f", "g")]}
    chunks = chunk_elements(elements_of(spark, documents), ChunkParams("basic", 1, 10, 0.5))
    assert got(chunks) == expected(documents, 1, 10, 0.5)
    walk = Grouping(ChunkParams("basic", 1, 10, 0.5), [40, 1, 1, 2, 1], [0] * 5).groups(5, 0, 0)
    assert [g[4] for g in walk] == [-1, 0, 0, 0, 0]


def test_element_count_counts_the_overlap(make_elements):
    rows = [("NarrativeText", "a b c d", metadata()), ("NarrativeText", "e f g h", metadata())]
    chunks = chunk_elements(make_elements(rows), ChunkParams("basic", 2, 5, 0.5)).orderBy("chunk_index").collect()
    assert chunks[1].original_content == "[...] c d\n\ne f g h"
    assert chunks[1].element_count == 2
    assert chunks[1].text_tokens == model.count(chunks[1].original_content)


def test_token_count_is_of_contextualised_text(make_elements):
    rows = [("Title", "Intro", metadata(page_number=2)), ("NarrativeText", "Some words, here.", metadata(page_number=2))]
    record = ingest.chunk_documents(make_elements(rows)).first()
    assert record.contextualized_content == (
        "This chunk is from doc in the Intro section on page 2.\n\nIntro\n\nSome words, here."
    )
    assert record.token_count == model.count(record.contextualized_content)


def test_chunk_text_does_not_strip(make_elements):
    rows = [("NarrativeText", " a ", metadata()), ("NarrativeText", "  ", metadata()), ("NarrativeText", "b", metadata())]
    grouped = make_elements(rows).withColumn("chunk_ord", F.lit(0))
    assert chunk_texts(grouped).first().text == " a \n\nb"


def test_semantic_whole_way(sample):
    records = ingest.chunk_documents(sample, ChunkParams("semantic"), use_context=False)
    assert {r.chunk_type for r in records.collect()} == {"text", "table"}


def test_blocks_and_texts_come_from_elements_made_once(make_elements):
    source = make_elements(SAMPLE * 12).filter("document <> 'no such document'")
    plan = chunk_elements(source, ChunkParams("basic", 10, 20, 0.15), 25)._jdf.queryExecution().optimizedPlan().toString()
    assert "no such document" not in plan


def test_rows_of_texts_hold_them_once_and_no_vectors(spark):
    """Texts stood twice in each row that is shuffled, vectors in each that is joined."""
    elements = elements_of(spark, random_documents(5, 2)).withColumn("vector", F.array(F.lit(1.0)))
    stretches = chunking.stretches_of(elements)
    fields = stretches.schema["elements"].dataType.elementType.names
    assert stretches.columns == ["document", "stretch", "elements", "vectors"]
    assert "body" in fields and not {"text", "vector"} & set(fields)


def test_lengths_of_lines_are_counted_once(spark, tmp_path):
    """The length decides on the kind, which decides on nearly all else."""
    from quarry.workload import tables

    spark.createDataFrame([(1, "A line\nand another one")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = tables.mixed_elements(spark, str(tmp_path)).filter("type = 'Image'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS size#") <= 1 and "length(e#" not in plan and "length(text#" not in plan
