"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.functions.text import html_table_to_markdown, media_type, token_count, words
from quarry.functions.vectors import cosine
from quarry.operators import chunking, fusion, lexical
from quarry.operators import elements as E
from quarry.operators import enrich
from quarry.operators.asking import AnswerStore
from quarry.operators.borders import ChunkParams
from quarry.operators.index import VectorTable, compile_filter, index_stats, upsert, upsert_report
from quarry.operators.cells import CellTable
from quarry.operators.vector import dense_topk
from quarry.plans import ingest
from quarry.session import cut_lineage, scratch_folder
from quarry.schemas import CHUNK_JSON, ELEMENT_JSON
from quarry.sources import files, parsers
from quarry.sources.whole_files import write_files
from quarry.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

# Small groups, so that documents of a few lines are cut.
SMALL = ChunkParams(min_tokens=60, max_tokens=120)
SMALL_OVERLAP = ChunkParams(min_tokens=60, max_tokens=120, overlap=0.15)
SMALL_SEMANTIC = ChunkParams("semantic", min_tokens=60, max_tokens=120, overlap=0.15, similarity=0.7)
ENCODER = enrich.Encoder(dimensions=t.DIMENSIONS)

FILTERS = {"$and": [{"document": {"$gte": "doc_2"}}, {"page_number": {"$gte": 5, "$lte": 30}}, {"chunk_type": {"$eq": "text"}}]}


def query(function: Query) -> Query:
    REGISTERED[function.__name__] = function
    return function


def rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


def element_columns(elements: DataFrame) -> DataFrame:
    return elements.select("document", "pos", "type", "text", "metadata.*")


# -- files and elements -----------------------------------------------------------


@query
def extract_route(spark, sf_dir):
    suffixes = F.array(*[F.lit(s) for s in (".pdf", ".PPTX", ".docx", ".html", ".txt", ".md", ".csv", ".xyz")])
    name = F.concat(F.lit("/in/"), "source", F.lit("."), F.col("doc_id").cast("string"), suffixes[(F.col("doc_id") % 8).cast("int")])
    routed = files.route(t.documents(spark, sf_dir).select(name.alias("path")))
    return routed.select(
        "path",
        files.json_name(F.col("path")).alias("output"),
        "extension",
        "strategy",
        "hi_res_model_name",
        F.coalesce("infer_table_structure", "pdf_infer_table_structure").alias("tables"),
        F.array_join("extract_image_block_types", ",").alias("image_blocks"),
        "split_pdf_concurrency_level",
        F.array_join("languages", ",").alias("languages"),
    )


@query
def elements_from_text(spark, sf_dir):
    return t.elements(spark, sf_dir).select("document", "pos", "type", "text")


@query
def elements_from_html(spark, sf_dir):
    pages = t.given(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("document"), parsers.html_elements(F.col("html")).alias("elements")
    )
    return element_columns(parsers.explode_elements(pages)).select(
        "document", "pos", "type", "text", "text_as_html", "image_base64", "filetype"
    )


@query
def elements_from_csv(spark, sf_dir):
    row = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")]
    # Quoted notes with a comma, quotes and a line end; empty ones; a quote inside a plain cell.
    kind, priority = F.col("o_orderkey") % 4, F.col("o_orderpriority")
    note = (
        F.when(kind == 0, F.concat(F.lit('"by ""'), priority, F.lit('"", late\nor never"')))
        .when(kind == 1, '""')
        .when(kind == 2, F.concat(F.lit('5" '), priority))
        .otherwise(priority)
    )
    written = F.concat(F.concat_ws(" ,", *row), F.lit(","), note)
    content = F.concat(F.lit("key,customer, status ,priority,note\n\n"), written, F.lit("\r\n"))
    orders = t.given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("document"), parsers.csv_elements(content).alias("elements")
    )
    return element_columns(parsers.explode_elements(orders)).select("document", "pos", "type", "text", "text_as_html")


def _json_files(spark, sf_dir):
    """Element files, those of documents labelled toxic cut off in the middle."""
    arrays = t.text_arrays(spark, sf_dir)
    kept = F.transform("elements", lambda e: e.dropFields(*[f.name for f in ELEMENT_JSON.fields if f.name == "metadata"]))
    toxic = t.given(spark, sf_dir, "labels").filter("toxic = 1").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("document"), F.lit(True).alias("toxic")
    ).distinct()
    json = F.to_json(kept)
    return arrays.join(toxic, "document", "left").select(
        F.concat("document", F.lit(".json")).alias("filename"),
        F.when(F.col("toxic"), F.left(json, F.length(json) - 3)).otherwise(json).alias("content"),
    )


@query
def elements_from_json(spark, sf_dir):
    parsed = files.parse_elements(_json_files(spark, sf_dir))
    return files.elements_of_json(parsed).select("document", "pos", "type", "text")


@query
def extract_log(spark, sf_dir):
    return files.json_elements_log(files.parse_elements(_json_files(spark, sf_dir)))


@query
def extract_summary(spark, sf_dir):
    return files.extract_summary(extract_log(spark, sf_dir))


def _source_files(spark, sf_dir):
    """A folder of files: every document under one of four types, some empty, some cut in the middle of a sign."""
    folder = scratch_folder(spark)
    n, text = F.col("doc_id"), F.col("text").cast("binary")
    suffixes = F.array(*[F.lit(s) for s in (".txt", ".MD", ".pdf", ".xyz")])
    content = F.when(n % 5 == 0, F.concat(text, F.unhex(F.lit("C3")))).when(n % 7 != 0, text).otherwise(F.unhex(F.lit("")))
    name = F.concat(F.lit("doc_"), n.cast("string"), suffixes[(n % 4).cast("int")])
    write_files(t.documents(spark, sf_dir).select(name.alias("file"), content.alias("content")), folder)
    return folder


@query
def extract_files_log(spark, sf_dir):
    """The log of a folder with unknown types, empty and broken files."""
    return files.extract_log(files.extract(files.read_files(spark, _source_files(spark, sf_dir))))


@query
def elements_round_trip(spark, sf_dir):
    """Elements written as one JSON array per document and read back."""
    folder = scratch_folder(spark)
    files.write_element_files(t.mixed_elements(spark, sf_dir), folder)
    return element_columns(files.read_elements_json(spark, folder)).select(
        "document", "pos", "type", "text", "page_number", "text_as_html", "image_base64", "filetype"
    )


@query
def valid_elements(spark, sf_dir):
    return E.valid_elements(t.mixed_elements(spark, sf_dir)).select("document", "pos", "type", "text")


@query
def image_enriched_elements(spark, sf_dir):
    described = E.describe_images(t.mixed_elements(spark, sf_dir), t.image_completions(spark, sf_dir))
    return element_columns(described).select(
        "document", "pos", "type", "text", "image_description", "has_image", "image_base64"
    )


@query
def media_type_(spark, sf_dir):
    images = t.mixed_elements(spark, sf_dir).filter(F.col("type") == "Image")
    return images.groupBy(media_type(F.col("metadata.filetype")).alias("media_type")).agg(F.count(F.lit(1)).alias("n"))


REGISTERED["media_type"] = REGISTERED.pop("media_type_")


@query
def section_titles(spark, sf_dir):
    return E.section_titles(t.mixed_elements(spark, sf_dir))


@query
def hard_segments(spark, sf_dir):
    return E.hard_segments(t.mixed_elements(spark, sf_dir))


@query
def document_text(spark, sf_dir):
    return E.document_parts(t.mixed_elements(spark, sf_dir))


# -- scalar functions ---------------------------------------------------------------


@query
def token_counts(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", token_count(F.col("text")).alias("tokens"))


@query
def word_tokens(spark, sf_dir):
    found = t.documents(spark, sf_dir).select("doc_id", words(F.col("text")).alias("w"))
    return found.select("doc_id", F.size("w").alias("n_words"), F.md5(F.array_join("w", " ")).alias("words_md5"))


@query
def html_table_markdown(spark, sf_dir):
    source = t.elements(spark, sf_dir).select("document", "pos", t.table_html(F.col("text")).alias("html"))
    pages = t.given(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("document"), F.lit(-1).alias("pos"), "html"
    )
    both = source.unionByName(pages)
    return both.select("document", "pos", html_table_to_markdown(F.col("html")).alias("markdown"))


@query
def cosine_pairs(spark, sf_dir):
    left = t.given(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    right = left.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return left.join(right, "vec_id").select("vec_id", F.round(cosine(F.col("a"), F.col("b")), 6).alias("similarity"))


# -- chunks -------------------------------------------------------------------------

CHUNK_COLUMNS = (
    "chunk_id",
    "document",
    "chunk_index",
    "original_content",
    "contextualized_content",
    "token_count",
    "chunk_type",
    "section_title",
    "page_number",
    "has_image",
    "image_description",
    "filetype",
    "element_count",
)


@query
def chunk_basic(spark, sf_dir):
    chunks = chunking.chunk_elements(t.mixed_elements(spark, sf_dir), SMALL)
    return chunking.chunk_records(chunks).select(*CHUNK_COLUMNS)


@query
def chunk_overlap(spark, sf_dir):
    chunks = chunking.chunk_elements(t.mixed_elements(spark, sf_dir), SMALL_OVERLAP)
    return chunking.chunk_records(chunks).select(*CHUNK_COLUMNS)


# Groups of a line or two, and blocks that many documents exceed.
TINY = ChunkParams(min_tokens=10, max_tokens=20)
TINY_OVERLAP = ChunkParams(min_tokens=10, max_tokens=20, overlap=0.15)
SHORT_BLOCK = 25


@query
def long_chunk_overlap(spark, sf_dir):
    """Documents cut into short blocks give the chunks of whole ones."""
    chunks = chunking.chunk_elements(t.mixed_elements(spark, sf_dir), TINY_OVERLAP, SHORT_BLOCK)
    return chunking.chunk_records(chunks).select(*CHUNK_COLUMNS)


@query
def chunk_semantic(spark, sf_dir):
    mixed = t.mixed_elements(spark, sf_dir)
    chunks = chunking.chunk_elements(ingest.element_vectors(mixed, ENCODER), SMALL_SEMANTIC)
    return chunking.chunk_records(chunks).select(*CHUNK_COLUMNS)


@query
def chunk_text(spark, sf_dir):
    grouped = t.mixed_elements(spark, sf_dir).withColumn("chunk_ord", F.floor(F.col("pos") / 3).cast("int"))
    return chunking.chunk_texts(grouped)


@query
def chunk_records(spark, sf_dir):
    """Described images, context sentences from responses where there are any."""
    mixed = t.mixed_elements(spark, sf_dir)
    described = E.describe_images(mixed, t.image_completions(spark, sf_dir))
    chunks = cut_lineage(chunking.chunk_elements(described, SMALL))
    parts = E.document_parts(mixed)
    answered = enrich.with_context(chunks, parts, _context_completions(chunks, parts))
    return chunking.chunk_records(answered, F.col("context")).select(*CHUNK_COLUMNS)


def _context_completions(chunks, parts):
    requests = enrich.context_requests(chunks, parts).join(
        chunks.select("chunk_id", "chunk_index", "original_content"), "chunk_id"
    )
    # Equal chunks of equal documents are one request.
    return (
        requests.filter(F.col("chunk_index") % 2 == 0)
        .groupBy("request_id")
        .agg(F.min(F.concat(F.lit(" About "), F.left("original_content", F.lit(9)), F.lit("\n"))).alias("response"))
        .select(F.lit("context").alias("task"), "request_id", "response")
    )


@query
def chunk_documents(spark, sf_dir):
    """Text documents to chunk records in place, pipeline sizes, fallback context."""
    return ingest.chunk_arrays(t.text_arrays(spark, sf_dir)).select(*CHUNK_COLUMNS)


@query
def context_fallback(spark, sf_dir):
    chunks = chunking.chunk_elements(t.mixed_elements(spark, sf_dir), SMALL)
    return enrich.with_context(chunks).select("chunk_id", "context")


@query
def context_requests(spark, sf_dir):
    return _context_requests(spark, sf_dir, SMALL)


@query
def long_context_requests(spark, sf_dir):
    """Documents cut into short blocks ask what whole ones ask."""
    return _context_requests(spark, sf_dir, TINY, SHORT_BLOCK)


def _context_requests(spark, sf_dir, params, block_rows=None):
    mixed = t.mixed_elements(spark, sf_dir)
    chunks, parts = cut_lineage(chunking.chunk_elements(mixed, params, block_rows)), E.document_parts(mixed)
    prompts = enrich.context_prompts(enrich.context_requests(chunks, parts), chunks, parts)
    return prompts.select("chunk_id", "request_id", F.length("prompt").alias("chars"), F.md5("prompt").alias("prompt_md5"))


@query
def chunks_from_json(spark, sf_dir):
    """Chunk files written as JSON arrays and read back."""
    chunks = ingest.chunk_arrays(t.text_arrays(spark, sf_dir))
    arrays = chunks.select(
        F.concat("chunk_id", F.lit("_chunks.json")).alias("filename"),
        F.concat(F.lit("["), files.chunk_json(chunks), F.lit(",\n"), files.chunk_json(chunks), F.lit("]")).alias("content"),
    )
    return files.chunks_of_json(arrays).select("filename", "file_pos", *CHUNK_COLUMNS)


@query
def chunks_round_trip(spark, sf_dir):
    """Chunks written as one JSON array per document and read back."""
    folder = scratch_folder(spark)
    files.write_chunk_files(ingest.chunk_arrays(t.text_arrays(spark, sf_dir), SMALL), folder)
    return files.read_chunks_json(spark, folder).select("filename", "file_pos", *CHUNK_COLUMNS)


@query
def chunk_defaults(spark, sf_dir):
    """The limits of a chunker that is told nothing."""
    return chunking.chunk_records(chunking.chunk_elements(t.elements(spark, sf_dir), ChunkParams())).select(*CHUNK_COLUMNS)


# -- encoder and cache --------------------------------------------------------------


@query
def hash_embed(spark, sf_dir):
    """Non-zero numbers of the vector of each document."""
    encoded = t.documents(spark, sf_dir).select("doc_id", t.encode(F.col("text")).alias("v"))
    numbers = encoded.select("doc_id", F.posexplode_outer("v").alias("place", "value"))
    return numbers.filter("value <> 0").select("doc_id", "place", F.round(F.col("value").cast("double"), 6).alias("value"))


def _said(spark, sf_dir):
    """Texts to encode: all turns, and the queries twice."""
    turns = t.given(spark, sf_dir, "conversations").select("text")
    asked = t.queries(spark, sf_dir).select(F.col("query").alias("text"))
    return turns.unionByName(asked).unionByName(asked)


def _cache(spark, sf_dir):
    turns = t.given(spark, sf_dir, "conversations").filter("role = 'user'").select("text").distinct()
    return enrich.text_keys(turns).select("text_sha", t.encode(F.col("text")).alias("embedding"))


@query
def embed_texts(spark, sf_dir):
    """A text without a cached vector has zeros."""
    embedded = enrich.embed_texts(_said(spark, sf_dir), _cache(spark, sf_dir), t.DIMENSIONS)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    return embedded.select(F.md5("text").alias("text_md5"), F.round(total, 6).alias("total"), F.size("embedding").alias("dims"))


@query
def embedding_misses(spark, sf_dir):
    return enrich.embedding_misses(_said(spark, sf_dir), _cache(spark, sf_dir)).select("text_sha", F.length("text").alias("chars"))


@query
def embedding_cache_stats(spark, sf_dir):
    return enrich.cache_statistics(_said(spark, sf_dir))


@query
def ask_twice(spark, sf_dir):
    """Requests for the turns of users, sent twice to a model that at first fails for batches with a certain letter."""
    store = AnswerStore(spark, scratch_folder(spark))
    turns = t.given(spark, sf_dir, "conversations").filter("role = 'user' AND text IS NOT NULL")
    requests = turns.select(F.sha2("text", 256).alias("request_id"), F.col("text").alias("prompt"))

    def once(prompts: list[str]) -> list[str | None]:
        if any(len(p) % 7 == 0 for p in prompts):
            raise ConnectionError("not now")
        return [None if len(p) % 5 == 0 else f"said {len(p)}" for p in prompts]

    store.ask(requests, "echo", once, batch=1)
    store.ask(requests, "echo", lambda prompts: [f"again {len(p)}" for p in prompts], batch=16)
    answers = store.answers().groupBy("request_id").agg(
        F.count(F.lit(1)).alias("sent"), F.max("response").alias("response"), F.max("error").alias("error")
    )
    return answers


# -- index ----------------------------------------------------------------------------


@query
def prepare_vectors(spark, sf_dir):
    mixed = t.mixed_elements(spark, sf_dir)
    described = E.describe_images(mixed, t.image_completions(spark, sf_dir))
    records = chunking.chunk_records(chunking.chunk_elements(described, SMALL))
    vectors = ingest.index_records(records, ENCODER)
    # Of a vector: its numbers weighed by their places, and the largest.
    products = F.transform("embedding", lambda x, i: x.cast("double") * (i + 1))
    weighed = F.round(F.aggregate(products, F.lit(0.0), lambda total, x: total + x), 6)
    largest = F.round(F.array_max("embedding").cast("double"), 6)
    return vectors.select(*[c for c in vectors.columns if c != "embedding"], weighed.alias("weighed"), largest.alias("largest"))


def _sent(spark, sf_dir):
    """Every record of labelled documents again, with the label in its title and page."""
    labels = t.given(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("document"), "quality", "toxic"
    )
    old = t.vectors(spark, sf_dir).join(labels, "document")
    again = old.withColumn("section_title", F.concat(F.lit("quality "), F.col("quality").cast("string")))
    twice = old.withColumn("section_title", F.lit("resent")).withColumn("seq", F.lit(2)).filter("toxic = 1")
    renamed = again.withColumns({"id": F.concat(F.lit("new_"), "id"), "seq": F.lit(3)})
    return again.withColumn("seq", F.lit(1)).unionByName(twice).unionByName(renamed)


@query
def index_upsert(spark, sf_dir):
    table = upsert(t.vectors(spark, sf_dir), _sent(spark, sf_dir), [F.col("seq")])
    return table.select("id", "document", "section_title", "page_number")


@query
def index_upsert_sequence(spark, sf_dir):
    """Three batches into a stored table; who read it after the first one still sees that."""
    table = VectorTable(spark, scratch_folder(spark), t.DIMENSIONS, buckets=16)
    table.index_chunks(t.vectors(spark, sf_dir))
    held, sent = table.read(), _sent(spark, sf_dir)
    table.index_chunks(sent.filter("seq < 3"), [F.col("seq")])
    table.index_chunks(sent.filter("seq = 3"))
    seen = [rows.select(F.lit(name).alias("seen"), "id", "document", "section_title", "page_number") for name, rows in (("held", held), ("now", table.read()))]
    return seen[0].unionByName(seen[1])


@query
def index_lifecycle(spark, sf_dir):
    """Rows and width of a stored table when it is made, filled, looked up, compacted, emptied, and dropped."""
    table = VectorTable(spark, scratch_folder(spark), t.DIMENSIONS, buckets=8)
    steps = [("made", table.stats())]
    steps.append(("filled", table.index_chunks(t.vectors(spark, sf_dir))))
    labelled = t.given(spark, sf_dir, "labels").filter("toxic = 1").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("_chunk_0")).alias("id")
    )
    steps.append(("looked up", {"total_vectors": table.read_ids(labelled).count(), "dimensions": t.DIMENSIONS}))
    table.compact()
    table.clean_up()
    steps.append(("compacted", table.stats()))
    table.delete_all_vectors()
    steps.append(("emptied", table.stats()))
    table.delete_index()
    steps.append(("dropped", {"total_vectors": None, "dimensions": None} if not table.table.exists() else table.stats()))
    rows = [(step, found["total_vectors"], found["dimensions"]) for step, found in steps]
    return spark.createDataFrame(rows, "step string, total_vectors long, dimensions int")


@query
def index_stats_(spark, sf_dir):
    sent = _sent(spark, sf_dir)
    return upsert_report(sent, upsert(t.vectors(spark, sf_dir), sent, [F.col("seq")]))


REGISTERED["index_stats"] = REGISTERED.pop("index_stats_")


@query
def filter_expr(spark, sf_dir):
    return t.vectors(spark, sf_dir).filter(compile_filter(FILTERS)).select("id", "document", "page_number", "chunk_type")


# -- lexical --------------------------------------------------------------------------


def _index(spark, sf_dir):
    return lexical.forward_index(t.documents(spark, sf_dir))


def _kept_index(spark, sf_dir):
    """The index as it is kept for several passes."""
    return cut_lineage(_index(spark, sf_dir))


def _kept_statistics(index):
    return cut_lineage(lexical.statistics(index))


@query
def bm25_postings(spark, sf_dir):
    return lexical.postings(_index(spark, sf_dir))


@query
def bm25_stats(spark, sf_dir):
    stats = lexical.corpus_stats(_index(spark, sf_dir))
    return stats.select("n_docs", F.round("avg_doc_len", 6).alias("avg_doc_len"))


@query
def bm25_df(spark, sf_dir):
    return lexical.document_frequency(_index(spark, sf_dir))


@query
def bm25_idf(spark, sf_dir):
    return lexical.term_idf(_kept_index(spark, sf_dir)).select("term", "df", F.round("idf", 6).alias("idf"))


@query
def bm25_score(spark, sf_dir):
    """Every document with the query its number falls to, and every second one with the next query too."""
    asked = t.queries(spark, sf_dir)
    n = asked.count()
    numbers = t.documents(spark, sf_dir).select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("further"))
    place = (F.col("doc_id") + F.col("further")) % n
    pairs = numbers.filter((F.col("further") == 0) | (F.col("doc_id") % 2 == 0)).select("doc_id", place.alias("place"))
    numbered = asked.select("query_id", (F.row_number().over(Window.orderBy("query_id")) - 1).alias("place"))
    index = _kept_index(spark, sf_dir)
    return rounded(lexical.score(index, asked, pairs.join(numbered, "place"), kept=_kept_statistics(index)))


@query
def bm25_search(spark, sf_dir):
    index = _kept_index(spark, sf_dir)
    return rounded(lexical.search(index, t.queries(spark, sf_dir), 10, kept=_kept_statistics(index)))


# -- dense ----------------------------------------------------------------------------


@query
def dense_topk_(spark, sf_dir):
    return rounded(dense_topk(t.given_vectors(spark, sf_dir), t.query_vectors(spark, sf_dir), 10))


REGISTERED["dense_topk"] = REGISTERED.pop("dense_topk_")


@query
def dense_topk_dot(spark, sf_dir):
    found = dense_topk(t.given_vectors(spark, sf_dir), t.query_vectors(spark, sf_dir), 10, "dotproduct")
    return rounded(found)


@query
def dense_topk_euclidean(spark, sf_dir):
    found = dense_topk(t.given_vectors(spark, sf_dir), t.query_vectors(spark, sf_dir), 10, "euclidean")
    return rounded(found)


@query
def dense_topk_pruned(spark, sf_dir):
    """The k best by cells: those that cannot have any are not read."""
    cells = CellTable(spark, scratch_folder(spark))
    cells.build(t.given_vectors(spark, sf_dir), 64)
    return rounded(cells.search(t.query_vectors(spark, sf_dir), 10))


RESULT_COLUMNS = ("query_id", "rank", "chunk_id", "score", "content", "document", "chunk_type", "page_number", "has_image")


def _shown(results: DataFrame, *more: str) -> DataFrame:
    return rounded(results).select(*RESULT_COLUMNS, *more).withColumn("content", F.md5("content"))


@query
def semantic_search(spark, sf_dir):
    return _shown(t.retriever(spark, sf_dir).search(t.queries(spark, sf_dir), 5))


@query
def search_ids_only(spark, sf_dir):
    """Hits without stored texts and metadata."""
    found = t.retriever(spark, sf_dir).search(t.queries(spark, sf_dir), 5, include_metadata=False)
    return rounded(found).select("query_id", "rank", "chunk_id", "score")


@query
def search_by_document(spark, sf_dir):
    return _shown(t.retriever(spark, sf_dir).search_by_document(t.queries(spark, sf_dir), "doc_7", 5))


@query
def search_by_type(spark, sf_dir):
    return _shown(t.retriever(spark, sf_dir).search_by_type(t.queries(spark, sf_dir), "table", 5))


@query
def search_by_page_range(spark, sf_dir):
    return _shown(t.retriever(spark, sf_dir).search_by_page_range(t.queries(spark, sf_dir), 5, 10, 5))


@query
def search_combined(spark, sf_dir):
    found = t.retriever(spark, sf_dir).search_combined(
        t.queries(spark, sf_dir), 5, document="", chunk_type="text", min_page=0, max_page=40, has_image=False
    )
    return _shown(found)


@query
def search_combined_per_query(spark, sf_dir):
    """Each query with its own filter, or with none."""
    n = F.col("query_id")
    own = t.queries(spark, sf_dir).withColumns(
        {
            "document": F.when(n % 7 == 3, F.concat(F.lit("doc_"), n)).when(n % 7 == 4, ""),
            "chunk_type": F.when(n % 3 == 0, "text").when(n % 3 == 1, "table"),
            "min_page": F.when(n % 4 == 1, 10),
            "max_page": F.when(n % 4 < 2, 30),
            "has_image": F.when(n % 5 == 0, False),
        }
    )
    return _shown(t.retriever(spark, sf_dir).search(own, 5))


@query
def search_with_cached_vectors(spark, sf_dir):
    """Chunks and queries with vectors on file (here those of their beginnings), the others encoded."""
    records = t.records(spark, sf_dir)
    texts = records.select(F.col("contextualized_content").alias("text")).unionByName(
        t.queries(spark, sf_dir).select(F.col("query").alias("text"))
    )
    some = texts.distinct().filter(F.length("text") % 2 == 0)
    cache = enrich.text_keys(some).select("text_sha", t.encode(F.left("text", F.lit(40))).alias("embedding"))
    search = t.Retriever(ingest.index_records(records, ENCODER, cache), t.encode, cache=cache)
    return _shown(search.search(t.queries(spark, sf_dir), 5))


# -- fusion ---------------------------------------------------------------------------


def _hybrid(spark, sf_dir, k=10, filters=None):
    search = t.retriever(spark, sf_dir)
    search.index_for_bm25(t.corpus(spark, sf_dir))
    return search.hybrid_search(t.queries(spark, sf_dir), k, filters=filters)


@query
def hybrid_rrf(spark, sf_dir):
    return _shown(_hybrid(spark, sf_dir), "source")


@query
def hybrid_filtered(spark, sf_dir):
    """Filters act on the dense side only."""
    return _shown(_hybrid(spark, sf_dir, filters={"chunk_type": {"$eq": "table"}}), "source")


@query
def hybrid_filter_both(spark, sf_dir):
    """A filter, and conditions of queries, on both sides."""
    search = t.retriever(spark, sf_dir)
    records = t.records(spark, sf_dir).withColumnRenamed("original_content", "content")
    search.index_for_bm25(records)
    n = F.col("query_id")
    own = t.queries(spark, sf_dir).withColumns(
        {"max_page": F.when(n % 3 == 0, 25), "has_image": F.when(n % 5 == 0, True), "chunk_type": F.when(n % 2 == 0, "").otherwise("text")}
    )
    found = search.hybrid_search(own, 10, filters={"page_number": {"$gte": 5}}, filter_lexical=True)
    return _shown(found, "source")


@query
def hybrid_from_buckets(spark, sf_dir):
    """Hybrid search over a stored table; contents come from the buckets of the hits."""
    table = VectorTable(spark, scratch_folder(spark), t.DIMENSIONS, buckets=32)
    table.index_chunks(t.vectors(spark, sf_dir))
    vectors, buckets = table.read_buckets()
    search = t.Retriever(vectors, t.encode, buckets=buckets)
    search.index_for_bm25(t.corpus(spark, sf_dir))
    return _shown(search.hybrid_search(t.queries(spark, sf_dir), 10), "source")


@query
def hybrid_without_lexical(spark, sf_dir):
    return _shown(t.retriever(spark, sf_dir).hybrid_search(t.queries(spark, sf_dir), 10), "source")


@query
def rerank_apply(spark, sf_dir):
    asked = t.queries(spark, sf_dir)
    candidates = t.retriever(spark, sf_dir).search(asked, 10)
    responses = asked.select("query_id", t.ranking_text().alias("response")).filter("response is not null")
    return _shown(fusion.rerank(candidates, responses, 5))


@query
def rerank_requests(spark, sf_dir):
    asked = t.queries(spark, sf_dir)
    requests = fusion.rerank_requests(asked, t.retriever(spark, sf_dir).search(asked, 10))
    return requests.select("query_id", "request_id", F.length("prompt").alias("chars"))


@query
def expand_queries(spark, sf_dir):
    return fusion.expand_queries(t.queries(spark, sf_dir), t.completions(spark, sf_dir), 3)


@query
def search_expanded(spark, sf_dir):
    return _shown(t.retriever(spark, sf_dir, True).search_expanded(t.queries(spark, sf_dir), 5, 3))


@query
def hyde_search(spark, sf_dir):
    return _shown(t.retriever(spark, sf_dir, True).hyde_search(t.queries(spark, sf_dir), 5), "hyde_query")


@query
def advanced_search(spark, sf_dir):
    """All methods together, reranked from ranking texts."""
    asked = t.queries(spark, sf_dir)
    found = t.retriever(spark, sf_dir, True).advanced_search(asked, 10, use_reranking=False)
    responses = asked.select("query_id", t.ranking_text().alias("response")).filter("response is not null")
    return _shown(fusion.rerank(found, responses, 5), "hyde_query")


@query
def result_cards(spark, sf_dir):
    return fusion.result_cards(_hybrid(spark, sf_dir))


@query
def results_json(spark, sf_dir):
    found = rounded(t.retriever(spark, sf_dir).search(t.queries(spark, sf_dir), 5))
    back = T.StructType([T.StructField("chunk_id", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("content", T.StringType()), T.StructField("metadata", CHUNK_JSON["metadata"].dataType)])
    read = fusion.results_json(found).select("query_id", "rank", F.from_json("json", back).alias("r"))
    return read.select("query_id", "rank", "r.chunk_id", "r.score", F.md5("r.content").alias("content"), "r.metadata.page_number")


@query
def search_chunks(spark, sf_dir):
    """The whole way: lines to chunks with context, vectors and words, hybrid search."""
    records = cut_lineage(ingest.chunk_arrays(t.text_arrays(spark, sf_dir), SMALL))
    search = t.Retriever(ingest.index_records(records, ENCODER), t.encode)
    search.index_for_bm25(records.select("chunk_id", F.col("contextualized_content").alias("content")))
    return _shown(search.hybrid_search(t.queries(spark, sf_dir), 10), "source")
