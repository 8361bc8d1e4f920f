"""BM25 over a table of documents, for a table of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.rows import unfold
from quarry.functions.text import bind, words
from quarry.operators.ranking import (
    MAX_HELD_HITS,
    MAX_HELD_SCORES,
    MAX_SENT_QUERIES,
    TIE_DIGITS,
    best_of_hits,
    blocks,
    ranked,
    slices,
    small_side,
)
from quarry.operators.vector import CONDITIONS, allowed_pairs, plain_conditions
from quarry.session import cut_lineage

# Distinct (query, term) pairs that may be sent whole to every task.
MAX_SENT_TERMS = 1_000_000
# Documents whose largest term values bound a score together.
BLOCK_DOCUMENTS = 256


@dataclass(frozen=True)
class Bm25Params:
    k1: float = 1.5
    b: float = 0.75


def term_counts(tokens: Column) -> Column:
    """Distinct tokens of a row with their number, as an array: no shuffle needed.

    The tokens are sorted; each run of equal ones is a term.
    """

    def counted(run: Column) -> Column:
        places = F.when(F.size(run) > 0, F.sequence(F.lit(0), F.size(run) - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (run[i - 1] != run[i]))
        return bind(
            F.concat(starts, F.array(F.size(run))),
            lambda edges: F.transform(
                F.slice(edges, 1, F.size(edges) - 1),
                lambda edge, j: F.struct(run[edge].alias("term"), (edges[j + 1] - edge).alias("tf")),
            ),
        )

    return bind(F.sort_array(tokens), counted)


def forward_index(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, doc_len, terms): one row per document, built in place, with the columns to ``keep`` for filters.

    Written to Parquet, it is the index to keep; ``postings`` and statistics come from it.
    """
    tokens = words(F.coalesce(F.col(text), F.lit("")))
    return documents.select(F.col(doc_id).alias("doc_id"), bind(tokens, lambda t: _index_row(t)).alias("r"), *keep).select(
        "doc_id", "r.doc_len", "r.terms", *keep
    )


def _index_row(tokens: Column) -> Column:
    return F.struct(F.size(tokens).alias("doc_len"), term_counts(tokens).alias("terms"))


def postings(index: DataFrame) -> DataFrame:
    return unfold(index, ["doc_id", "doc_len"], F.col("terms"), "t").select("doc_id", "doc_len", "t.term", "t.tf")


def corpus_stats(index: DataFrame) -> DataFrame:
    """Documents without tokens count as well."""
    return index.agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.avg("doc_len"), F.lit(0.0)).alias("avg_doc_len")
    )


def document_frequency(index: DataFrame) -> DataFrame:
    return postings(index).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf(n_docs: Column, df: Column) -> Column:
    return F.ln((n_docs - df + 0.5) / (df + 0.5) + 1)


def term_idf(index: DataFrame) -> DataFrame:
    """(term, df, idf) of every term of the corpus."""
    stats = corpus_stats(index).first()
    return document_frequency(index).withColumn("idf", idf(F.lit(stats["n_docs"]), F.col("df")))


def query_terms(queries: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(query_id, term, qtf): a word said twice in a query counts twice."""
    counts = term_counts(words(F.coalesce("query", F.lit(""))))
    return unfold(queries, ["query_id", *keep], counts, "t").select("query_id", "t.term", F.col("t.tf").alias("qtf"), *keep)


def statistics(index: DataFrame) -> DataFrame:
    """(term, df, tf) of every term, and under the empty term the documents and their tokens.

    The empty word never is a token.  Kept with the index, it saves each search a pass over it.
    """
    corpus = F.array(F.struct(F.lit("").alias("term"), F.col("doc_len").alias("tf")))
    return (
        unfold(index, [], F.concat(corpus, "terms"), "t")
        .groupBy("t.term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("t.tf").alias("tf"))
    )


def score(
    index: DataFrame,
    queries: DataFrame,
    candidates: DataFrame,
    params: Bm25Params = Bm25Params(),
    kept: DataFrame | None = None,
) -> DataFrame:
    """(query_id, doc_id, score) of the pairs in ``candidates(query_id, doc_id)``, 0 without a common term.

    ``kept``: the stored ``statistics`` of the index, made here if not given.
    """
    pairs = candidates.select("query_id", "doc_id").distinct()
    kept = cut_lineage(statistics(index)) if kept is None else kept
    corpus = kept.filter(F.col("term") == "").first()
    n_docs, average = (corpus["df"], corpus["tf"] / corpus["df"]) if corpus else (0, 0.0)
    asked = pairs.join(query_terms(queries), "query_id").join(kept.select("term", "df"), "term")
    weighted = asked.select(
        "query_id", "doc_id", "term", (F.col("qtf") * idf(F.lit(n_docs), F.col("df"))).alias("weight")
    )
    # Only the documents that are asked for are taken apart, and no key is a term alone.
    read = postings(index.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi"))
    share = F.col("doc_len") / F.lit(average or 1.0)
    saturated = F.col("tf") * (params.k1 + 1) / (F.col("tf") + params.k1 * (1 - params.b + params.b * share))
    scores = (
        weighted.join(read, ["doc_id", "term"])
        .groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("weight") * saturated).alias("score"))
    )
    return pairs.join(scores, ["query_id", "doc_id"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 10,
    params: Bm25Params = Bm25Params(),
    kept: DataFrame | None = None,
    touched: Accumulator | None = None,
    condition: Column | None = None,
    by_query: bool = False,
) -> DataFrame:
    """(query_id, rank, doc_id, score): the ``k`` best documents with a score above 0.

    Only documents that meet ``condition`` are found, and with ``by_query`` only those that meet the conditions that
    ``queries`` has in columns of ``CONDITIONS``, both on columns kept with the index.  Statistics are those of all documents.

    Each task scores its documents and passes on the best; queries beyond the bounds are cut
    into blocks with a scan each.  ``kept``: the stored ``statistics`` of the index; without
    them the terms of the queries are counted first, in one more pass.  ``touched`` is told how many
    (document, query, term) entries were looked at.
    """
    names, plain = plain_conditions(queries) if by_query else ([], [])
    terms = query_terms(queries.select("query_id", "query", *plain), names)
    hits = no_hits(index, terms.schema["query_id"].dataType.simpleString())
    for n, sent in enumerate(blocks(terms, MAX_SENT_TERMS, MAX_SENT_QUERIES)):
        scan = _scan(index, terms, sent, k, params, kept, touched, condition, names)
        hits = hits.unionByName(scan) if n else scan
    return ranked(hits, k, item="doc_id").select("query_id", "rank", "doc_id", "score")


def _counts(index: DataFrame, vocabulary: pa.Array) -> dict[int, tuple[int, int]]:
    """Per place in the vocabulary (documents, occurrences); under -1 the documents and their length.

    Each task counts its documents and passes on one row per term.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, tf = np.zeros(len(vocabulary) + 1, dtype="int64"), np.zeros(len(vocabulary) + 1, dtype="int64")
        for batch in slices(batches):
            flat = batch.column("terms").flatten()
            code = pc.index_in(flat.field("term"), vocabulary).fill_null(len(vocabulary)).to_numpy(zero_copy_only=False)
            known = code < len(vocabulary)
            code, occurrences = code[known], flat.field("tf").to_numpy(zero_copy_only=False)[known]
            df += np.bincount(code, minlength=len(df))
            tf += np.bincount(code, occurrences, len(tf)).astype("int64")
            df[-1] += batch.num_rows
            tf[-1] += pc.sum(batch.column("doc_len"), min_count=0).as_py()
        seen = np.flatnonzero(df)
        code = np.where(seen == len(vocabulary), -1, seen)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(df[seen]), pa.array(tf[seen])], ["code", "df", "tf"])

    partial = index.select("doc_len", "terms").mapInArrow(count, "code long, df long, tf long")
    total = partial.groupBy("code").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    return {r["code"]: (r["df"], r["tf"]) for r in total.collect()}


def _kept_counts(kept: DataFrame, vocabulary: pa.Array) -> dict[int, tuple[int, int]]:
    """As ``_counts``, from stored statistics: at most a row per term of the vocabulary comes here."""
    wanted = kept.sparkSession.createDataFrame(
        pa.table({"code": pa.array(range(-1, len(vocabulary)), pa.int64()), "term": ["", *vocabulary.to_pylist()]})
    )
    found = kept.join(small_side(wanted, MAX_SENT_TERMS + 1, "term"), "term").select("code", "df", "tf")
    return {r["code"]: (r["df"], r["tf"]) for r in found.collect()}


def _scan(
    index: DataFrame,
    terms: DataFrame,
    sent: pa.Table,
    k: int,
    params: Bm25Params,
    kept: DataFrame | None,
    touched: Accumulator | None,
    condition: Column | None,
    conditions: list[str],
) -> DataFrame:
    query_type = terms.schema["query_id"].dataType.simpleString()
    vocabulary = pc.unique(sent.column("term").combine_chunks())
    if len(vocabulary) == 0:
        return no_hits(index, query_type)
    counts = _counts(index, vocabulary) if kept is None else _kept_counts(kept, vocabulary)
    n_docs, total = counts.get(-1, (0, 0))
    average = (total / n_docs if n_docs else 0.0) or 1.0
    frequency = np.array([counts.get(i, (0, 0))[0] for i in range(len(vocabulary))], dtype="float64")
    weight = np.log((n_docs - frequency + 0.5) / (frequency + 0.5) + 1)

    query_ids = pc.unique(sent.column("query_id").combine_chunks())
    term = pc.index_in(sent.column("term").combine_chunks(), vocabulary).to_numpy(zero_copy_only=False)
    query = pc.index_in(sent.column("query_id").combine_chunks(), query_ids).to_numpy(zero_copy_only=False)
    by_term = np.argsort(term, kind="stable")
    asked = AskedTerms(
        query[by_term],
        sent.column("qtf").to_numpy()[by_term].astype("float64"),
        np.searchsorted(term[by_term], np.arange(len(vocabulary) + 1)),
        len(query_ids),
    )
    # The conditions of a query stand in each of its rows.
    first_row = np.zeros(len(query_ids), dtype="int64")
    first_row[query[::-1]] = np.arange(len(query))[::-1]
    wanted = {c: sent.column(c).combine_chunks().take(pa.array(first_row)) for c in conditions}
    columns = sorted({CONDITIONS[c] for c in conditions})
    shared = index.sparkSession.sparkContext.broadcast((vocabulary, weight, asked, query_ids, wanted))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weight, asked, query_ids, wanted = shared.value
        search, held = SparseTopK(asked, k), []
        for batch in slices(batches):
            lists = batch.column("terms")
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            code = pc.index_in(flat.field("term"), vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
            hit = code >= 0
            row, code = row[hit], code[hit]
            tf = flat.field("tf").to_numpy(zero_copy_only=False)[hit].astype("float64")
            share = batch.column("doc_len").to_numpy(zero_copy_only=False)[row] / average
            value = weight[code] * tf * (params.k1 + 1) / (tf + params.k1 * (1 - params.b + params.b * share))
            # Documents in blocks; the entries of a block lie together.
            edges = np.searchsorted(row, np.arange(0, batch.num_rows + BLOCK_DOCUMENTS, BLOCK_DOCUMENTS))
            here = {c: batch.column(c) for c in columns}
            meets = (lambda r, q, here=here: allowed_pairs(here, wanted, r, q)) if wanted else None
            for a, b in zip(edges, edges[1:]):
                rows, queries, scores = search.block(row[a:b], code[a:b], value[a:b], meets)
                if len(rows):
                    found = [pa.array(queries), batch.column("doc_id").take(pa.array(rows)), pa.array(scores)]
                    held.append(pa.table(found, names=["query", "id", "score"]))
                if sum(h.num_rows for h in held) > MAX_HELD_HITS:
                    held = [best_of_hits(pa.concat_tables(held), k, False)]
        if touched is not None:
            touched.add(search.touched)
        if held:
            hits = best_of_hits(pa.concat_tables(held), k, False)
            ids = query_ids.take(hits.column("query").combine_chunks())
            yield from pa.table([ids, hits.column("id"), hits.column("score")], names=["query_id", "doc_id", "score"]).to_batches()

    doc_type = index.schema["doc_id"].dataType.simpleString()
    rows = (index if condition is None else index.filter(condition)).select("doc_id", "doc_len", "terms", *columns)
    return rows.mapInArrow(best, f"query_id {query_type}, doc_id {doc_type}, score double")


@dataclass(frozen=True)
class AskedTerms:
    """The queries of each term: those of term t are ``query[first[t]:first[t + 1]]``, with how often they say it."""

    query: np.ndarray
    times: np.ndarray
    first: np.ndarray
    n_queries: int

    def entries(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each term's place in ``code``, repeated for its queries, and the place of the query."""
        count = self.first[code + 1] - self.first[code]
        place = np.repeat(np.arange(len(code)), count)
        return place, np.arange(len(place)) - np.repeat(np.cumsum(count) - count - self.first[code], count)


class SparseTopK:
    """The best documents of each query so far, from blocks of documents.

    The largest value that each term has in a block bounds what a document of the block can score for a query; queries
    that already have ``k`` better documents pass the block by.  For the others only matches are looked at: no cell
    exists for a document without a term of the query.
    """

    def __init__(self, asked: AskedTerms, k: int):
        self.asked, self.k, self.touched = asked, k, 0
        self.best = np.full((asked.n_queries, k), -np.inf)
        self.least = np.full(asked.n_queries, -np.inf)

    def block(
        self,
        row: np.ndarray,
        code: np.ndarray,
        value: np.ndarray,
        meets: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, queries, scores) that may be among the best; ``row`` rises, ``meets`` tells which pairs are allowed."""
        if not len(code):
            return row, code, value
        terms, number = np.unique(code, return_inverse=True)
        highest = np.zeros(len(terms))
        np.maximum.at(highest, number, value)
        place, entry = self.asked.entries(terms)
        bound = np.bincount(self.asked.query[entry], highest[place] * self.asked.times[entry], self.asked.n_queries)
        # A little more, for sums in another order.
        open_ = bound * (1 + 1e-9) + 1e-9 >= self.least
        keep = open_[self.asked.query[entry]]
        place, entry = place[keep], entry[keep]
        # The open queries of each term of the block, then those of each posting, a bounded number at once.
        begin = np.searchsorted(place, np.arange(len(terms) + 1))
        count = (begin[1:] - begin[:-1])[number]
        found = []
        ends = np.cumsum(count)
        first_of_row = np.flatnonzero(np.diff(row, prepend=-1))
        load = np.append(0, ends)[np.append(first_of_row, len(row))]
        cuts = [0, *(np.flatnonzero(np.diff(load[:-1] // MAX_HELD_SCORES)) + 1).tolist(), len(first_of_row)]
        at_row = np.append(first_of_row, len(row))
        for a, b in zip(cuts, cuts[1:]):
            part = slice(at_row[a], at_row[b])
            times = count[part]
            source = np.repeat(np.arange(part.start, part.stop), times)
            own = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times) + begin[number[source]]
            which = entry[own]
            cell = row[source].astype("int64") * self.asked.n_queries + self.asked.query[which]
            cells, into = np.unique(cell, return_inverse=True)
            scores = np.bincount(into, value[source] * self.asked.times[which])
            self.touched += len(source)
            found.append((cells // self.asked.n_queries, cells % self.asked.n_queries, scores))
        rows, queries, scores = (np.concatenate(x) for x in zip(*found))
        good = np.round(scores, TIE_DIGITS) >= np.round(self.least[queries], TIE_DIGITS)
        rows, queries, scores = rows[good], queries[good], scores[good]
        if meets is not None:
            good = meets(rows, queries)
            rows, queries, scores = rows[good], queries[good], scores[good]
        self._learn(queries, scores)
        good = np.round(scores, TIE_DIGITS) >= np.round(self.least[queries], TIE_DIGITS)
        return rows[good], queries[good], scores[good]

    def _learn(self, queries: np.ndarray, scores: np.ndarray) -> None:
        order = np.lexsort((-scores, queries))
        queries, scores = queries[order], scores[order]
        begins = np.flatnonzero(np.diff(queries, prepend=-1))
        place = np.arange(len(queries)) - np.repeat(begins, np.diff(np.append(begins, len(queries))))
        some, which = np.unique(queries, return_inverse=True)
        new = np.full((len(some), self.k), -np.inf)
        first = place < self.k
        new[which[first], place[first]] = scores[first]
        both = np.concatenate([self.best[some], new], axis=1)
        self.best[some] = np.partition(both, self.k, axis=1)[:, self.k :]
        self.least[some] = self.best[some].min(axis=1)


def no_hits(index: DataFrame, query_type: str) -> DataFrame:
    """An empty table of hits."""
    doc_type = index.schema["doc_id"].dataType.simpleString()
    return index.sparkSession.createDataFrame([], f"query_id {query_type}, doc_id {doc_type}, score double")
