"""BM25 search over title and text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import require_text, term_frequencies
from tidelake.operators.best_matches import QUERY_ROWS, Prepared, row_slices, top_matches
from tidelake.operators.dense import CANDIDATES
from tidelake.operators.term_index import FIELDS, document_frequencies, field_stats
from tidelake.sizing import broadcast_if_small

# BM25 parameters and the boost of a match in the title.
K1 = 1.2
B = 0.75
BOOST = {"title": 2.0, "text": 1.0}

BLOCK_QUERIES = 128
BLOCK_TERMS = 16_384


# Queries by terms: a vocabulary, its number of queries, where each term's entries start, and per
# entry the query and per field the term's weight in it. As long as the queries have words.
QueryBlock = tuple[pa.Array, int, np.ndarray, np.ndarray, dict[str, np.ndarray]]


def query_terms(queries: DataFrame, query: str = "query", query_id: str = "query_id") -> DataFrame:
    """Rows ``(query_id, term, tf)``; a blank query fails the job."""
    text = require_text(F.col(query), "query cannot be empty")
    return queries.select(query_id, F.inline(term_frequencies(text)))


def weighted_terms(
    index: DataFrame, queries: DataFrame, chunks: dict[str, int], query: str = "query",
    query_id: str = "query_id",
) -> DataFrame:
    """Each query's terms with their inverse document frequency per field.

    ``ln(1 + (N - df + 0.5) / (df + 0.5))``, times how often the query repeats the term, where
    ``chunks`` is N of each field. Terms that no chunk holds are left out.
    """
    terms = query_terms(queries, query, query_id)
    vocabulary = broadcast_if_small(terms.select("term").distinct())
    df = F.col("document_frequency")
    rated = document_frequencies(index, vocabulary).groupBy("term").agg(*[
        F.max(F.when(F.col("field") == f, F.log(1 + (chunks.get(f, 0) - df + 0.5) / (df + 0.5))))
        .alias(f) for f in FIELDS])
    return terms.join(rated, "term").select(query_id, F.struct("term", *[
        (F.col("tf") * F.coalesce(f, F.lit(0.0))).alias(f) for f in FIELDS]).alias("term"))


def bm25_search(
    index: DataFrame,
    queries: DataFrame,
    k: int = CANDIDATES,
    query: str = "query",
    query_id: str = "query_id",
    query_rows: int = QUERY_ROWS,
    **sizes: int,
) -> DataFrame:
    """``(query_id, chunk_id, lexical_score, rank)`` of the k best chunks per query.

    The score of a chunk is the better of its title score, boosted, and its text score. Chunks
    sharing no term with a query are no match. ``index`` is read three times: store it first.
    """
    stats = field_stats(index).collect()  # one row per field
    chunks = {r["field"]: r["chunks"] for r in stats}
    average = {r["field"]: r["average_length"] for r in stats}
    grouped = weighted_terms(index, queries, chunks, query, query_id).groupBy(query_id).agg(
        F.sort_array(F.collect_list("term")).alias("terms"))  # at most one entry per query token

    def prepare(table: pa.Table) -> Prepared:
        terms = table.column("terms").combine_chunks()
        counts = np.diff(terms.offsets.to_numpy())
        blocks, start = [], 0
        while start < len(terms):
            total = np.cumsum(counts[start:start + BLOCK_QUERIES])
            end = start + max(1, int(np.searchsorted(total, BLOCK_TERMS, side="right")))
            blocks.append((np.arange(start, end), _query_block(terms.slice(start, end - start))))
            start = end
        return blocks

    def score(table: pa.Table, block: QueryBlock) -> Iterator[tuple[int, np.ndarray]]:
        vocabulary, width = block[:2]
        fields = {f: _term_norms(table, f, vocabulary, average.get(f, 1.0)) for f in FIELDS}
        for start, end in row_slices(table.num_rows, width):
            scores = np.zeros((end - start, width))
            for f, (row, term, norm) in fields.items():
                low, high = np.searchsorted(row, [start, end])
                np.maximum(scores, BOOST[f] * _added(
                    row[low:high] - start, term[low:high], norm[low:high], f, end - start, block),
                    out=scores)
            yield start, scores

    needed = ["chunk_id", *[f"{f}_{part}" for f in FIELDS for part in ("terms", "length")]]
    return top_matches(
        index.select(*needed), grouped, prepare, score, k, "chunk_id", query_id, "lexical_score", floor=0.0,
        sized_by=queries.select(query_id, query), query_rows=query_rows, **sizes)


def _query_block(terms: pa.ListArray) -> QueryBlock:
    flat = terms.flatten()
    coded = flat.field("term").dictionary_encode()
    code = coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))
    order = np.argsort(code, kind="stable")
    starts = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
    weights = {f: flat.field(f).to_numpy()[order] for f in FIELDS}
    return coded.dictionary, len(terms), starts, owner[order], weights


def _added(row: np.ndarray, term: np.ndarray, norm: np.ndarray, field: str, rows: int,
           block: QueryBlock) -> np.ndarray:
    """Scores of rows by queries: each posting adds to the queries that hold its term, no others.

    Every score adds its terms in one order, so copies of a chunk get equal scores.
    """
    _, width, starts, owner, weights = block
    order = np.lexsort((term, row))
    row, term, norm = row[order], term[order], norm[order]
    many = starts[term + 1] - starts[term]
    entry = np.repeat(starts[term] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return np.bincount(np.repeat(row, many) * width + owner[entry],
                       np.repeat(norm, many) * weights[field][entry],
                       rows * width).reshape(rows, width)


def _term_norms(table: pa.Table, field: str, vocabulary: pa.Array, average: float,
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, vocabulary position and saturated frequency of every posting of a queried term."""
    terms = table.column(f"{field}_terms").combine_chunks()
    length = table.column(f"{field}_length").to_numpy()
    flat = terms.flatten()
    code = pc.fill_null(pc.index_in(flat.field("term"), value_set=vocabulary), -1).to_numpy()
    hit = np.flatnonzero(code >= 0)
    row = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))[hit]
    tf = flat.field("tf").to_numpy()[hit]
    return row, code[hit], tf / (tf + K1 * (1 - B + B * length[row] / average))
