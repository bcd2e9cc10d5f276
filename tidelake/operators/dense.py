"""Exact nearest vectors by dot product."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.operators.best_matches import QUERY_ROWS, Prepared, Score, row_slices, top_matches

CANDIDATES = 20


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Array column to a matrix; every vector must have the same length, and none may be null."""
    whole = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    if whole.null_count or whole.flatten().null_count:
        raise ValueError("a vector, or a component of one, is null: filter such rows out first")
    values = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(whole), -1) if len(whole) else np.empty((0, 0))


def dot_blocks(vectors: pa.ChunkedArray) -> Prepared:
    """Query vectors as blocks of columns."""
    whole = matrix(vectors)
    return [(np.arange(start, min(start + 512, len(whole))), whole[start:start + 512].T)
            for start in range(0, len(whole), 512)]


def dot_scores(embedding: str) -> Score:
    """Dot products of a table's vectors with a block, by slices."""

    def score(table: pa.Table, block: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        vectors = matrix(table.column(embedding))
        for start, end in row_slices(len(vectors), block.shape[1]):
            yield start, vectors[start:end] @ block

    return score


def dense_knn(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = CANDIDATES,
    corpus_id: str = "chunk_id",
    query_id: str = "query_id",
    embedding: str = "embedding",
    query_rows: int = QUERY_ROWS,
    **sizes: int,
) -> DataFrame:
    """``(query_id, corpus_id, dense_score, rank)`` of the k corpus vectors nearest each query.

    For unit vectors the dot product ranks like cosine similarity and like Euclidean distance.
    """
    # All vectors have one length: that of the first and the rows bound the bytes.
    first = queries.select(F.size(embedding)).first()
    return top_matches(
        corpus.select(corpus_id, embedding), queries.select(query_id, embedding),
        lambda table: dot_blocks(table.column(embedding)), dot_scores(embedding), k, corpus_id,
        query_id, "dense_score",
        sized_by=queries.select(query_id), row_bytes=8 * max(first[0], 0) if first else 0,
        query_rows=query_rows, **sizes)
