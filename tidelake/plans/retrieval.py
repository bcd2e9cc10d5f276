"""From event history to an index, and from questions to cited context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import require_text
from tidelake.operators.dense import CANDIDATES, dense_knn
from tidelake.operators.documents import (
    CHUNK_SIZE,
    OVERLAP,
    chunk_documents,
    document_metadata,
    documents_with_text,
)
from tidelake.operators.embedding import DIMENSION, Encoder, embed_text
from tidelake.operators.fusion import RESULTS, PairScorer, hybrid_fuse, rerank
from tidelake.operators.lexical import bm25_search
from tidelake.operators.term_index import with_terms
from tidelake.schemas import CHUNK
from tidelake.sizing import BROADCAST_BYTES, measure

# Upper bound for one fused candidate: two IDs and three scores.
CANDIDATE_BYTES = 512


def indexable_chunks(
    history: DataFrame,
    encode: Encoder | None = None,
    dim: int = DIMENSION,
    size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Chunks with vectors and term counts, ready to be stored; map-only from the scan on."""
    return index_chunks(document_metadata(documents_with_text(history)), encode, dim, size, overlap)


def index_chunks(
    documents: DataFrame,
    encode: Encoder | None = None,
    dim: int = DIMENSION,
    size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The same from documents."""
    chunks = chunk_documents(documents, size, overlap).drop("char_start", "char_end")
    return with_terms(embed_text(chunks, encode=encode, dim=dim))


def hybrid_retrieve(
    index: DataFrame,
    questions: DataFrame,
    encode: Encoder | None = None,
    score_pairs: PairScorer | None = None,
    candidates: int = CANDIDATES,
    limit: int = RESULTS,
    dim: int = DIMENSION,
) -> DataFrame:
    """The best chunks for each of ``questions(query_id, query)``.

    Dense and lexical candidates are fused by reciprocal rank and reranked. ``index`` is what
    ``indexable_chunks`` made, read back from storage: it is scanned several times.
    """
    asked = questions.select(
        "query_id", require_text(F.col("query"), "query cannot be empty").alias("query"))
    vectors = embed_text(asked, "query", encode, dim).select("query_id", "embedding")
    dense = dense_knn(index, vectors, candidates)
    lexical = bm25_search(index, asked, candidates)
    fused = hybrid_fuse(dense, lexical, k=candidates)
    fused = fused.drop("rank")
    rows, size = measure(asked)
    if max(rows * candidates * CANDIDATE_BYTES, size) <= BROADCAST_BYTES:
        fused, asked = F.broadcast(fused), F.broadcast(asked)
    texts = index.select(*CHUNK.names).join(fused, "chunk_id").join(asked, "query_id")
    return rerank(texts, score_pairs, limit)
