"""Text worth indexing, and its overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.text import in_slices, is_blank, normalize_space

# Default window and citation prefix.
CHUNK_SIZE = 800
OVERLAP = 120
SLICE_CHARS = 4_000_000
SOURCE_PREFIX = "delta://silver/customer_events/"


def documents_with_text(history: DataFrame) -> DataFrame:
    """Events that carry text. Text of line breaks only counts as blank too."""
    return history.where(~is_blank(F.col("document_text"))).select(
        "event_id", "customer_id", "event_type", "document_text")


def document_metadata(events: DataFrame, source_prefix: str = SOURCE_PREFIX) -> DataFrame:
    """Documents with the source and title that citations show."""
    return events.select(
        F.col("event_id").cast("string").alias("document_id"),
        F.concat(F.lit(source_prefix), F.col("event_id").cast("string")).alias("source_uri"),
        F.concat("event_type", F.lit(" event for customer "), "customer_id").alias("title"),
        F.col("document_text").alias("text"),
    )


def normalize_text(documents: DataFrame) -> DataFrame:
    """Collapse whitespace and drop documents without any other character."""
    return documents.where(~is_blank(F.col("text"))).withColumn(
        "text", normalize_space(F.col("text")))


def window_pattern(size: int, overlap: int) -> re.Pattern[str]:
    """One window: the rest if it fits, else up to the last space, else exactly ``size``.

    A cut at a space must leave more than ``overlap`` characters, otherwise the next window, which
    starts ``overlap`` before the cut, would not advance.
    """
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError("size must be positive and overlap non-negative and smaller than size")
    cut = rf"|.{{{overlap + 1},{size - 1}}}(?= )" if overlap + 1 < size else ""
    return re.compile(rf".{{1,{size}}}\Z{cut}|.{{{size}}}", re.DOTALL)


def chunk_spans(text: str, window: re.Pattern[str], overlap: int) -> Iterator[tuple[int, int]]:
    """Start and end of every window of one normalised text."""
    found = window.match(text)
    while found:
        yield found.span()
        found = window.match(text, found.end() - overlap) if found.end() < len(text) else None


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about SLICE_CHARS bytes of text, a row at least."""
    return in_slices(batch, pc.fill_null(pc.binary_length(batch.column("text")), 0), SLICE_CHARS)


def chunk_documents(
    documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = OVERLAP,
) -> DataFrame:
    """Chunks of every document with content-derived IDs.

    A window depends on where the previous one ended, hence the Arrow batches. Whole texts are
    processed where they lie: no shuffle, and the work is linear in their length.
    """
    window = window_pattern(size, overlap)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            rows, numbers, starts, ends, texts = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for number, (start, end) in enumerate(chunk_spans(text, window, overlap)):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    ends.append(end)
                    texts.append(text[start:end])
            owner = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(owner) for c in ("document_id", "source_uri", "title")]
                + [pa.array(numbers, pa.int32()), pa.array(starts, pa.int32()),
                   pa.array(ends, pa.int32()), pa.array(texts, pa.string())],
                names=["document_id", "source_uri", "title", "chunk_number", "char_start",
                       "char_end", "text"])

    schema = T.StructType([
        T.StructField("document_id", T.StringType()),
        T.StructField("source_uri", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("chunk_number", T.IntegerType()),
        T.StructField("char_start", T.IntegerType()),
        T.StructField("char_end", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ])
    normal = normalize_text(documents).select("document_id", "source_uri", "title", "text")
    return with_chunk_id(normal.mapInArrow(windows, schema))


def with_chunk_id(chunks: DataFrame) -> DataFrame:
    """SHA-256 of document, position and text: the same content always gets the same ID."""
    return chunks.select(
        F.sha2(F.concat_ws(":", "document_id", F.col("chunk_number").cast("string"), "text"),
               256).alias("chunk_id"), *chunks.columns)


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Chunks and characters per document."""
    return chunks.groupBy("document_id").agg(
        F.count("*").alias("chunks"), F.sum(F.length("text")).alias("characters"))


def chunk_total(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("indexed_chunks"),
                      F.countDistinct("document_id").alias("documents"))
