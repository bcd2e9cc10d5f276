"""Term statistics for lexical search.

Each chunk keeps its own term counts, so building the index needs no shuffle; only the statistics
of the whole collection are aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import term_frequencies

FIELDS = ("title", "text")


def with_terms(chunks: DataFrame) -> DataFrame:
    """Add per field ``array<struct<term, tf>>`` and the length in tokens."""
    terms = chunks.withColumns({
        f"{f}_terms": term_frequencies(F.col(f)) for f in FIELDS})
    return terms.withColumns({
        f"{f}_length": F.aggregate(F.col(f"{f}_terms.tf"), F.lit(0), lambda acc, tf: acc + tf)
        for f in FIELDS})


def bm25_index(chunks: DataFrame) -> DataFrame:
    """What lexical search reads of each chunk."""
    return with_terms(chunks).select(
        "chunk_id", *[f"{f}_{part}" for f in FIELDS for part in ("terms", "length")])


def postings(index: DataFrame) -> DataFrame:
    """The index as rows ``(chunk_id, field, term, tf)``."""
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_terms").alias("terms"))
                       for f in FIELDS])
    return (
        index.select("chunk_id", F.inline(fields))
        .select("chunk_id", "field", F.inline("terms"))
    )


def field_stats(index: DataFrame) -> DataFrame:
    """Per field: chunks that have any term, and their average length. One row per field."""
    lengths = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_length").alias("length"))
                        for f in FIELDS])
    return (
        index.select(F.inline(lengths)).where(F.col("length") > 0).groupBy("field")
        .agg(F.count("*").alias("chunks"), F.avg("length").alias("average_length"))
    )


def document_frequencies(index: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """Number of chunks per field and term, for all terms or for those of ``vocabulary(term)``."""
    rows = postings(index)
    if vocabulary is not None:
        rows = rows.join(vocabulary, "term", "left_semi")
    return rows.groupBy("field", "term").agg(F.count("*").alias("document_frequency"))
