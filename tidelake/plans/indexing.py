"""From event history to the index, in proportion to what changed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.documents import document_metadata, documents_with_text
from tidelake.operators.embedding import DIMENSION, Encoder
from tidelake.plans.retrieval import index_chunks
from tidelake.sizing import broadcast_if_small
from tidelake.sources.history_table import read_history
from tidelake.sources.layers import LakePaths, current_version
from tidelake.sources.partitioned import remove
from tidelake.sources.vector_table import indexed_documents, vector_table_sink


def update_index(
    history: DataFrame, root: str, encode: Encoder | None = None, dim: int = DIMENSION,
) -> None:
    """Chunk, embed and store the documents that are new or changed; forget those without text.

    All texts are read once for their digests. What differs is worked out once and kept beside the
    index until it is done; only that is chunked and embedded, where it lies if its keys fit a
    broadcast. ``history`` is a stored table: it is scanned twice.
    """
    spark = history.sparkSession
    documents = document_metadata(documents_with_text(history))
    digests = documents.select("document_id", F.md5(F.concat_ws(
        "\x1f", "source_uri", "title", "text")).alias("digest"))
    if current_version(spark, root) is None:  # everything is new
        vector_table_sink(index_chunks(documents, encode, dim), root, digests)
        return
    known = indexed_documents(spark, root).select("document_id", F.col("digest").alias("known"))
    path = f"{root}/_changed/{uuid.uuid4().hex}"
    digests.join(known, "document_id", "full_outer").where(
        ~F.col("digest").eqNullSafe(F.col("known"))).select("document_id", "digest").write.parquet(path)
    changed = spark.read.schema("document_id string, digest string").parquet(path)
    there = broadcast_if_small(changed.where("digest IS NOT NULL").select("document_id"))
    chunks = index_chunks(documents.join(there, "document_id", "left_semi"), encode, dim)
    vector_table_sink(chunks, root, changed)
    remove(spark, path)


def refresh_index(
    spark: SparkSession, lake: LakePaths, encode: Encoder | None = None, dim: int = DIMENSION,
) -> None:
    """The stage after Gold: bring the lake's index up to its event history."""
    update_index(read_history(spark, lake.silver), lake.chunks, encode, dim)
