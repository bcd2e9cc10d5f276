"""The stored index that retrieval reads: chunks, their vectors and their term counts.

A snapshot of all chunks, the chunks written since, and a state that says for every document which
write holds its chunks. An update costs what it changes; the snapshot is rewritten only by
`compact_index`. Changes and state belong to the snapshot version they follow, so publishing the next
one retires them in the same step. A write counts once its state is there: chunks of one that failed
are never read. One writer per index.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidelake.operators.history import newest_per_key
from tidelake.operators.schema_guard import assert_schema
from tidelake.schemas import INDEXED_CHUNK
from tidelake.sizing import BROADCAST_BYTES
from tidelake.sources.layers import current_version, read_layer, write_snapshot

# digest is null where the writer gave none or the document is gone; write is empty for the snapshot.
STATE = T.StructType([
    T.StructField("document_id", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("turn", T.LongType()), T.StructField("write", T.StringType())])
CHANGE = T.StructType([*INDEXED_CHUNK.fields, T.StructField("write", T.StringType())])


def _beside(root: str, name: str, version: int) -> str:
    return f"{root}/{name}-{version:010d}"


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def indexed_documents(spark: SparkSession, root: str) -> DataFrame:
    """document_id, digest, turn, write: the newest write of each document; empty before the first."""
    version = current_version(spark, root)
    if version is None:
        return spark.createDataFrame([], STATE)
    return newest_per_key(_rows(spark, _beside(root, "state", version), STATE), ["document_id"],
                          ["turn", "write"])


def vector_table_sink(
    chunks: DataFrame, root: str, documents: DataFrame | None = None,
) -> None:
    """Replace the chunks of the given documents and keep those of all others.

    ``documents(document_id[, digest])`` names what was processed, including documents left without
    any chunk; by default those the chunks belong to. Writing the same chunks again changes nothing.
    Documents are unique, as event history is, and so are chunk IDs.
    """
    spark = chunks.sparkSession
    fresh = assert_schema(chunks.select(*INDEXED_CHUNK.names), INDEXED_CHUNK)
    version, write = current_version(spark, root), uuid.uuid4().hex
    turn = 0
    if version is None:
        version, write = 0, ""
        write_snapshot(fresh, root, INDEXED_CHUNK)
        fresh = read_layer(spark, root)
    else:
        newest = _rows(spark, _beside(root, "state", version), STATE).agg(F.max("turn")).first()[0]
        turn = (newest or 0) + 1
        path = _beside(root, "changes", version)
        fresh.withColumn("write", F.lit(write)).write.mode("append").option(
            "compression", "zstd").parquet(path)
        fresh = _rows(spark, path, CHANGE).where(F.col("write") == write)
    done = fresh.select("document_id").distinct() if documents is None else documents
    digest = F.col("digest") if "digest" in done.columns else F.lit(None).cast("string")
    state = done.select("document_id", digest.alias("digest"), F.lit(turn).cast("long").alias("turn"),
                        F.lit(write).alias("write")).distinct()
    state.write.mode("append").parquet(_beside(root, "state", version))


def _superseded(spark: SparkSession, root: str, version: int) -> DataFrame:
    """document_id, write, stale: every write of each document, and whether a newer one took its place."""
    newest_first = Window.partitionBy("document_id").orderBy(F.desc("turn"), F.desc("write"))
    return _rows(spark, _beside(root, "state", version), STATE).select(
        "document_id", "write", (F.first("write").over(newest_first) != F.col("write")).alias("stale"))


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """All chunks as of the newest write of their document.

    A write of which no document was written again is read as it is, one of which all were is left
    out. Others, the snapshot too, stay in place if the documents in question fit a broadcast. The
    driver gets a row per write since the snapshot.
    """
    version = current_version(spark, root)
    snapshot, state = read_layer(spark, root), _superseded(spark, root, version)
    size = F.octet_length("document_id") + 16
    writes = {r["write"]: r for r in state.groupBy("write").agg(
        F.count("*").alias("all"), F.count_if("stale").alias("stale"),
        F.sum(F.when(F.col("stale"), size)).alias("stale_bytes"),
        F.sum(F.when(~F.col("stale"), size + 48)).alias("live_bytes")).collect()}

    def few(keys: DataFrame, size: int) -> DataFrame:
        return F.broadcast(keys) if size <= BROADCAST_BYTES else keys

    first = writes.pop("", None)
    if first is None:  # the state of the snapshot was never written
        snapshot = snapshot.join(state.select("document_id").distinct(), "document_id", "left_anti")
    elif first["stale"] == first["all"]:
        snapshot = snapshot.limit(0)
    elif first["stale"]:
        gone = state.where((F.col("write") == "") & F.col("stale")).select("document_id")
        snapshot = snapshot.join(few(gone, first["stale_bytes"]), "document_id", "left_anti")
    changes = _rows(spark, _beside(root, "changes", version), CHANGE)
    whole = [w for w, r in writes.items() if not r["stale"]]
    mixed = [w for w, r in writes.items() if 0 < r["stale"] < r["all"]]
    rows = snapshot.select(*INDEXED_CHUNK.names).unionByName(
        changes.where(F.col("write").isin(whole)).select(*INDEXED_CHUNK.names))
    if mixed:
        live = state.where(F.col("write").isin(mixed) & ~F.col("stale")).select("document_id", "write")
        rows = rows.unionByName(changes.where(F.col("write").isin(mixed)).join(
            few(live, sum(writes[w]["live_bytes"] for w in mixed)),
            ["document_id", "write"], "left_semi").select(*INDEXED_CHUNK.names))
    return rows


def compact_index(spark: SparkSession, root: str) -> None:
    """Fold the changes into a new snapshot."""
    version = current_version(spark, root) + 1
    known = indexed_documents(spark, root).withColumns({
        "turn": F.lit(0).cast("long"), "write": F.lit("")})
    known.write.mode("overwrite").parquet(_beside(root, "state", version))
    write_snapshot(read_index(spark, root), root, INDEXED_CHUNK)
