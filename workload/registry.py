"""Every operator as a query over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import deliveries as bronze_ops
from tidelake.operators import (
    dense,
    documents,
    embedding,
    fusion,
    grounding,
    history,
    lexical,
    metrics,
    quality,
    term_index,
    validation,
)
from tidelake.operators.posting_search import posting_search
from tidelake.operators.pruned_knn import pruned_knn
from tidelake.plans import refresh
from tidelake.plans.indexing import update_index
from tidelake.plans.retrieval import hybrid_retrieve as retrieve
from tidelake.plans.retrieval import indexable_chunks
from tidelake.schemas import CHUNK, DELIVERY, VALIDATED_TOPIC
from tidelake.session import settings, shared_folder
from tidelake.sizing import fits_broadcast
from tidelake.sources import messages as message_io
from tidelake.sources.derived_tables import read_current, read_gold
from tidelake.sources.history_table import merge_history, read_history
from tidelake.sources.layers import LakePaths
from tidelake.sources.postings_table import read_postings, write_postings
from tidelake.sources.vector_cells import read_cells, write_cells
from tidelake.sources.vector_table import compact_index, read_index
from tidelake.sources.vector_table import vector_table_sink as write_vectors
from tidelake.streaming.bronze import bronze_stream as start_bronze
from tidelake.streaming.silver import silver_stream as start_silver
from tidelake.streaming.validate import validate_stream as start_validation
from workload.views import Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a function under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def scratch(spark: SparkSession) -> LakePaths:
    return LakePaths(shared_folder(spark))


def shown(rows: DataFrame) -> DataFrame:
    """Deliveries with types both engines print alike; whole texts enter as a digest."""
    return rows.select(
        "event_id", "event_type", "customer_id", "occurred_at",
        F.col("amount").cast("double").alias("amount"), "currency",
        F.md5("document_text").alias("document_md5"), "schema_version", "kafka_topic",
        "kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at")


def as_deliveries(i: Inputs) -> DataFrame:
    return i.deliveries().select(*DELIVERY.names)


def as_history(i: Inputs) -> DataFrame:
    return history.silver_history(as_deliveries(i))


# Silver and Gold


@query
def gold_daily_metrics(i: Inputs) -> DataFrame:
    return metrics.gold_daily_metrics(as_history(i)).select(
        "customer_id", "event_day", "currency", "event_count",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("average_amount").cast("double").alias("average_amount"))


@query
def silver_history(i: Inputs) -> DataFrame:
    return shown(as_history(i))


@query
def silver_current(i: Inputs) -> DataFrame:
    return shown(history.silver_current(as_history(i)))


@query
def bronze_summary(i: Inputs) -> DataFrame:
    return bronze_ops.bronze_summary(i.deliveries())


@query
def batch_record_counts(i: Inputs) -> DataFrame:
    return bronze_ops.batch_record_counts(i.deliveries())


@query
def events_by_type(i: Inputs) -> DataFrame:
    return metrics.events_by_type(as_history(i))


@query
def daily_total_by_currency(i: Inputs) -> DataFrame:
    return metrics.daily_total_by_currency(metrics.gold_daily_metrics(as_history(i))).select(
        "currency", "event_day", F.col("total_amount").cast("double").alias("total_amount"))


@query
def late_in_history(i: Inputs) -> DataFrame:
    return history.late_in_history(as_history(i), i.deliveries().where("batch = 'late'"))


@query
def replayed_ids(i: Inputs) -> DataFrame:
    d = i.deliveries()
    return bronze_ops.replayed_ids(d.where("batch = 'duplicates'"), d.where("batch = 'valid'"))


@query
def new_ids(i: Inputs) -> DataFrame:
    d = i.deliveries()
    return bronze_ops.new_ids(d.where("batch = 'duplicates'"), d.where("batch = 'valid'"))


def _offered(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """A target without one partition, and deliveries that are newer, stale or new.

    Late events of that partition are among the deliveries, so every event is on a side.
    """
    d = i.deliveries()
    stale = F.col("kafka_partition") == 1
    changes = d.where("batch <> 'late' OR kafka_partition = 2").withColumns({
        "amount": F.when(stale, F.lit(0).cast("decimal(16,2)")).otherwise(F.col("amount")),
        "ingested_at": F.when(stale, F.expr("ingested_at - INTERVAL '1' HOUR")).otherwise(
            F.col("ingested_at")),
    })
    target = d.where("batch <> 'duplicates' AND kafka_partition <> 2")
    return target.select(*DELIVERY.names), changes.select(*DELIVERY.names)


def _merge_sides(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """The same with one row per event among the changes."""
    target, changes = _offered(i)
    return target, history.silver_history(changes)


@query
def merge_upsert(i: Inputs) -> DataFrame:
    return shown(history.merge_upsert(*_merge_sides(i)))


@query
def merge_upsert_small_source(i: Inputs) -> DataFrame:
    target, source = _merge_sides(i)
    return shown(history.merge_upsert(target, source, broadcast_source=fits_broadcast(source)))


# Validation and messages


def _validated(i: Inputs) -> DataFrame:
    return validation.validate_events(
        i.messages().select("value", "topic", "partition", "offset", "timestamp"))


def _one_second_later(column: str) -> Column:
    return F.expr(f"{column} + INTERVAL '1' SECOND")


@query
def validate_events(i: Inputs) -> DataFrame:
    return _validated(i).select(
        "offset", (F.size("errors") == 0).alias("valid"),
        F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["field"], e["rule"])),
                     ",").alias("rules"))


@query
def split_valid_quarantine(i: Inputs) -> DataFrame:
    valid, rejected = validation.split_valid_quarantine(_validated(i))
    return valid.select(F.lit("valid").alias("route"), "offset", "topic", "partition").unionByName(
        rejected.select(F.lit("quarantine").alias("route"), "offset", "topic", "partition"))


@query
def quarantine_records(i: Inputs) -> DataFrame:
    return validation.quarantine_records(_validated(i), _one_second_later("timestamp")).select(
        "payload", "rejection_reason", "source.*", "rejected_at")


@query
def quarantine_overview(i: Inputs) -> DataFrame:
    return validation.quarantine_overview(_validated(i))


@query
def quarantine_field_summary(i: Inputs) -> DataFrame:
    return validation.quarantine_field_summary(_validated(i))


@query
def validated_sink(i: Inputs) -> DataFrame:
    return message_io.validated_sink(_validated(i))


@query
def quarantine_sink(i: Inputs) -> DataFrame:
    return message_io.quarantine_sink(_validated(i), _one_second_later("timestamp"))


@query
def bronze_ingest(i: Inputs) -> DataFrame:
    return shown(bronze_ops.bronze_ingest(
        message_io.validated_sink(_validated(i)), F.col("timestamp")))


@query
def route_messages(i: Inputs) -> DataFrame:
    return message_io.route_messages(_validated(i), _one_second_later("timestamp")).select(
        "topic", "key", "value", "offset")


@query
def stage_reconciliation(i: Inputs) -> DataFrame:
    """Raw messages through every stored layer and gate, then the rows of each."""
    lake = scratch(i.spark)
    refresh.validate_batch(_read_staged(i, lake.raw), lake)
    refresh.refresh(i.spark, lake, F.col("timestamp"))
    return refresh.reconcile(i.spark, lake)


# Streams

# Bytes of a row group of messages: a batch of few files is still read by every core.
ROW_GROUP = 4 << 20


def _staged_messages(i: Inputs, path: str) -> None:
    i.messages().select(
        F.lit(None).cast("string").alias("key"), "value", "topic", "partition", "offset",
        "timestamp").write.option("parquet.block.size", str(ROW_GROUP)).parquet(path)


def _read_staged(i: Inputs, path: str) -> DataFrame:
    """The messages read back from there: the rules take long for few bytes, and events come in few splits."""
    _staged_messages(i, path)
    return i.spark.read.parquet(path).drop("key")


@query
def validate_stream(i: Inputs) -> DataFrame:
    lake = scratch(i.spark)
    _staged_messages(i, lake.raw)
    raw = message_io.read_event_stream(i.spark, "parquet", lake.raw, maxFilesPerTrigger="4")
    start_validation(raw, f"{lake.checkpoints}/validate", "parquet",
                     lake.topics, _one_second_later("timestamp")).awaitTermination()
    return refresh.published(i.spark, lake).select("topic", "key", "value", "offset")


@query
def bronze_stream(i: Inputs) -> DataFrame:
    lake = scratch(i.spark)
    refresh.validate_batch(_read_staged(i, lake.raw), lake)
    stream = message_io.read_event_stream(i.spark, "parquet", lake.batch_topics,
                                          maxFilesPerTrigger="8")
    start_bronze(stream.where(F.col("topic") == VALIDATED_TOPIC), lake.bronze,
                 f"{lake.checkpoints}/bronze", F.col("timestamp")).awaitTermination()
    return shown(i.spark.read.parquet(lake.bronze))


def _streamed_history(i: Inputs) -> LakePaths:
    """Bronze in two parts, history after each: late and corrected events come in the second."""
    lake = scratch(i.spark)
    rows = i.deliveries()
    for part in ("batch = 'valid'", "batch <> 'valid'"):
        rows.where(part).select(*DELIVERY.names).write.mode("append").option(
            "compression", "zstd").parquet(lake.bronze)
        refresh.merge_silver(i.spark, lake)
        refresh.follow_changes(i.spark, lake)
    return lake


# Bytes of deliveries, as they are shuffled, that become a file of Bronze. A batch of few files rewrites
# all buckets of history, however few rows it brings.
BRONZE_FILE = 256 << 20


def _store_bronze(i: Inputs, path: str) -> None:
    with settings(i.spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(BRONZE_FILE)}):
        as_deliveries(i).write.option("parquet.block.size", str(4 * ROW_GROUP)).option(
            "compression", "zstd").parquet(path)


@query
def silver_stream(i: Inputs) -> DataFrame:
    """Bronze through keyed state into history; the same deliveries again change nothing."""
    lake = scratch(i.spark)
    _store_bronze(i, lake.bronze)
    stream = i.spark.readStream.schema(DELIVERY).option("maxFilesPerTrigger", "4").parquet(
        lake.bronze)
    start_silver(stream, lake.silver, lake.silver_changes,
                 f"{lake.checkpoints}/silver").awaitTermination()
    return shown(read_history(i.spark, lake.silver))


@query
def merge_upsert_buckets(i: Inputs) -> DataFrame:
    """The merge into a stored history, bucket by bucket; it takes the newest delivery itself."""
    lake = scratch(i.spark)
    for side in _offered(i):
        merge_history(side, lake.silver)
    return shown(read_history(i.spark, lake.silver))


@query
def gold_incremental(i: Inputs) -> DataFrame:
    """Daily metrics as they stand after two rounds of changes."""
    return read_gold(i.spark, _streamed_history(i).gold).select(
        "customer_id", "event_day", "currency", "event_count",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("average_amount").cast("double").alias("average_amount"))


@query
def silver_current_incremental(i: Inputs) -> DataFrame:
    """The current state as it stands after two rounds of changes."""
    return shown(read_current(i.spark, _streamed_history(i).silver_current))


# Quality


@query
def gate_bronze(i: Inputs) -> DataFrame:
    return quality.gate_report(i.deliveries(), "bronze")


@query
def gate_silver(i: Inputs) -> DataFrame:
    return quality.gate_report(as_history(i), "silver")


@query
def gate_silver_current(i: Inputs) -> DataFrame:
    return quality.gate_report(history.silver_current(as_history(i)), "silver_current")


@query
def gate_gold(i: Inputs) -> DataFrame:
    return quality.gate_report(metrics.gold_daily_metrics(as_history(i)), "gold")


@query
def gate_silver_faulty(i: Inputs) -> DataFrame:
    return quality.gate_report(i.faulty(), "silver")


@query
def gate_violations(i: Inputs) -> DataFrame:
    return quality.gate_violations(
        i.faulty(), "silver", ["event_id", "customer_id", "amount", "kafka_offset"]).withColumn(
        "amount", F.col("amount").cast("double"))


@query
def expect_not_null(i: Inputs) -> DataFrame:
    return quality.expect_not_null(i.faulty(), "customer_id")


@query
def expect_unique(i: Inputs) -> DataFrame:
    return quality.expect_unique(i.faulty(), "event_id", "customer_id")


@query
def expect_between(i: Inputs) -> DataFrame:
    return quality.expect_between(i.faulty(), "amount", 0, 100)


# Documents, chunks and vectors


@query
def documents_with_text(i: Inputs) -> DataFrame:
    return documents.documents_with_text(as_history(i)).select(
        "event_id", "customer_id", "event_type", F.md5("document_text").alias("document_md5"))


@query
def document_metadata(i: Inputs) -> DataFrame:
    return documents.document_metadata(documents.documents_with_text(as_history(i))).select(
        "document_id", "source_uri", "title", F.md5("text").alias("text_md5"))


def _documents(i: Inputs) -> DataFrame:
    return documents.document_metadata(documents.documents_with_text(i.text_events()))


def _chunks(i: Inputs) -> DataFrame:
    return documents.chunk_documents(_documents(i)).drop("char_start", "char_end")


@query
def normalize_text(i: Inputs) -> DataFrame:
    return documents.normalize_text(_documents(i)).select("document_id", "text")


@query
def chunk_documents(i: Inputs) -> DataFrame:
    return _chunks(i)


@query
def chunk_ids(i: Inputs) -> DataFrame:
    return _chunks(i).select("document_id", "chunk_number", "chunk_id")


@query
def chunk_stats(i: Inputs) -> DataFrame:
    return documents.chunk_stats(_chunks(i))


@query
def chunk_total(i: Inputs) -> DataFrame:
    return documents.chunk_total(_chunks(i))


def _components(frame: DataFrame, key: str) -> DataFrame:
    return frame.select(key, F.posexplode("embedding").alias("dimension", "weight")).withColumn(
        "weight", F.round(F.col("weight").cast("double"), 6))


@query
def embed_text(i: Inputs) -> DataFrame:
    return _components(embedding.embed_text(_chunks(i)), "chunk_id")


@query
def normalize_vectors(i: Inputs) -> DataFrame:
    return _components(embedding.normalize_vectors(i.table("embeddings")), "vec_id")


@query
def vector_table_sink(i: Inputs) -> DataFrame:
    """Index everything, then index it again: the second write replaces the same chunks."""
    lake = scratch(i.spark)
    chunks = indexable_chunks(i.text_events())
    write_vectors(chunks, lake.chunks)
    write_vectors(read_index(i.spark, lake.chunks), lake.chunks)
    return indexed(read_index(i.spark, lake.chunks))


def indexed(index: DataFrame) -> DataFrame:
    """Every column of the index; vectors and term lists as numbers that show any change."""
    place = F.sequence(F.lit(1), F.size("embedding"))
    weighted = F.zip_with("embedding", place, lambda x, n: x.cast("double") * n)
    listed = {f"{f}_terms": F.md5(F.array_join(F.array_sort(F.transform(
        f"{f}_terms", lambda t: F.concat(t["term"], F.lit(":"), t["tf"].cast("string")))), ","))
        for f in term_index.FIELDS}
    return index.select(
        *CHUNK.names, F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 4).alias("vector"),
        *[c.alias(n) for n, c in listed.items()], "title_length", "text_length")


@query
def refresh_index(i: Inputs) -> DataFrame:
    """Index an earlier state, then what changed since: texts that were others, absent or extra."""
    lake = scratch(i.spark)
    i.text_events().write.option("compression", "zstd").parquet(lake.silver)  # as history is stored
    events = i.spark.read.parquet(lake.silver)
    number = F.crc32("event_id") % 5
    before = events.withColumn("document_text", F.when(number == 0, F.lit("an older text"))
                               .when(number == 1, F.lit(None)).otherwise(F.col("document_text")))
    gone = events.where(number == 2).withColumn("event_id", F.concat(F.lit("gone-"), "event_id"))
    update_index(before.unionByName(gone), lake.chunks)
    update_index(events, lake.chunks)
    compact_index(i.spark, lake.chunks)
    update_index(events.where(number != 3), lake.chunks)
    update_index(events, lake.chunks)
    return indexed(read_index(i.spark, lake.chunks))


# Retrieval


def rounded(frame: DataFrame) -> DataFrame:
    """Scores as both engines print them; ranks come from the scores before that."""
    return frame.withColumns({c: F.round(c, 6) for c in frame.columns if c.endswith("_score")})


class Retrieval:
    """The stored index of all texts, and the questions."""

    def __init__(self, i: Inputs) -> None:
        lake = scratch(i.spark)
        write_vectors(indexable_chunks(i.text_events()), lake.chunks)
        self.index = read_index(i.spark, lake.chunks)
        self.questions = i.questions()

    def dense(self) -> DataFrame:
        return dense.dense_knn(self.index, embedding.embed_text(self.questions, "query"))

    def lexical(self) -> DataFrame:
        return lexical.bm25_search(self.index, self.questions)

    def results(self) -> DataFrame:
        return retrieve(self.index, self.questions)


@query
def dense_knn(i: Inputs) -> DataFrame:
    """Every vector of the given table against all of them."""
    vectors = embedding.normalize_vectors(i.table("embeddings"))
    return rounded(dense.dense_knn(
        vectors, vectors.withColumnRenamed("vec_id", "query_id"), corpus_id="vec_id"))


@query
def dense_knn_grid(i: Inputs) -> DataFrame:
    """The same by the path that a large table of queries takes."""
    vectors = embedding.normalize_vectors(i.table("embeddings"))
    return rounded(dense.dense_knn(
        vectors, vectors.withColumnRenamed("vec_id", "query_id"), corpus_id="vec_id",
        query_rows=150, corpus_rows=200))


@query
def dense_knn_cells(i: Inputs) -> DataFrame:
    """The same over stored cells, of which those that can hold a near vector are scored."""
    lake = scratch(i.spark)
    embedding.normalize_vectors(i.table("embeddings")).write.parquet(lake.chunks)
    vectors, cells = i.spark.read.parquet(lake.chunks), f"{lake.chunks}_cells"
    write_cells(vectors, cells, "vec_id")
    return rounded(pruned_knn(
        read_cells(i.spark, cells), vectors.withColumnRenamed("vec_id", "query_id"),
        corpus_id="vec_id"))


@query
def topk_dense(i: Inputs) -> DataFrame:
    return rounded(Retrieval(i).dense())


@query
def bm25_index(i: Inputs) -> DataFrame:
    return term_index.postings(term_index.bm25_index(_chunks(i)))


@query
def corpus_stats(i: Inputs) -> DataFrame:
    return term_index.field_stats(term_index.bm25_index(_chunks(i))).withColumn(
        "average_length", F.round("average_length", 6))


@query
def document_frequencies(i: Inputs) -> DataFrame:
    return term_index.document_frequencies(term_index.bm25_index(_chunks(i)))


@query
def bm25_search(i: Inputs) -> DataFrame:
    return rounded(Retrieval(i).lexical().drop("rank"))


@query
def bm25_search_grid(i: Inputs) -> DataFrame:
    """The same by the path that a large table of questions takes."""
    r = Retrieval(i)
    return rounded(lexical.bm25_search(
        r.index, r.questions, query_rows=15, corpus_rows=1000).drop("rank"))


@query
def bm25_search_blocks(i: Inputs) -> DataFrame:
    """The same over stored postings, of which the blocks that can matter are read."""
    lake = scratch(i.spark)
    write_postings(term_index.bm25_index(_chunks(i)), lake.chunks)
    return rounded(posting_search(read_postings(i.spark, lake.chunks), i.questions()).drop("rank"))


@query
def topk_lexical(i: Inputs) -> DataFrame:
    return Retrieval(i).lexical().drop("lexical_score")


@query
def retrieval_rank(i: Inputs) -> DataFrame:
    r = Retrieval(i)
    return r.dense().select("query_id", F.lit("dense").alias("retriever"), "chunk_id",
                            "rank").unionByName(
        r.lexical().select("query_id", F.lit("lexical").alias("retriever"), "chunk_id", "rank"))


@query
def rrf_fuse(i: Inputs) -> DataFrame:
    r = Retrieval(i)
    return rounded(fusion.rrf_fuse({"dense": r.dense(), "lexical": r.lexical()}))


@query
def hybrid_fuse(i: Inputs) -> DataFrame:
    r = Retrieval(i)
    return rounded(fusion.hybrid_fuse(r.dense(), r.lexical()))


@query
def rrf_topk(i: Inputs) -> DataFrame:
    r = Retrieval(i)
    return fusion.hybrid_fuse(r.dense(), r.lexical()).select("query_id", "chunk_id", "rank")


@query
def rerank(i: Inputs) -> DataFrame:
    return rounded(Retrieval(i).results().select("query_id", "chunk_id", "rerank_score"))


@query
def rerank_topk(i: Inputs) -> DataFrame:
    return Retrieval(i).results().select("query_id", "chunk_id", "rank")


@query
def hybrid_retrieve(i: Inputs) -> DataFrame:
    return rounded(Retrieval(i).results().drop("query"))


@query
def grounded_context(i: Inputs) -> DataFrame:
    r = Retrieval(i)
    return grounding.grounded_context(r.questions, r.results())


@query
def citations(i: Inputs) -> DataFrame:
    r = Retrieval(i)
    return grounding.citations(r.questions, r.results()).select(
        "query_id", F.posexplode("citations").alias("place", "citation")).select(
        "query_id", (F.col("place") + 1).alias("place"), "citation.*")
