"""Raw messages to Gold, layer by layer, with a gate after each."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.metrics import reconciled, stage_reconciliation
from tidelake.operators.quality import run_gate
from tidelake.operators.schema_guard import verify_schema_enforcement
from tidelake.operators.validation import validate_events
from tidelake.schemas import DELIVERY, MESSAGE, QUARANTINE_TOPIC, VALIDATED_TOPIC
from tidelake.sources.derived_tables import read_current, read_gold, rebuild_current, rebuild_gold
from tidelake.sources.history_table import merge_history, read_history
from tidelake.sources.layers import LakePaths, ensure_folder
from tidelake.sources.messages import read_event_stream, route_messages
from tidelake.sources.partitioned import is_written
from tidelake.streaming.bronze import bronze_stream
from tidelake.streaming.derived import current_stream, gold_stream
from tidelake.streaming.silver import silver_stream
from tidelake.streaming.validate import observed_rows, observed_topics


def record(spark: SparkSession, lake: LakePaths, step: str, rows: dict[str, int]) -> None:
    """Keep what a step counted while it wrote; a step that is repeated counts once."""
    path = f"{lake.ledger}/step={step}"
    if rows and not is_written(spark, path):
        spark.createDataFrame(list(rows.items()), "stage string, rows long").coalesce(
            1).write.mode("overwrite").json(path)


def validate_batch(messages: DataFrame, lake: LakePaths, rejected_at: Column | None = None) -> None:
    """Append a batch of raw messages to the validated and quarantine topics, in one pass.

    A batch has a folder of its own beside that of the validation stream; `published` reads both.
    Messages are counted where they come in and where they leave, in the same pass.
    """
    spark, arrived, routed = messages.sparkSession, Observation(), Observation()
    counted = messages.observe(arrived, F.count(F.lit(1)).alias("raw"))
    observed_topics(route_messages(validate_events(counted), rejected_at), routed).write.mode(
        "append").partitionBy("topic").parquet(lake.batch_topics)
    record(spark, lake, uuid.uuid4().hex, arrived.get | routed.get)


def published(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """All messages of all topics, whoever wrote them."""
    both = [spark.read.schema(MESSAGE).parquet(ensure_folder(spark, path))
            for path in (lake.topics, lake.batch_topics)]
    return both[0].unionByName(both[1])


def read_topic(spark: SparkSession, lake: LakePaths, topic: str) -> DataFrame:
    return published(spark, lake).where(F.col("topic") == topic)


def published_stream(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """The messages of `published` as they arrive."""
    both = [read_event_stream(spark, "parquet", ensure_folder(spark, path))
            for path in (lake.topics, lake.batch_topics)]
    return both[0].unionByName(both[1])


def load_bronze(spark: SparkSession, lake: LakePaths, ingested_at: Column | None = None) -> None:
    """Append the validated messages that Bronze does not have yet."""
    arrived = published_stream(spark, lake).where(F.col("topic") == VALIDATED_TOPIC)
    query = bronze_stream(arrived, lake.bronze, f"{lake.checkpoints}/bronze", ingested_at)
    query.awaitTermination()
    record(spark, lake, f"{query.runId}", observed_rows(query))


def merge_silver(spark: SparkSession, lake: LakePaths) -> None:
    """Bring the deliveries that history does not have yet into it."""
    arrived = spark.readStream.schema(DELIVERY).parquet(lake.bronze)
    silver_stream(
        arrived, lake.silver, lake.silver_changes, f"{lake.checkpoints}/silver",
        record=lambda step, sums: record(spark, lake, step, {"history": sums["inserted"]}),
    ).awaitTermination()


def remerge_silver(spark: SparkSession, lake: LakePaths) -> None:
    """Merge all of Bronze into history again, as a repair; what it changes goes to the feed."""
    step = uuid.uuid4().hex
    merge_history(
        spark.read.schema(DELIVERY).parquet(lake.bronze), lake.silver, lake.silver_changes, step,
        record=lambda sums: record(spark, lake, step, {"history": sums["inserted"]}))


def follow_changes(spark: SparkSession, lake: LakePaths) -> None:
    """Bring current state and Gold up to the changes of history that they have not seen."""
    for stream, root, name in ((current_stream, lake.silver_current, "current"),
                               (gold_stream, lake.gold, "gold")):
        stream(spark, lake.silver, lake.silver_changes, root, f"{lake.checkpoints}/{name}",
               record=lambda step, sums: record(spark, lake, step, sums)).awaitTermination()


def rebuild(spark: SparkSession, lake: LakePaths) -> None:
    """Current state and Gold anew from all of history, as a repair."""
    history = read_history(spark, lake.silver)
    rebuild_current(history, lake.silver_current)
    rebuild_gold(history, lake.gold)


def refresh(spark: SparkSession, lake: LakePaths, ingested_at: Column | None = None) -> None:
    """Validated messages to Gold. A broken rule stops everything downstream of it."""
    load_bronze(spark, lake, ingested_at)
    run_gate(spark.read.parquet(lake.bronze), "bronze")
    merge_silver(spark, lake)
    verify_schema_enforcement(
        spark.read.parquet(lake.bronze),
        lambda rows: merge_history(rows, lake.silver, lake.silver_changes))
    run_gate(read_history(spark, lake.silver), "silver")
    follow_changes(spark, lake)
    run_gate(read_current(spark, lake.silver_current), "silver_current")
    run_gate(read_gold(spark, lake.gold), "gold")


def reconcile(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """Rows per stage as each counted them while it wrote: no stage is read again.

    Raw messages are counted where they are read, so one that is lost before it reaches a topic
    shows (``metrics.lost_between_stages``).
    """
    entries = spark.read.schema("stage string, rows long, step string").json(
        ensure_folder(spark, lake.ledger))
    return reconciled(entries)


def recount(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """Rows per stage by reading every stage again, to audit what `reconcile` says."""
    return stage_reconciliation({
        "raw": published(spark, lake),
        "validated": read_topic(spark, lake, VALIDATED_TOPIC),
        "quarantine": read_topic(spark, lake, QUARANTINE_TOPIC),
        "bronze": spark.read.parquet(lake.bronze),
        "history": read_history(spark, lake.silver),
        "current": read_current(spark, lake.silver_current),
    }, read_gold(spark, lake.gold))
