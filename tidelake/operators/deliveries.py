"""Bronze deliveries: typed messages with their source coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.schemas import EVENT


def bronze_ingest(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Parse validated messages and keep where and when each one was delivered."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), EVENT).alias("event"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    ).select("event.*", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
             "ingested_at")


def bronze_summary(bronze: DataFrame) -> DataFrame:
    """Deliveries, distinct event IDs and replays.

    Counting per ID first keeps one short row per ID and task, also for an ID replayed endlessly.
    """
    return (
        bronze.groupBy("event_id").agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("bronze_deliveries"),
             F.count("event_id").alias("unique_event_ids"))
        .withColumn("replayed_deliveries", F.col("bronze_deliveries") - F.col("unique_event_ids"))
    )


def batch_record_counts(deliveries: DataFrame, batch: str = "batch") -> DataFrame:
    return deliveries.groupBy(batch).agg(F.count("*").alias("records"))


def replayed_ids(batch: DataFrame, earlier: DataFrame) -> DataFrame:
    """IDs of a batch that an earlier one already delivered."""
    return _distinct_ids(batch).join(_distinct_ids(earlier), "event_id", "left_semi")


def new_ids(batch: DataFrame, earlier: DataFrame) -> DataFrame:
    """IDs of a batch that no earlier one delivered."""
    return _distinct_ids(batch).join(_distinct_ids(earlier), "event_id", "left_anti")


def _distinct_ids(frame: DataFrame) -> DataFrame:
    return frame.select("event_id").distinct()
