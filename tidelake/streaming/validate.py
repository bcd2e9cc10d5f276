"""Endless validation of raw messages."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidelake.operators.validation import validate_events
from tidelake.schemas import QUARANTINE_TOPIC, VALIDATED_TOPIC
from tidelake.session import settings
from tidelake.sources.messages import route_messages


def validate_stream(
    messages: DataFrame,
    checkpoint: str,
    sink_format: str = "kafka",
    path: str | None = None,
    rejected_at: Column | None = None,
    once: bool = True,
    **options: str,
) -> StreamingQuery:
    """Start routing each message to the validated or the quarantine topic.

    One pass without a shuffle. A broker takes the topic from the row and delivers at least once;
    files get one directory per topic and hold each message exactly once. Progress is recorded
    only after a batch is published. Rows are counted where they arrive and where they leave
    (`observed_rows`).
    """
    arrived = messages.observe("arrived", F.count(F.lit(1)).alias("raw"))
    routed = observed_topics(route_messages(validate_events(arrived), rejected_at), "routed")
    writer = (
        routed.writeStream.format(sink_format)
        .outputMode("append").option("checkpointLocation", checkpoint).options(**options)
    )
    if sink_format != "kafka":
        writer = writer.partitionBy("topic")
    with settings(messages.sparkSession, EVERY_BATCH):
        return drained(writer, once).start(path)


def drained(writer: DataStreamWriter, once: bool) -> DataStreamWriter:
    """Stop after the data available at the start, or keep running."""
    return writer.trigger(availableNow=True) if once else writer


# Progress of so many batches is kept for counting; an endless query is read more often than that.
EVERY_BATCH = {"spark.sql.streaming.numRecentProgressUpdates": "10000"}


def observed_topics(messages: DataFrame, name: str | Observation) -> DataFrame:
    """Count the messages of either topic as they pass."""
    return messages.observe(name, *[
        F.count_if(F.col("topic") == topic).alias(stage)
        for topic, stage in ((VALIDATED_TOPIC, "validated"), (QUARANTINE_TOPIC, "quarantine"))])


def observed_rows(query: StreamingQuery) -> dict[str, int]:
    """What a query's batches counted in this run, added up."""
    total: Counter = Counter()
    for progress in query.recentProgress:
        for row in progress.observedMetrics.values():
            total.update({k: v or 0 for k, v in row.asDict().items()})
    return dict(total)
