"""Gold and current state as followers of the change feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelake.sources.derived_tables import BUCKETS, refresh_current, refresh_gold
from tidelake.sources.history_table import CHANGE, read_history
from tidelake.sources.layers import ensure_folder
from tidelake.streaming.silver import step_name
from tidelake.streaming.validate import drained

Record = Callable[[str, dict[str, int]], None]


def _follow(
    spark: SparkSession, feed: str, checkpoint: str, once: bool, record: Record | None,
    refresh: Callable[[DataFrame, str], dict[str, int]],
) -> StreamingQuery:
    def step(changes: DataFrame, batch_id: int) -> None:
        name = step_name(changes, batch_id)
        counted = refresh(changes, name)
        if record is not None:
            record(name, counted)

    changes = spark.readStream.schema(CHANGE).parquet(ensure_folder(spark, feed))
    writer = changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return drained(writer, once).start()


def gold_stream(
    spark: SparkSession, history: str, feed: str, root: str, checkpoint: str,
    record: Record | None = None, once: bool = True,
) -> StreamingQuery:
    """Start bringing daily metrics up to the changes that are in the feed (``refresh_gold``)."""
    return _follow(spark, feed, checkpoint, once, record, lambda changes, step: refresh_gold(
        read_history(changes.sparkSession, history), changes, root, step))


def current_stream(
    spark: SparkSession, history: str, feed: str, root: str, checkpoint: str,
    buckets: int = BUCKETS, record: Record | None = None, once: bool = True,
) -> StreamingQuery:
    """Start bringing the current state up to the changes in the feed (``refresh_current``)."""
    return _follow(spark, feed, checkpoint, once, record, lambda changes, step: refresh_current(
        read_history(changes.sparkSession, history), changes, root, step, buckets))
