"""Maintain Silver history from new Bronze deliveries only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.history import DELIVERY_ORDER
from tidelake.schemas import DELIVERY
from tidelake.sources.history_table import BUCKETS, merge_history
from tidelake.streaming.validate import drained, settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_TIMES = [f.name for f in DELIVERY.fields if isinstance(f.dataType, T.TimestampType)]
_AGE = ", ".join(f"{c} long" for c in DELIVERY_ORDER)


def unseen_deliveries(bronze: DataFrame) -> DataFrame:
    """The deliveries that were not seen before, replays left out.

    State holds the event and four numbers per delivery, whatever a delivery holds, in a store that
    spills to disk. Nothing is called per row: Spark's own deduplication keeps it.
    """
    age = F.struct(*[F.unix_micros(c).alias(c) if c in _TIMES else F.col(c) for c in DELIVERY_ORDER])
    return bronze.select(*DELIVERY.names).withColumn(
        "_age", age.cast(T.StructType.fromDDL(_AGE))).dropDuplicates(["event_id", "_age"]).drop("_age")


def step_name(batch: DataFrame, batch_id: int) -> str:
    """The same name whenever this batch is repeated, and no other batch's."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id:010d}"


def silver_stream(
    bronze: DataFrame, root: str, feed: str, checkpoint: str, buckets: int = BUCKETS,
    record: Callable[[str, dict[str, int]], None] | None = None, once: bool = True,
) -> StreamingQuery:
    """Start merging new deliveries into history (``merge_history``), a step per micro-batch.

    Replays end in the keyed state: a batch reads and writes the buckets of the events that it has
    unseen deliveries of. Older copies lose against the row in history. Late facts need no
    watermark: nothing is dropped. Under a new checkpoint all deliveries come again and change nothing.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        step = step_name(batch, batch_id)
        merge_history(batch, root, feed, step, buckets,
                      None if record is None else lambda sums: record(step, sums))

    writer = unseen_deliveries(bronze).writeStream.outputMode("update").foreachBatch(
        merge).option("checkpointLocation", checkpoint)
    with settings(bronze.sparkSession, {_PROVIDER: ROCKSDB}):
        return drained(writer, once).start()
