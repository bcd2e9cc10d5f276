"""Event history in hash buckets of the event ID, and the feed of what changed in it.

A merge reads and rewrites the buckets of the changed events only. Every event that became another row
goes to the change feed with the row it was before; Gold and the current state follow that feed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.history import DELIVERY_ORDER
from tidelake.operators.schema_guard import assert_schema
from tidelake.schemas import DELIVERY
from tidelake.sources.partitioned import (
    apply_step,
    bucket_of,
    check_buckets,
    exists,
    read_partitioned,
    remove,
    replace_partitions,
    touched,
)

# A bucket is merged by one task: choose as many as history has hundreds of megabytes.
BUCKETS = 64
_BUCKETED = T.StructType([*DELIVERY.fields, T.StructField("bucket", T.StringType())])
CHANGE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("before", T.StructType(DELIVERY.fields)),
    T.StructField("after", T.StructType(DELIVERY.fields)),
    T.StructField("step", T.StringType()),
])


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The newest delivery of each event."""
    return read_partitioned(spark, root, _BUCKETED).select(*DELIVERY.names)


def read_changes(spark: SparkSession, feed: str) -> DataFrame:
    """All changes so far: event_id, before (null for a new event), after, step."""
    return read_partitioned(spark, feed, CHANGE)


def merged_buckets(existing: DataFrame, arrived: DataFrame) -> DataFrame:
    """bucket, before, after, changed for every event of the given buckets.

    History has one row per event; of those that arrived the newest counts. They meet by bucket, one
    shuffle for both, and stay there until they are written, so each bucket becomes one file.
    """
    row = F.struct(*DELIVERY.names).alias("row")
    both = existing.select("bucket", "event_id", row, F.lit(0).alias("side")).unionByName(
        arrived.select("bucket", "event_id", row, F.lit(1).alias("side")))
    order = F.struct(*[F.col(f"row.{c}") for c in DELIVERY_ORDER])
    met = both.repartition("bucket").groupBy("bucket", "event_id").agg(
        F.first(F.when(F.col("side") == 0, F.col("row")), ignorenulls=True).alias("before"),
        F.max_by("row", F.when(F.col("side") == 1, order)).alias("offered"))
    age = [F.struct(*[F.col(f"{side}.{c}") for c in DELIVERY_ORDER]) for side in ("offered", "before")]
    wins = F.col("before").isNull() | (F.col("offered").isNotNull() & (age[0] >= age[1]))
    changed = wins & ~F.col("offered").eqNullSafe(F.col("before"))
    return met.select(
        "bucket", F.when(changed, F.col("before")).alias("before"),
        F.when(wins, F.col("offered")).otherwise(F.col("before")).alias("after"),
        F.coalesce(changed, F.lit(False)).alias("changed"),
        F.col("before").isNull().alias("inserted"))


def merge_history(
    deliveries: DataFrame, root: str, feed: str | None = None, step: str | None = None,
    buckets: int = BUCKETS, record: Callable[[dict[str, int]], None] | None = None,
) -> dict[str, int]:
    """Merge deliveries into history and append what changed to ``feed``.

    Returns how many events were inserted and how many rows changed. Merging the same deliveries twice
    changes nothing; a ``step`` that is repeated is put in place again as it was first worked out.
    """
    spark, step = deliveries.sparkSession, step or uuid.uuid4().hex
    check_buckets(spark, root, buckets)
    rows = assert_schema(deliveries, DELIVERY).withColumn("bucket", bucket_of(buckets, "event_id"))
    # The deliveries are worked out once, and also when the step is repeated: a stream's batch has to
    # run for its state to be kept.
    path = f"{root}/_arrived/{step}"
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    arrived = spark.read.schema(_BUCKETED).parquet(path)
    existing = read_partitioned(spark, root, _BUCKETED).where(
        F.col("bucket").isin(touched(arrived, "bucket")))

    def publish_changes(rows: DataFrame, sums: dict[str, int]) -> None:
        remove(spark, path)  # the step is staged by now
        # A step's changes become visible at once; followers see them once.
        if feed is not None and not exists(spark, f"{feed}/step={step}"):
            replace_partitions(rows.where("changed").select(
                F.col("after.event_id").alias("event_id"), "before", "after",
                F.lit(step).alias("step")), feed, "step")
        if record is not None:
            record(sums)

    sums = apply_step(
        merged_buckets(existing, arrived), root, step, "bucket",
        {"inserted": F.col("inserted").cast("long"), "changed": F.col("changed").cast("long")},
        [F.col("after.*"), "bucket"], publish_changes)
    return sums
