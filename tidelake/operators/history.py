"""Silver: event history, current state, and the keyed merge that maintains history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DELIVERY_ORDER = ("ingested_at", "kafka_timestamp", "kafka_partition", "kafka_offset")
STATE_ORDER = ("occurred_at", *DELIVERY_ORDER, "event_id")


def newest_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in ``order``.

    The rank filter becomes a group limit that runs before the shuffle as well, so a key with many
    rows sends one row per task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        frame.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def silver_history(bronze: DataFrame) -> DataFrame:
    """The newest delivery of each event ID."""
    return newest_per_key(bronze, ["event_id"], DELIVERY_ORDER)


def silver_current(history: DataFrame) -> DataFrame:
    """The newest event of each customer and event type."""
    return newest_per_key(history, ["customer_id", "event_type"], STATE_ORDER)


def late_in_history(history: DataFrame, late: DataFrame) -> DataFrame:
    """Facts of a late batch as history keeps them."""
    return history.join(late.select("event_id").distinct(), "event_id", "left_semi").select(
        "event_id", "customer_id", "event_type", "occurred_at", "ingested_at")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str = "event_id",
    order_by: Sequence[str] = ("ingested_at",),
    broadcast_source: bool = False,
) -> DataFrame:
    """The target after the merge: source rows replace matches that are not newer, others insert.

    Ages compare by the ``order_by`` columns, most significant first. ``source`` holds at most one row per key. Normally this is one full outer join. For a source
    measured to fit a broadcast, ``broadcast_source`` leaves the target where it is: rows are
    replaced on the map side, and inserts come from a second, key-only scan of the target.
    """
    if not broadcast_source:
        joined = _side(target, "t", key).join(_side(source, "s", key), "_key", "full_outer")
        return joined.select(*_chosen(target.columns, order_by))
    small = F.broadcast(_side(source, "s", key))
    replaced = _side(target, "t", key).join(small, "_key", "left").select(
        *_chosen(target.columns, order_by))
    present = target.select(key).join(F.broadcast(source.select(key)), key, "left_semi")
    # Present keys are a subset of the source keys, so they have the same bound.
    inserted = source.join(F.broadcast(present.distinct()), key, "left_anti")
    return replaced.unionByName(inserted.select(*target.columns))


def _side(frame: DataFrame, name: str, key: str) -> DataFrame:
    return frame.select(F.col(key).alias("_key"), F.struct(*frame.columns).alias(name))


def _chosen(columns: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    age = [F.struct(*[F.col(f"{side}.{c}") for c in order_by]) for side in ("s", "t")]
    known = [F.col(f"{side}.{order_by[0]}").isNotNull() for side in ("s", "t")]
    fresher = known[0] & known[1] & (age[0] >= age[1])
    take_source = F.col("s").isNotNull() & (F.col("t").isNull() | fresher)
    return [F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in columns]
