"""Gold metrics and current state, kept up to date from the feed of changed events.

The groups that a change touches are those of the row before and of the row after it. Only they are
worked out again, and only the partitions they lie in are rewritten. Working a group out again gives
the same rows, so changes may come more than once.

A group that has lost its last event stays as an empty row, since a partition can't be replaced by
nothing; readers don't see it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.history import DELIVERY_ORDER, STATE_ORDER, newest_per_key, silver_current
from tidelake.operators.metrics import gold_daily_metrics
from tidelake.operators.schema_guard import assert_schema
from tidelake.schemas import DAILY_METRICS, DELIVERY
from tidelake.sizing import broadcast_if_small
from tidelake.sources.partitioned import (
    apply_step,
    bucket_of,
    check_buckets,
    read_partitioned,
    remove,
    touched,
)

GOLD_KEY = ["customer_id", "event_day", "currency"]
STATE_KEY = ["customer_id", "event_type"]
BUCKETS = 64
# What decides which row of a group stands.
_RANKED = list(dict.fromkeys([*STATE_KEY, *STATE_ORDER]))
_GOLD = T.StructType([*DAILY_METRICS.fields, T.StructField("day", T.DateType())])
_STATE = T.StructType([
    *[T.StructField(f.name, f.dataType) for f in DELIVERY.fields],
    T.StructField("bucket", T.StringType())])


def _of(side: str, columns: Iterable[str]) -> Column:
    """Some columns of a change's row before or after; null if there is no such row."""
    return F.when(F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{c}") for c in columns])).alias(side)


def net_changes(changes: DataFrame, columns: Sequence[str] = DELIVERY.names) -> DataFrame:
    """event_id, before, after: what several changes of an event come to, of ``columns`` alone.

    Rows meet by event, so texts travel only if they are among the columns.
    """
    age = F.struct(*[f"_{c}" for c in DELIVERY_ORDER])
    return changes.select(
        "event_id", _of("before", columns), _of("after", columns),
        *[F.col(f"after.{c}").alias(f"_{c}") for c in DELIVERY_ORDER]).groupBy("event_id").agg(
        F.min_by("before", age).alias("before"), F.max_by("after", age).alias("after"))


def _both_sides(net: DataFrame) -> DataFrame:
    return net.select(F.explode(F.array_compact(F.array("before", "after"))).alias("r")).select("r.*")


@contextmanager
def _worked_out(root: str, step: str, **frames: DataFrame) -> Iterator[list[DataFrame]]:
    """Narrow frames of a step, worked out once beside the table for all that is asked of them."""
    found = []
    for name, frame in frames.items():
        frame.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/_{name}/{step}")
        found.append(frame.sparkSession.read.schema(frame.schema).parquet(f"{root}/_{name}/{step}"))
    yield found
    for name, frame in frames.items():
        remove(frame.sparkSession, f"{root}/_{name}/{step}")


def _event_day() -> Column:
    return F.date_trunc("day", "occurred_at").alias("event_day")


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    return read_partitioned(spark, root, _GOLD).where("event_count > 0").select(*DAILY_METRICS.names)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    return read_partitioned(spark, root, _STATE).where("event_id IS NOT NULL").select(
        *DELIVERY.names)


def refresh_gold(history: DataFrame, changes: DataFrame, root: str, step: str) -> dict[str, int]:
    """Daily metrics of the touched groups again, in the partitions of their days.

    History is read for the touched groups alone, five narrow columns of it. Returns by how much the
    events that Gold accounts for have grown.
    """
    facts = ("customer_id", "occurred_at", "currency")
    touched_groups = _both_sides(net_changes(changes, facts)).select(
        "customer_id", _event_day(), "currency").distinct()
    with _worked_out(root, step, groups=touched_groups) as (groups,):
        return _refresh_gold(history, groups, root, step)


def _refresh_gold(history: DataFrame, groups: DataFrame, root: str, step: str) -> dict[str, int]:
    spark = history.sparkSession
    few = broadcast_if_small(groups)
    facts = history.select(*GOLD_KEY[::2], _event_day(), "occurred_at", "event_id", "amount").join(
        few, GOLD_KEY, "left_semi")
    fresh = groups.join(gold_daily_metrics(facts), GOLD_KEY, "left").withColumn(
        "event_count", F.coalesce("event_count", F.lit(0)))
    days = broadcast_if_small(groups.select(F.to_date("event_day").alias("day")).distinct())
    known = read_partitioned(spark, root, _GOLD).join(days, "day", "left_semi")
    pairs = known.select(*GOLD_KEY, F.struct(*DAILY_METRICS.names).alias("was")).join(
        fresh.select(*GOLD_KEY, F.struct(*DAILY_METRICS.names).alias("now")), GOLD_KEY, "full_outer")
    chosen = pairs.select(
        F.coalesce("now", "was").alias("row"), F.coalesce("was.event_count", F.lit(0)).alias("before"))
    rows = chosen.select("row.*", F.to_date("row.event_day").alias("day"), "before")
    return apply_step(
        rows.repartition("day"), root, step, "day",
        {"gold_event_count": F.col("event_count") - F.col("before")},
        [*DAILY_METRICS.names, "day"])


def refresh_current(history: DataFrame, changes: DataFrame, root: str, step: str,
                    buckets: int = BUCKETS) -> dict[str, int]:
    """Newest event of the touched groups again, in the buckets of their keys.

    A new event is compared with the row that stands. History is read only for groups whose standing
    row moved to another group or became older. Which rows stand is found from keys and ages; only
    their texts travel. Returns by how many rows the state has grown.
    """
    check_buckets(history.sparkSession, root, buckets)
    with _worked_out(root, step, net=net_changes(changes, _RANKED)) as (net,):
        return _refresh_current(history, changes, net, root, step, buckets)


def _refresh_current(history: DataFrame, changes: DataFrame, net: DataFrame, root: str, step: str,
                     buckets: int) -> dict[str, int]:
    groups = _both_sides(net).select(*STATE_KEY).distinct().withColumn(
        "bucket", bucket_of(buckets, *STATE_KEY))
    known = read_partitioned(history.sparkSession, root, _STATE).where(
        F.col("bucket").isin(touched(groups, "bucket")))
    standing = known.where("event_id IS NOT NULL").select(*DELIVERY.names)
    age = [F.struct(*[F.col(f"{side}.{c}") for c in STATE_ORDER]) for side in ("before", "after")]
    moved = [F.col(f"before.{c}") != F.col(f"after.{c}") for c in STATE_KEY]
    sunk = net.where(F.col("before").isNotNull() & (moved[0] | moved[1] | (age[1] < age[0]))).select(
        *[F.col(f"before.{c}").alias(c) for c in STATE_KEY], "event_id")
    open_ = broadcast_if_small(sunk.join(standing, [*STATE_KEY, "event_id"], "left_semi").select(
        *STATE_KEY).distinct())
    among = broadcast_if_small(groups.select(*STATE_KEY))

    def offered(arrived: DataFrame, columns: Sequence[str]) -> DataFrame:
        rows = standing.join(open_, STATE_KEY, "left_anti"), arrived, history.join(
            open_, STATE_KEY, "left_semi")
        return reduce(DataFrame.unionByName, [r.select(*columns) for r in rows])

    # Equal numbers of two rows do no harm: the newest of what they find is taken again.
    number = F.xxhash64(*_RANKED).alias("_row")
    ahead = newest_per_key(offered(net.select("after.*"), _RANKED).join(among, STATE_KEY, "left_semi"),
                           STATE_KEY, STATE_ORDER).select(number)
    with _worked_out(root, step, ahead=ahead) as (ahead,):
        found = offered(changes.select("after.*"), DELIVERY.names).select("*", number).join(
            broadcast_if_small(ahead), "_row", "left_semi").drop("_row")
        best = newest_per_key(found, STATE_KEY, STATE_ORDER)
        return _write_current(known, groups, best, root, step)


def _write_current(known: DataFrame, groups: DataFrame, best: DataFrame, root: str, step: str,
                   ) -> dict[str, int]:
    held = [c for c in DELIVERY.names if c not in STATE_KEY]
    now = groups.join(best.select(*STATE_KEY, F.struct(*held).alias("now")), STATE_KEY, "left")
    was = known.select(*STATE_KEY, "bucket", F.struct(*held).alias("was"))
    pairs = was.join(now.withColumn("again", F.lit(True)), [*STATE_KEY, "bucket"], "full_outer")
    chosen = F.when(F.col("again"), F.col("now")).otherwise(F.col("was"))
    rows = pairs.select(*STATE_KEY, "bucket", chosen.alias("row"),
                        F.col("was.event_id").isNotNull().cast("long").alias("before"))
    rows = rows.select(*STATE_KEY, "row.*", "bucket", "before").repartition("bucket")
    return apply_step(
        rows, root, step, "bucket",
        {"current": F.col("event_id").isNotNull().cast("long") - F.col("before")},
        [*DELIVERY.names, "bucket"])


def rebuild_gold(history: DataFrame, root: str) -> None:
    """All metrics anew, as a repair."""
    rows = assert_schema(gold_daily_metrics(history), DAILY_METRICS)
    rows.withColumn("day", F.to_date("event_day")).repartition("day").write.mode(
        "overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(root)


def rebuild_current(history: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """The whole state anew, as a repair."""
    rows = assert_schema(silver_current(history), DELIVERY).withColumn(
        "bucket", bucket_of(buckets, *STATE_KEY))
    rows.repartition("bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy("bucket").parquet(root)
