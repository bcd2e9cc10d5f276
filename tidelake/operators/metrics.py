"""Gold metrics and row reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gold_daily_metrics(history: DataFrame) -> DataFrame:
    """Daily count, total and average per customer and currency."""
    return history.groupBy(
        "customer_id", F.date_trunc("day", "occurred_at").alias("event_day"), "currency",
    ).agg(
        F.count("event_id").alias("event_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"),
    )


def events_by_type(history: DataFrame) -> DataFrame:
    return history.groupBy("event_type").agg(F.count("*").alias("events")).orderBy(
        "events", "event_type")


def daily_total_by_currency(gold: DataFrame) -> DataFrame:
    return gold.groupBy("currency", "event_day").agg(F.sum("total_amount").alias("total_amount"))


def stage_reconciliation(stages: dict[str, DataFrame], gold: DataFrame) -> DataFrame:
    """Row count of each stage, and the events Gold accounts for."""
    counts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, frame in stages.items()
    ]
    counts.append(gold.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("rows")).select(
        F.lit("gold_event_count").alias("stage"), "rows"))
    return reduce(DataFrame.unionByName, counts)


# Which stages a stage's rows go to. History and current state keep one row of several.
FLOWS = (("raw", ("validated", "quarantine")), ("validated", ("bronze",)),
         ("history", ("gold_event_count",)))
STAGES = ("raw", "validated", "quarantine", "bronze", "history", "current", "gold_event_count")


def reconciled(entries: DataFrame) -> DataFrame:
    """stage, rows: what the steps of each stage (stage, rows) come to; 0 for one without steps."""
    stages = entries.sparkSession.createDataFrame([(s,) for s in STAGES], "stage string")
    return stages.join(entries.groupBy("stage").agg(F.sum("rows").alias("rows")), "stage",
                       "left").select("stage", F.coalesce("rows", F.lit(0)).alias("rows"))


def lost_between_stages(report: DataFrame) -> DataFrame:
    """stage, rows, arrived, lost for each stage whose rows don't all reach the next ones.

    A negative number says that more rows arrived than left.
    """
    rows = report.agg(*[F.coalesce(F.max(F.when(F.col("stage") == s, F.col("rows"))), F.lit(0)).alias(s)
                        for s in STAGES])
    flows = [F.struct(F.lit(source).alias("stage"), F.col(source).alias("rows"),
                      reduce(lambda a, b: a + b, [F.col(t) for t in into]).alias("arrived"))
             for source, into in FLOWS]
    found = rows.select(F.explode(F.array(*flows)).alias("f")).select("f.*")
    return found.withColumn("lost", F.col("rows") - F.col("arrived")).where("lost <> 0")
