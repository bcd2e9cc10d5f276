from __future__ import annotations

import json

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests import samples
from tests.test_lake import random_rows, row, same, table
from tidelake.operators.deliveries import bronze_ingest
from tidelake.operators.history import silver_current, silver_history
from tidelake.operators.metrics import gold_daily_metrics, lost_between_stages
from tidelake.operators.validation import validate_events
from tidelake.plans import refresh
from tidelake.schemas import DELIVERY, QUARANTINE_TOPIC, VALIDATED_TOPIC
from tidelake.session import settings
from tidelake.sources import derived_tables
from tidelake.sources import messages as io
from tidelake.sources.derived_tables import read_current, read_gold
from tidelake.sources.history_table import (
    merge_history,
    merged_buckets,
    read_changes,
    read_history,
)
from tidelake.sources.layers import LakePaths
from tidelake.sources.partitioned import bucket_of, read_partitioned
from tidelake.streaming import silver
from tidelake.streaming.bronze import bronze_stream
from tidelake.streaming.silver import silver_stream
from tidelake.streaming.validate import observed_rows, validate_stream
from workload import registry
from workload.views import Inputs


def stage(frame, path):
    """One file per sample batch, so that a stream takes several steps."""
    frame.select(F.lit(None).cast("string").alias("key"), "value", "topic", "partition", "offset",
                 "timestamp").repartition(4).write.mode("append").parquet(path)


def stream_history(spark, lake, checkpoint=None):
    rows = spark.readStream.schema(DELIVERY).option("maxFilesPerTrigger", 2).parquet(lake.bronze)
    silver_stream(rows, lake.silver, lake.silver_changes, checkpoint or f"{lake.checkpoints}/silver",
                  buckets=8).awaitTermination()


def run_streams(spark, lake):
    raw = io.read_event_stream(spark, "parquet", lake.raw, maxFilesPerTrigger="1")
    routing = validate_stream(raw, f"{lake.checkpoints}/validate", "parquet", lake.topics,
                              rejected_at=F.col("timestamp"))
    routing.awaitTermination()
    valid = io.read_event_stream(spark, "parquet", lake.topics, maxFilesPerTrigger="2").where(
        F.col("topic") == VALIDATED_TOPIC)
    bronze_stream(valid, lake.bronze, f"{lake.checkpoints}/bronze",
                  F.col("timestamp")).awaitTermination()
    stream_history(spark, lake)
    return observed_rows(routing)


def test_streams_equal_batch(spark, tmp_path):
    lake = LakePaths(str(tmp_path))
    everything = samples.messages(spark)
    stage(everything.where("batch in ('valid', 'invalid')"), lake.raw)
    assert run_streams(spark, lake) == {"raw": 12, "validated": 8, "quarantine": 4}
    stage(everything.where("batch in ('duplicates', 'late')"), lake.raw)
    # The streams go on where the first run stopped.
    assert run_streams(spark, lake) == {"raw": 6, "validated": 6, "quarantine": 0}

    checked = validate_events(everything)
    topics = spark.read.parquet(lake.topics)
    same(topics.where(F.col("topic") == VALIDATED_TOPIC).select("key", "value", "offset"),
         io.validated_sink(checked).select("key", "value", "offset"))
    same(topics.where(F.col("topic") == QUARANTINE_TOPIC).select("key", "value", "offset"),
         io.quarantine_sink(checked, F.col("timestamp")).select("key", "value", "offset"))
    bronze = bronze_ingest(io.validated_sink(checked), F.col("timestamp"))
    same(spark.read.parquet(lake.bronze), bronze)
    same(read_history(spark, lake.silver), silver_history(bronze))
    changed = read_changes(spark, lake.silver_changes).count()
    assert changed == 14  # eleven events, three of them delivered again

    # The same deliveries under a new checkpoint are merged again and change nothing.
    stream_history(spark, lake, str(tmp_path / "other"))
    same(read_history(spark, lake.silver), silver_history(bronze))
    assert read_changes(spark, lake.silver_changes).count() == changed


def test_keyed_state_passes_on_what_changes(spark, tmp_path):
    """Older copies and replays that come in later batches don't reach history."""
    lake = LakePaths(str(tmp_path))
    newer = table(spark, row("x", 7, "2.00", minute=30, offset=5), row("y", 8, "1.00", minute=2))
    older = table(spark, row("x", 7, "9.00", minute=3, offset=1), row("y", 8, "1.00", minute=2),
                  row("z", 9, "3.00", minute=4))
    for rows in (newer, older, newer):
        rows.write.mode("append").parquet(lake.bronze)
        stream_history(spark, lake)  # each run starts from the checkpoint of the one before
    changes = read_changes(spark, lake.silver_changes)
    assert sorted(r.event_id for r in changes.collect()) == ["x", "y", "z"]
    assert changes.where("before IS NOT NULL").count() == 0
    same(read_history(spark, lake.silver), silver_history(newer.unionByName(older)))


def test_keyed_state_calls_no_python(spark):
    """Six million events went through a Python processor one by one."""
    rows = table(spark, row("x", 7, "2.00"), row("x", 7, "2.00"), row("x", 7, "3.00", offset=9))
    unseen = silver.unseen_deliveries(rows)
    plan = unseen._jdf.queryExecution().toString()
    assert "Python" not in plan and "TransformWithState" not in plan
    assert sorted(str(r.amount) for r in unseen.collect()) == ["2.00", "3.00"]


def test_a_merge_shuffles_deliveries_once(spark, tmp_path):
    """The newest of an event's deliveries is found where they meet history, null ages being oldest."""
    root = str(tmp_path / "history")
    merge_history(table(spark, row("x", 7, "1.00"), row("y", 8, "1.00", minute=9)), root)
    late = table(spark, row("x", 7, "2.00", offset=2), row("x", 9, "4.00", minute=5, offset=3),
                 row("x", 7, "3.00", offset=4), row("z", 7, "6.00"), row("y", 1, "9.00"))
    late = late.unionByName(table(spark, row("z", 7, "7.00")).withColumn(
        "ingested_at", F.lit(None).cast("timestamp")))
    bucketed = late.withColumn("bucket", bucket_of(64, "event_id"))
    met = merged_buckets(read_partitioned(spark, root, bucketed.schema), bucketed)
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r.after.event_id, str(r.after.amount), r.changed) for r in met.collect()} == {
        ("x", "4.00", True), ("y", "1.00", False), ("z", "6.00", True)}
    merge_history(late, root)
    assert {(r.event_id, str(r.amount)) for r in read_history(spark, root).collect()} == {
        ("x", "4.00"), ("y", "1.00"), ("z", "6.00")}


def test_a_batch_that_fails_half_way_is_repeated(spark, tmp_path, monkeypatch):
    """The stream fails once its changes are published and before history has them."""
    lake = LakePaths(str(tmp_path))
    rows = [table(spark, row("x", 7, "2.00", offset=1), row("y", 8, "1.00")),
            table(spark, row("x", 9, "5.00", minute=5, offset=2))]
    rows[0].write.parquet(lake.bronze)
    stream_history(spark, lake)
    rows[1].write.mode("append").parquet(lake.bronze)
    from tidelake.sources import partitioned
    put = partitioned.replace_partitions

    def fail(frame, root, partition):
        put(frame.limit(0) if partition == "bucket" else frame, root, partition)
        raise RuntimeError("lost")

    monkeypatch.setattr(partitioned, "replace_partitions", fail)
    with pytest.raises(StreamingQueryException):
        stream_history(spark, lake)
    monkeypatch.setattr(partitioned, "replace_partitions", put)
    stream_history(spark, lake)
    same(read_history(spark, lake.silver), silver_history(rows[0].unionByName(rows[1])))
    changes = read_changes(spark, lake.silver_changes).where("before IS NOT NULL").collect()
    assert [(r.event_id, str(r.before.amount), str(r.after.amount)) for r in changes] == [
        ("x", "2.00", "5.00")]


def test_every_core_reads_a_batch_of_few_files(spark, tmp_path, monkeypatch):
    """Files of one row group are read by a task each, whatever the number of cores."""
    monkeypatch.setattr(registry, "ROW_GROUP", 1 << 13)
    registry._staged_messages(Inputs(spark, "/root/testdata/sf0.001"), str(tmp_path / "raw"))
    groups = [pq.ParquetFile(p).num_row_groups for p in (tmp_path / "raw").glob("*.parquet")]
    assert sum(groups) > len(groups)


def test_age_of_a_delivery():
    assert silver._AGE.count("long") == 4 and "kafka_offset long" in silver._AGE


def test_sinks(spark):
    checked = validate_events(samples.messages(spark))
    valid = {r.offset: r for r in io.validated_sink(checked).collect()}
    assert valid[2].key == samples.VALID[2]["event_id"]
    assert json.loads(valid[2].value) == {
        **samples.VALID[2], "occurred_at": "2025-03-10T23:00:00Z"}
    rejected = {r.offset: r for r in io.quarantine_sink(checked).collect()}
    assert rejected[15].key == "raw.events:0:15"
    content = json.loads(rejected[15].value)
    assert json.loads(content["payload"])["event_id"] == "no such id"
    assert content["source"] == {"topic": "raw.events", "partition": 0, "offset": 15,
                                 "received_at": "2025-03-16T05:00:15Z"}
    routed = io.route_messages(checked, F.col("timestamp"))
    same(routed, io.validated_sink(checked).unionByName(
        io.quarantine_sink(checked, F.col("timestamp"))))


def test_refresh_and_reconcile(spark, tmp_path):
    lake = LakePaths(str(tmp_path))
    refresh.validate_batch(samples.messages(spark), lake)
    for step in (refresh.refresh, refresh.refresh, None):  # repeating it leaves the same rows
        if step:
            step(spark, lake, F.col("timestamp"))
        else:
            refresh.remerge_silver(spark, lake)
            refresh.follow_changes(spark, lake)
            refresh.rebuild(spark, lake)
        report = refresh.reconcile(spark, lake)
        counts = {r.stage: r["rows"] for r in report.collect()}
        assert counts == {"raw": 18, "validated": 14, "quarantine": 4, "bronze": 14,
                          "history": 11, "current": 7, "gold_event_count": 11}
        same(report, refresh.recount(spark, lake))  # reading every stage gives the same
        assert lost_between_stages(report).collect() == []


def test_a_lost_message_shows(spark, tmp_path, monkeypatch):
    """One message vanishes between raw and the topics, one delivery between topics and Bronze."""
    lake, route = LakePaths(str(tmp_path)), refresh.route_messages
    monkeypatch.setattr(refresh, "route_messages",
                        lambda *a: route(*a).where("NOT (offset <=> 3)"))
    refresh.validate_batch(samples.messages(spark), lake)
    monkeypatch.setattr(refresh, "route_messages", route)
    report = refresh.reconcile(spark, lake)
    assert [tuple(r) for r in lost_between_stages(report).collect() if r.stage == "raw"] == [
        ("raw", 18, 17, 1)]
    assert refresh.published(spark, lake).count() == 17
    monkeypatch.setattr(refresh, "published_stream", lambda spark, lake: io.read_event_stream(
        spark, "parquet", lake.batch_topics).where("offset <> 1"))
    refresh.load_bronze(spark, lake, F.col("timestamp"))
    lost = lost_between_stages(refresh.reconcile(spark, lake)).collect()
    assert [tuple(r) for r in lost] == [("raw", 18, 17, 1), ("validated", 13, 12, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_followers_equal_a_rebuild(spark, tmp_path, seed):
    """Random deliveries move events between customers, types, days and currencies, and back."""
    lake, everything = LakePaths(str(tmp_path)), None
    for part in range(3):
        rows = [(*r[:1], ("order_placed", "visit_booked")[r[10] % 2], *r[2:5],
                 ("CHF", "JPY")[r[10] % 3 % 2], *r[6:])
                for r in random_rows(10 * seed + part, n=60, keys=25)]
        arrived = table(spark, *rows)
        everything = arrived if everything is None else everything.unionByName(arrived)
        merge_history(arrived, lake.silver, lake.silver_changes, f"part-{part}", buckets=4)
        if part != 1:  # two steps are followed at once
            refresh.follow_changes(spark, lake)
    kept = silver_history(everything)
    same(read_history(spark, lake.silver), kept)
    same(read_gold(spark, lake.gold), gold_daily_metrics(kept))
    same(read_current(spark, lake.silver_current), silver_current(kept))


def test_late_correction_moves_an_event_to_another_day(spark, tmp_path):
    """The day it leaves has no other event; its group and its day go empty."""
    lake = LakePaths(str(tmp_path))
    first = table(spark, row("a", 7, "1.00", offset=1), row("b", 9, "4.00", customer="acct-q"))
    moved = table(spark, row("a", 9, "2.00", customer="acct-q", minute=5, offset=2))
    for arrived in (first, moved):
        merge_history(arrived, lake.silver, lake.silver_changes)
        refresh.follow_changes(spark, lake)
    got = read_gold(spark, lake.gold).collect()
    assert [(r.customer_id, r.event_day.day, r.event_count, str(r.total_amount)) for r in got] == [
        ("acct-q", 9, 2, "6.00")]
    kept = silver_history(first.unionByName(moved))
    same(read_current(spark, lake.silver_current), silver_current(kept))


def files_of(root):
    return {p.relative_to(root).as_posix(): p.stat().st_mtime_ns
            for p in root.rglob("*.parquet")}


def test_a_change_rewrites_its_bucket_only(spark, tmp_path):
    lake = LakePaths(str(tmp_path))
    rows = [row(f"event-{n}", 1 + n % 28, "1.00", offset=n) for n in range(400)]
    merge_history(table(spark, *rows), lake.silver, buckets=16)
    before = files_of(tmp_path / "silver")
    by_bucket: dict = {}
    for r in spark.read.parquet(lake.silver).select("event_id", "bucket").collect():
        by_bucket.setdefault(r.bucket, []).append(r.event_id)
    bucket = sorted(by_bucket)[3]
    changed = by_bucket[bucket][:4]  # one percent of the keys
    merge_history(table(spark, *[row(k, 3, "7.00", minute=9, offset=900) for k in changed]),
                  lake.silver, buckets=16)
    after = files_of(tmp_path / "silver")
    kept = {k: v for k, v in before.items() if not k.startswith(f"bucket={bucket}/")}
    assert {k: v for k, v in after.items() if not k.startswith(f"bucket={bucket}/")} == kept
    assert not set(after) & set(before) - set(kept)
    assert len([k for k in after if k.startswith(f"bucket={bucket}/")]) == 1
    assert spark.read.parquet(lake.silver).where("amount = 7").count() == 4
    with pytest.raises(ValueError, match="not buckets of 32"):
        merge_history(table(spark, *rows[:1]), lake.silver, buckets=32)


def test_batch_and_stream_both_reach_the_topics(spark, tmp_path):
    """Batch, stream, batch: every message is in a topic, and in Bronze if it is valid."""
    lake, everything = LakePaths(str(tmp_path)), samples.messages(spark)
    refresh.validate_batch(everything, lake)
    refresh.load_bronze(spark, lake)
    stage(everything.where("offset < 2").withColumn("offset", F.col("offset") + 100), lake.raw)
    raw = io.read_event_stream(spark, "parquet", lake.raw)
    validate_stream(raw, f"{lake.checkpoints}/validate", "parquet", lake.topics).awaitTermination()
    refresh.load_bronze(spark, lake)
    refresh.validate_batch(everything.withColumn("offset", F.col("offset") + 200), lake)
    refresh.load_bronze(spark, lake)
    assert refresh.published(spark, lake).count() == 18 + 2 + 18
    assert refresh.read_topic(spark, lake, QUARANTINE_TOPIC).count() == 4 + 4
    assert spark.read.parquet(lake.bronze).count() == 14 + 2 + 14


def test_messages_are_validated_by_more_tasks_than_events_come_in(spark, tmp_path, monkeypatch):
    # Events come in one row group, which one task read and validated.
    spark.read.parquet("/root/testdata/sf0.01/events.parquet").coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").write.parquet(
        f"{tmp_path}/documents.parquet")
    tasks, validate_batch = [], refresh.validate_batch

    def counted(messages, lake):
        tasks.append(messages.select(F.spark_partition_id()).distinct().count())
        validate_batch(messages, lake)

    monkeypatch.setattr(refresh, "validate_batch", counted)
    monkeypatch.setattr(registry, "ROW_GROUP", 64 << 10)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "128k",
                          "spark.sql.files.openCostInBytes": "64k"}):
        registry.QUERIES["bronze_stream"](spark, str(tmp_path)).count()
    assert tasks[0] > 1


def test_followers_move_the_texts_of_rows_that_stand_and_no_others(spark, tmp_path, monkeypatch):
    """Every change used to meet the others of its event, and of its group, with both its texts."""
    lake, seen, newest = LakePaths(str(tmp_path)), [], derived_tables.newest_per_key
    merge_history(table(spark, *[row(f"e{n}", 1 + n % 28, "1.00", offset=n) for n in range(60)]),
                  lake.silver, lake.silver_changes, "first")
    merge_history(table(spark, *[row(f"e{n}", 2, "3.00", minute=9, offset=90) for n in range(9)]),
                  lake.silver, lake.silver_changes, "second")

    def counted(frame, *given):
        if "document_text" in frame.columns:
            seen.append(frame.count())
        return newest(frame, *given)

    monkeypatch.setattr(derived_tables, "newest_per_key", counted)
    met = derived_tables.net_changes(read_changes(spark, lake.silver_changes), ["customer_id"])
    assert "document_text" not in met._jdf.queryExecution().executedPlan().toString()
    refresh.follow_changes(spark, lake)
    kept = silver_history(read_history(spark, lake.silver))
    stands = read_current(spark, lake.silver_current)
    same(stands, silver_current(kept))
    assert seen == [stands.count()]
    same(read_gold(spark, lake.gold), gold_daily_metrics(kept))
    assert not [p for p in tmp_path.rglob("*.parquet") if "/_" in p.relative_to(tmp_path).as_posix()]


def test_a_streams_batch_takes_large_files(spark, monkeypatch):
    """As small as the shuffle made them, four files a batch meant a batch for every few megabytes."""
    batches, start = [], registry.start_silver

    def counted(*given):
        query = start(*given)
        query.awaitTermination()
        batches.append(query.lastProgress["batchId"] + 1)
        return query

    monkeypatch.setattr(registry, "start_silver", counted)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                          "spark.sql.shuffle.partitions": "30",
                          "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
                          "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}):
        stored = registry.QUERIES["silver_stream"](spark, "/root/testdata/sf0.001").count()
    assert stored == 1000 and batches[0] <= 2  # the second brings no rows
