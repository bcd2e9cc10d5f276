from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import samples
from tidelake.operators import deliveries, history, metrics, quality
from tidelake.operators.schema_guard import (
    SchemaError,
    assert_schema,
    verify_schema_enforcement,
)
from tidelake.operators.validation import validate_events
from tidelake.schemas import DAILY_METRICS, DELIVERY, VALIDATED_TOPIC
from tidelake.sources import messages as io
from tidelake.sources.history_table import merge_history, read_history
from tidelake.sources.layers import (
    LakePaths,
    current_version,
    expire_versions,
    merge_into,
    read_layer,
    write_create,
    write_snapshot,
)


def row(event_id, day, amount, *, customer="acct-z", kind="order_placed", currency="CHF",
        minute=0, offset=0):
    """A delivery that arrived a given minute after midnight of the 20th."""
    arrived = dt.datetime(2025, 3, 20, 0, minute)
    return (event_id, kind, customer, dt.datetime(2025, 3, day, 17, 30), Decimal(amount), currency,
            f"{kind} {event_id}", "1.0", VALIDATED_TOPIC, 2, offset, arrived, arrived)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), DELIVERY)


def same(a, b):
    columns = a.columns
    assert sorted(map(str, a.select(columns).collect())) == sorted(
        map(str, b.select(columns).collect()))


def bronze_samples(spark):
    return deliveries.bronze_ingest(
        io.validated_sink(validate_events(samples.messages(spark))), F.col("timestamp"))


def test_sample_lake(spark):
    bronze = bronze_samples(spark)
    assert bronze.schema.simpleString() == DELIVERY.simpleString()
    assert deliveries.bronze_summary(bronze).first() == (14, 11, 3)
    kept = history.silver_history(bronze)
    current = history.silver_current(kept)
    assert (kept.count(), current.count()) == (11, 7)
    assert {int(r.event_id[-12:]) for r in current.collect()} == {2, 3, 4, 5, 6, 7, 8}
    gold = metrics.gold_daily_metrics(kept)
    assert gold.schema.simpleString() == DAILY_METRICS.simpleString()
    got = {(r.customer_id[-1], r.event_day.strftime("%m-%d"), r.currency):
           (r.event_count, str(r.total_amount), str(r.average_amount)) for r in gold.collect()}
    assert got == {
        ("a", "03-10", "GBP"): (2, "20.00", "10.000000"),
        ("a", "03-15", "GBP"): (1, "3.35", "3.350000"),
        ("b", "03-02", "JPY"): (1, "18.00", "18.000000"),
        ("b", "03-10", "JPY"): (1, "300.00", "300.000000"),
        ("b", "03-12", "CHF"): (1, "41.05", "41.050000"),
        ("c", "03-05", "GBP"): (1, "5.55", "5.550000"),
        ("c", "03-13", "GBP"): (2, "9.99", "4.995000"),
        ("d", "03-10", "CHF"): (1, "2.80", "2.800000"),
        ("d", "03-14", "CHF"): (1, "64.20", "64.200000"),
    }
    late = samples.messages(spark).where("batch = 'late'").select(
        F.get_json_object("value", "$.event_id").alias("event_id"))
    assert history.late_in_history(kept, late).count() == 3


def test_history_keeps_the_newest_copy(spark):
    """A correction that arrives later wins, whatever its offset; other events are left alone."""
    bronze = table(spark, row("x", 7, "3.10", minute=9, offset=4), row("y", 8, "55.00", minute=1),
                   row("x", 7, "2.90", minute=31, offset=2), row("x", 7, "3.00", minute=15, offset=8))
    got = {r.event_id: str(r.amount) for r in history.silver_history(bronze).collect()}
    assert got == {"x": "2.90", "y": "55.00"}


def test_currencies_stay_apart(spark):
    day = [row("p", 9, "7.25"), row("q", 9, "1900.00", currency="JPY"), row("r", 9, "0.75")]
    gold = metrics.gold_daily_metrics(table(spark, *day))
    assert {(r.currency, r.event_count, str(r.total_amount)) for r in gold.collect()} == {
        ("CHF", 2, "8.00"), ("JPY", 1, "1900.00")}


def random_rows(seed, n=300, keys=60):
    rng = random.Random(seed)
    return [row(f"event-{rng.randrange(keys) if rng.random() > 0.34 else 0}", rng.randint(1, 28),
                f"{rng.randint(0, 9999) / 100:.2f}", customer=f"c{rng.randrange(9)}",
                minute=rng.randint(0, 59), offset=seed * 10_000 + k) for k in range(n)]


def test_delivery_order_does_not_matter_and_gold_counts_history(spark):
    rows = random_rows(1)  # a third of the deliveries are copies of one event
    expected = {}
    for r in rows:
        best = expected.get(r[0])
        if best is None or (r[12], r[11], r[9], r[10]) > (best[12], best[11], best[9], best[10]):
            expected[r[0]] = r
    got = history.silver_history(table(spark, *rows).repartition(7))
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected.values())
    same(got, history.silver_history(table(spark, *reversed(rows)).repartition(3)))
    assert metrics.gold_daily_metrics(got).agg(F.sum("event_count")).first()[0] == len(expected)


def test_rank_filter_limits_groups_before_the_shuffle(spark):
    plan = history.silver_history(table(spark, *random_rows(1)))._jdf.queryExecution()
    assert "Partial" in plan.executedPlan().toString()
    assert "WindowGroupLimit" in plan.executedPlan().toString()


@pytest.mark.parametrize("small", [False, True])
def test_merge(spark, small):
    target = history.silver_history(table(spark, *random_rows(1)))
    source = history.silver_history(table(spark, *random_rows(2, keys=90)))
    merged = history.merge_upsert(target, source, broadcast_source=small)
    t = {r.event_id: r for r in target.collect()}
    expected = dict(t)
    for s in source.collect():
        if s.event_id not in t or s.ingested_at >= t[s.event_id].ingested_at:
            expected[s.event_id] = s
    assert sorted(map(str, merged.collect())) == sorted(map(str, expected.values()))
    same(merged, history.merge_upsert(merged, source, broadcast_source=small))  # twice = once
    empty = table(spark)
    same(target, history.merge_upsert(target, empty, broadcast_source=small))
    same(source, history.merge_upsert(empty, source, broadcast_source=small))


def test_replays_and_new_ids(spark):
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "event_id string")
    batch, earlier = ids("a", "a", "b", "c"), ids("a", "c", "d")
    assert {r[0] for r in deliveries.replayed_ids(batch, earlier).collect()} == {"a", "c"}
    assert [r[0] for r in deliveries.new_ids(batch, earlier).collect()] == ["b"]


def test_gates(spark):
    good = history.silver_history(table(spark, *random_rows(3)))
    gold = metrics.gold_daily_metrics(good)
    for layer, frame in {"bronze": table(spark, *random_rows(3)), "silver": good, "gold": gold,
                         "silver_current": history.silver_current(good)}.items():
        assert quality.run_gate(frame, layer) is frame
    bad = good.unionByName(good).withColumn(
        "amount", F.when(F.col("event_id") == "event-0", F.lit(-1).cast("decimal(16,2)"))
        .otherwise(F.col("amount")))
    with pytest.raises(quality.QualityError, match="unique.event_id") as error:
        quality.run_gate(bad, "silver")
    assert "between(amount) fails on 2" in str(error.value)
    assert "customer_id" not in str(error.value)
    found = quality.gate_violations(bad, "silver", ["event_id", "amount"])
    counts = {r["rule"]: r["count"] for r in found.groupBy("rule").count().collect()}
    assert counts == {"unique": bad.count(), "between": 2}
    with pytest.raises(ValueError, match="platinum"):
        quality.run_gate(good, "platinum")


def test_nulls_and_empty_tables_in_rules(spark):
    rows = spark.createDataFrame(
        [("a", None), ("a", None), (None, None), (None, None), ("b", 1), (None, 1)],
        "x string, y int")
    report = lambda rule: quality.check_rules(rows, [rule]).first()
    assert report(quality.unique("x"))[3:] == (3, 2, False)
    assert report(quality.unique("x", "y"))[3:] == (4, 2, False)
    assert report(quality.between("y", 1, 1))[3:] == (2, 0, True)
    assert report(quality.not_null("x"))[3:] == (6, 3, False)
    empty = rows.limit(0)
    assert all(r.passed for r in quality.check_rules(
        empty, [quality.not_null("x"), quality.unique("x"), quality.between("y", 0)]).collect())


def test_schema_guard(spark):
    good = table(spark, row("a", 1, "1.00"))
    assert assert_schema(good.select(*reversed(good.columns)), DELIVERY).columns == DELIVERY.names
    assert assert_schema(good.drop("document_text"), DELIVERY).first().document_text is None
    with pytest.raises(SchemaError, match="unexpected column extra"):
        assert_schema(good.withColumn("extra", F.lit(1)), DELIVERY)
    with pytest.raises(SchemaError, match="missing required column event_id"):
        assert_schema(good.drop("event_id"), DELIVERY)
    with pytest.raises(SchemaError, match="amount is double"):
        assert_schema(good.withColumn("amount", F.col("amount").cast("double")), DELIVERY)
    with pytest.raises(Exception, match="null in required column amount"):
        assert_schema(good.withColumn("amount", F.lit(None).cast("decimal(16,2)")), DELIVERY).collect()


def test_a_writer_refuses_what_does_not_fit(spark, tmp_path):
    root = str(tmp_path / "silver")
    good = table(spark, row("s", 3, "1.00"))
    merge_history(good, root)
    verify_schema_enforcement(good, lambda rows: merge_history(rows, root))
    with pytest.raises(Exception, match="null in required column currency"):
        merge_history(good.withColumn("currency", F.lit(None).cast("string")), root)
    assert [r.event_id for r in read_history(spark, root).collect()] == ["s"]
    with pytest.raises(SchemaError, match="the writer took"):
        verify_schema_enforcement(good, lambda rows: None)


def test_layer_tables(spark, tmp_path):
    root = str(tmp_path / "silver")
    assert current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_layer(spark, root)
    write_snapshot(table(spark, row("a", 1, "1.00")), root, DELIVERY)
    grown = read_layer(spark, root).unionByName(table(spark, row("b", 1, "2.00")))
    write_snapshot(grown, root, DELIVERY)  # reads the version it replaces
    assert current_version(spark, root) == 1
    assert {r.event_id for r in read_layer(spark, root).collect()} == {"a", "b"}
    with pytest.raises(SchemaError):
        write_snapshot(grown.withColumn("extra", F.lit(1)), root, DELIVERY)
    path = str(tmp_path / "created")
    write_create(grown, path, DELIVERY)
    with pytest.raises(Exception, match="already exists"):
        write_create(grown, path, DELIVERY)
    assert LakePaths("/x/").silver == "/x/silver"


def test_old_versions_expire_only_when_asked(spark, tmp_path):
    root = str(tmp_path / "table")
    for n in range(4):
        write_snapshot(table(spark, row(f"e{n}", 1 + n, "1.00")), root, DELIVERY)
    assert current_version(spark, root) == 3
    assert expire_versions(spark, root, retain=2) == ["version-0000000000", "version-0000000001"]
    assert [r.event_id for r in read_layer(spark, root).collect()] == ["e3"]
    with pytest.raises(ValueError):
        expire_versions(spark, root, retain=0)


def test_json_array_files(spark, tmp_path):
    import json

    for name, records in samples.BATCHES.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(records, indent=1))
    records = io.read_json_events(spark, str(tmp_path))
    counts = {r.batch: r.records for r in deliveries.batch_record_counts(records).collect()}
    assert counts == {f"{k}.json": len(b) for k, b in samples.BATCHES.items()}
    first = records.where("batch = 'late.json' and position = 1").first()
    assert json.loads(first.value) == samples.LATE[1]
    for bad in ('{"a": 1}', '[{"a": 1}, 2]', "[[]]"):
        path = tmp_path / "bad"
        path.mkdir(exist_ok=True)
        (path / "x.json").write_text(bad)
        with pytest.raises(Exception, match="JSON array of objects"):
            io.read_json_events(spark, str(path)).collect()


def test_merge_in_place_needs_a_table_format(spark, tmp_path):
    rows = table(spark, row("a", 1, "1.00"))
    spark.sql("DROP TABLE IF EXISTS plain_history")
    rows.write.option("path", str(tmp_path / "t")).saveAsTable("plain_history")
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge_into(rows, "plain_history")
    spark.sql("DROP TABLE plain_history")
