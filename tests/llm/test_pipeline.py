"""Each stage against a plain version on its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dart_dedup import groups, least
from tests.llm.test_tokens import whole
from tidelake.llm import secrets
from tidelake.llm.queries import vocabulary
from tidelake.session import settings

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{TABLES}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, TABLES).write.parquet(path)
        out.append((name, docs, docs := spark.read.parquet(path)))
    return {name: (before, after, before.collect(), after.collect()) for name, before, after in out}


def test_all_but_the_last_keep_the_columns(steps):
    assert list(steps) == ["quality", "near_duplicates", "secrets", "mix", "pack"]
    for name, (before, after, _, _) in steps.items():
        assert name == "pack" or after.dtypes == before.dtypes


def test_quality_keeps_rows_whole_and_the_good_ones(spark, steps):
    before, after = (set(map(tuple, rows)) for rows in steps["quality"][2:])
    assert after < before
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").collect()
    good = {r["doc_id"] for r in labels if r["quality"] == 1} & {r[0] for r in before}
    bad = {r["doc_id"] for r in labels if r["quality"] == 0}
    kept = {r[0] for r in after}
    assert len(good & kept) >= 0.98 * len(good) and len(bad & kept) <= 0.1 * len(bad)


def test_one_of_each_group_stays(steps):
    before, after = steps["near_duplicates"][2:]
    wanted = {least(g) for g in groups([(r["doc_id"], r["text"]) for r in before])}
    assert {tuple(r) for r in after} == {tuple(r) for r in before if r["doc_id"] in wanted}


def test_secrets_are_gone_and_nothing_else(steps):
    before, after = steps["secrets"][2:]
    texts = {r["doc_id"]: r["text"] for r in after}
    assert len(before) == len(after)
    for r in before:
        assert secrets.base_spans(texts[r["doc_id"]]) == []
        if not secrets.base_spans(r["text"]) and secrets.MASK not in texts[r["doc_id"]]:
            assert texts[r["doc_id"]] == r["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_mix_repeats_rows(steps):
    before, after = steps["mix"][2:]
    times = Counter(map(tuple, after))
    assert set(times) <= set(map(tuple, before)) and max(times.values()) <= 2
    sizes = [sum(len(r["text"].split()) for r in rows) for rows in (before, after)]
    assert abs(sizes[1] - 1.5 * sizes[0]) < 0.15 * sizes[0]


def test_every_copy_is_packed(steps):
    before, after = steps["pack"][2:]
    ids = whole(vocabulary("word_bpe_49k.json"), [r["text"] for r in before])
    assert sum(r["length"] for r in after) == sum(len(i) + 1 for i in ids)
    assert Counter(r["doc_id"] for r in after if r["piece"] == 0) == Counter(
        r["doc_id"] for r in before)
    used = Counter()
    for r in after:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 4096 and len(used) <= 1.05 * sum(used.values()) / 4096 + 1


def test_results_written_after_a_stage_returned_take_small_batches(spark):
    # Stages are called by themselves too; every one sets the batches that its result is written with.
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [len(batch)], "bytes": [batch.nbytes]})

    # Two partitions: many short rows, and fewer rows of 10 kB.
    docs = spark.range(0, 9000, 1, 2).select(
        F.when(F.col("id") < 4500, "x").otherwise(F.repeat(F.lit("x"), 10_000)).alias("text"))
    stage = corpus_pipeline.in_small_batches(
        lambda spark, docs, _: docs.mapInArrow(sizes, "rows long, bytes long"))
    with settings(spark, {name: spark.conf.get(name) for name in corpus_pipeline.BATCH}):
        found = stage(spark, docs, TABLES).collect()
    assert sum(r["rows"] for r in found) == 9000
    assert max(r["rows"] for r in found) <= 2000 and max(r["bytes"] for r in found) <= 5 << 20


def test_run(spark, steps):
    found = corpus_pipeline.run(spark, TABLES).drop("sequence_id", "offset").collect()
    drop = ("sequence_id", "offset")
    wanted = steps["pack"][1].drop(*drop).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, wanted))
