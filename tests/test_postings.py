from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.operators import posting_search as module
from tidelake.operators.lexical import bm25_search
from tidelake.operators.posting_search import block_report, posting_search
from tidelake.operators.term_index import bm25_index
from tidelake.sources.postings_table import block_of, blocks_of, read_postings, write_postings


def collection(spark, seed=1, chunks=1500):
    """Words with very unequal frequencies; every text has the commonest one; some texts repeat."""
    draw, rows = random.Random(seed), []
    words = [f"w{n}" for n in range(400)]
    shares = [1 / (n + 1) for n in range(400)]
    for n in range(chunks):
        text = " ".join(["every", *draw.choices(words, shares, k=draw.randint(1, 60))])
        title = " ".join(draw.choices(words[:40], k=draw.randint(0, 3)))
        rows.append((f"c{n:05d}", title, rows[-1][2] if n % 50 == 49 else text))
    return spark.createDataFrame(rows, "chunk_id string, title string, text string")


QUESTIONS = ["every", "every w0 w399", "w5 w5 w90", "w350 w351 w352 w0", "unknown every", "nowhere",
             "w1 w2 w3 w4 w5 w6 w7 w8 every", "w17"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("postings"))
    bm25_index(collection(spark)).write.parquet(f"{root}/index")
    index = spark.read.parquet(f"{root}/index")
    write_postings(index, f"{root}/postings", block=8)
    return index, read_postings(spark, f"{root}/postings")


def rounded(frame):
    return sorted((r["query_id"], r["chunk_id"], round(r["lexical_score"], 8), r["rank"])
                  for r in frame.collect())


@pytest.mark.parametrize("k", [1, 7, 3000])
def test_the_same_as_scanning_the_index(spark, stored, k):
    index, postings = stored
    questions = spark.createDataFrame(list(enumerate(QUESTIONS)), "query_id long, query string")
    assert rounded(posting_search(postings, questions, k)) == rounded(
        bm25_search(index, questions, k))


def test_blocks_hold_every_posting_once(spark, stored):
    index, postings = stored
    blocks = postings.blocks
    assert blocks.agg(F.sum(F.size("ids"))).first()[0] == index.agg(
        F.sum(F.size("title_terms") + F.size("text_terms"))).first()[0]
    assert blocks.where(F.array_max("impacts") != F.col("greatest")).count() == 0
    common = postings.terms.where("term = 'every' AND field = 'text'").first()
    assert (common["document_frequency"], common["groups"]) == (1500, 256)


def test_most_blocks_of_common_terms_are_skipped(spark, stored):
    questions = spark.createDataFrame([(0, "every w0 w390")], "query_id long, query string")
    report = block_report(stored[1], questions, k=5).first()
    assert report["blocks"] == report["blocks_read"] + report["blocks_skipped"]
    assert report["blocks_read"] < report["blocks"] / 2


def test_no_question_and_no_index(spark, stored, tmp_path):
    none = spark.createDataFrame([], "query_id long, query string")
    assert posting_search(stored[1], none).collect() == []
    empty = stored[0].limit(0)
    write_postings(empty, str(tmp_path / "empty"))
    asked = spark.createDataFrame([(0, "every")], "query_id long, query string")
    assert posting_search(read_postings(spark, str(tmp_path / "empty")), asked).collect() == []


def test_postings_travel_and_lie_as_numbers(spark, tmp_path):
    """IDs are long texts: they are stored once a chunk and not with every posting."""
    rows = collection(spark, chunks=200).withColumn("chunk_id", F.sha2("chunk_id", 256))
    index = bm25_index(rows)
    write_postings(index, str(tmp_path), block=8)
    postings = read_postings(spark, str(tmp_path))
    assert postings.blocks.schema["ids"].dataType.simpleString() == "array<bigint>"
    assert postings.chunks.count() == postings.chunks.select("number").distinct().count() == 200
    known = postings.chunks.join(postings.blocks.select(
        "field", "term", F.explode("ids").alias("number")), "number").select("chunk_id", "field", "term")
    want = index.select("chunk_id", F.lit("text").alias("field"), F.explode("text_terms.term")).union(
        index.select("chunk_id", F.lit("title"), F.explode("title_terms.term")))
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, want.collect()))


def test_scores_are_added_up_in_shards_and_few_rows_leave_them(spark, stored, monkeypatch):
    """Every pair of a query and a chunk that a block held was a row, looked up term by term."""
    left, by_shard = [], module._by_shard

    def seen(*given):
        left.append(by_shard(*given).count())
        return by_shard(*given)

    index, postings = stored
    questions = spark.createDataFrame(list(enumerate(QUESTIONS)), "query_id long, query string")
    monkeypatch.setattr(module, "_by_shard", seen)
    monkeypatch.setattr(module, "SHARD_CHUNKS", 200)
    monkeypatch.setattr(module, "QUERY_ROWS", 3)
    assert rounded(posting_search(postings, questions, 5)) == rounded(bm25_search(index, questions, 5))
    copies = 2  # texts repeat: some tie with the k-th
    assert 5 < left[0] <= 8 * len(QUESTIONS) * 5 * copies


def test_blocks_are_the_same_in_spark_and_numpy(spark):
    numbers = np.concatenate([np.arange(4000), (7 << 33) + 256 * np.arange(4000)])
    rows = spark.createDataFrame([(int(n),) for n in numbers], "number long")
    for groups in (1, 8, 1024):
        found = [r[0] for r in rows.select(block_of(F.col("number"), F.lit(groups))).collect()]
        assert found == blocks_of(numbers, groups).tolist()
        assert np.bincount(found, minlength=groups).max() <= 3 * len(numbers) / groups
    assert (blocks_of(numbers, 1024) % 8 == blocks_of(numbers, 8)).all()
