from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.tables import documents, rows
from tests.llm.test_tokens import whole
from tidelake.llm import huffman
from tidelake.llm.queries import vocabulary


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=2, max_size=200), st.integers(8, 18))
def test_lengths_are_a_full_code_within_the_limit(counts, longest):
    bits = huffman.code_lengths(np.array(counts), longest)
    assert bits.max() <= max(longest, 8) and sum(2.0 ** -b for b in bits.tolist()) == 1.0
    order = np.argsort(counts, kind="stable")
    assert (np.diff(bits[order]) <= 0).all()  # rarer symbols never have shorter words


def test_best_lengths_where_the_limit_does_not_bind():
    import heapq

    counts = [int(1 + n ** 2.5) for n in range(1, 60)]
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    bits = huffman.code_lengths(np.array(counts), 30)
    assert int((bits * np.array(counts)).sum()) == cost


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70), max_size=700), min_size=1, max_size=5))
def test_round_trip(docs):
    ids = np.array([i for d in docs for i in d], np.int64)
    starts = np.cumsum([0, *map(len, docs)])
    if not len(ids):
        return
    symbols, counts = np.unique(ids, return_counts=True)
    code = huffman.Code(symbols, huffman.code_lengths(counts, 9))
    raw, bounds, at = code.write(ids, starts)
    payload = np.frombuffer(raw[:bounds[-1]], np.uint8)
    marks = huffman._offsets(starts)
    length = np.diff(np.append(marks, len(ids)))
    assert code.read(payload, at[marks], length).tolist() == ids.tolist()
    for a, b in zip(bounds[:-1] * 8, starts[:-1], strict=True):
        if b < len(ids) and b in marks:
            assert at[b] == a  # documents begin on byte boundaries


def test_files(spark, tmp_path, monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    huffman.encode_corpus(documents(spark), path, 2, str(tmp_path / "ids"))
    blocks = spark.read.parquet(str(tmp_path / "ids/blocks"))
    assert "payload" in blocks.columns
    found = huffman.read_ids(spark, str(tmp_path / "ids")).collect()
    wanted = sorted(((r[0] is not None, r[0] or 0), tuple(i + [2])) for r, i in zip(
        rows(), whole(path, [r[1] or "" for r in rows()]), strict=True))
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0),
                  tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found)
    assert got == wanted
    start = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) // 4
        start += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert zlib.crc32(found[0]["ids"]) >= 0


def test_empty(spark):
    folder = huffman.encode_corpus(documents(spark, empty=True), vocabulary("byte_bpe_50k.json"), 2)
    assert huffman.read_ids(spark, folder).collect() == []


@pytest.mark.parametrize("limit", [1, 10, 10**6])
def test_slices_cover_a_batch(limit):
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "", "x" * 50, "y"])], ["text"]).slice(1)
    parts = [t for b in huffman.text_slices(batch, "text", limit) for t in b["text"].to_pylist()]
    assert parts == [None, "", "x" * 50, "y"]
