from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.tables import documents, rows
from tests.llm.test_tokens import whole
from tidelake.llm import packing
from tidelake.llm.huffman import text_slices
from tidelake.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plan_places_every_piece_once_and_wastes_little(histogram):
    counts = np.zeros(65, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = packing.solve(counts, 64, grid=1)
    used, sequences = np.zeros(65, np.int64), 0
    for many, pattern in plan:
        assert sum(n * each for n, each in pattern) <= 64
        sequences += many
        for n, each in pattern:
            used[n] += many * each
    assert (used == counts).all()
    room = [0] * 0
    for length in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fit = [k for k, r in enumerate(room) if r >= length]
        if fit:
            room[min(fit, key=lambda k: room[k])] -= length
        else:
            room.append(64 - length)
    # Best fit decreasing on the pieces themselves is the yardstick.
    assert sequences <= max(len(room) * 1.1, len(room) + 1)


def check(found: list, capacity: int) -> None:
    texts = whole(PATH, [r[1] or "" for r in rows()])
    wanted = sorted((str(r[0]), tuple(i + [1])) for r, i in zip(rows(), texts, strict=True))
    pieces = sorted((str(r[0]), k, len(ids[k:k + capacity]),
                     zlib.crc32(np.array(ids[k:k + capacity], "<u4").tobytes()))
                    for r, ids in wanted_rows(wanted) for k in range(0, len(ids), capacity))
    assert sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"])
                  for r in found) == pieces
    assert all(r["piece"] * capacity == r["start"] for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1 + 1.05 * sum(r["length"] for r in found) / capacity


def wanted_rows(wanted: list) -> list:
    return [((key if key != "None" else None,), list(ids)) for key, ids in wanted]


def test_documents(spark):
    for capacity in (4096, 64):
        check(packing.pack_documents(documents(spark), PATH, 1, capacity).collect(), capacity)


def test_sequences_hold_the_ids(spark):
    packed = packing.pack_documents(documents(spark), PATH, 1, 512, with_ids=True)
    ids = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        own = ids[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])]
        assert bytes(own) == bytes(r["ids"])


def test_empty(spark):
    assert packing.pack_documents(documents(spark, empty=True), PATH, 1).collect() == []


def test_texts_are_encoded_two_megabytes_at_a_time():
    """Six workers took 487 MB more with slices of 8 MB, beside a full heap."""
    batch = pa.record_batch({"text": ["word " * 20_000] * 60})
    parts = list(text_slices(batch, limit=packing.SLICE_BYTES))
    assert sum(map(len, parts)) == 60
    assert max(len(part) for part in parts) * 100_000 <= 2 << 20
