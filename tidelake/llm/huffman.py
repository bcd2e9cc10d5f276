"""Token ids as Huffman-coded files: one code for the whole table, decoded block by block.

File format. A folder with two Parquet tables, written and committed by Spark.

* ``code``: symbol, bits, a row per id that occurs. The code is canonical: symbols in order of
  (bits, symbol) get consecutive code words, so the lengths say everything.
* ``blocks``: shard, block, doc_ids, n_tokens, first, offsets, payload. Shards follow each other in
  ascending order of document keys, blocks follow each other in a shard, documents in a block. A
  block holds whole documents and needs no other block. ``first`` counts the ids of the shard before
  the block. ``offsets`` are bit positions in the payload, one for every STRIDE ids of a document
  from its first on: a reader can start at any of them, and this one decodes all of them abreast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import stored
from tidelake.llm.tokens import encoder
from tidelake.session import shared_folder

STRIDE = 256
BLOCK_TOKENS = 1 << 16
LONGEST_CODE = 18
SLICE_BYTES = 8 << 20


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about `limit` bytes; a longer text is alone."""
    width = np.asarray(batch.column(column).cast(pa.large_binary()).fill_null(b"").buffers()[1])
    ends = width.view(np.int64)[1:len(batch) + 1] if len(batch) else np.zeros(0, np.int64)
    start = 0
    while start < len(batch):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def token_ids(docs: DataFrame, path: str, end_id: int, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """doc_id, ids: ids of each whole text and then end_id, as little-endian 32-bit integers.

    A null text is an empty one. Texts go through Python a few megabytes at a time.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, starts = coder.encode(part.column("text"), end_id)
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(part),
                    [None, pa.py_buffer(starts * 4), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), raw.cast(pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids binary")


def symbol_counts(tokens: DataFrame) -> DataFrame:
    """symbol, n: how often each id occurs; every task adds up its own ids first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u4")
            found = np.bincount(ids, minlength=len(total))
            found[:len(total)] += total
            total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["symbol", "n"])

    each = tokens.select("ids").mapInArrow(count, "symbol long, n long")
    return each.groupBy("symbol").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Bits per symbol of the best prefix code with no word over `longest` bits (package merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    longest = max(longest, math.ceil(math.log2(n)))
    order = np.argsort(counts, kind="stable")
    items = counts[order].astype(np.float64)
    single: list[np.ndarray] = []
    level = items
    single.append(np.ones(n, bool))
    for _ in range(longest - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([items, pairs])
        at = np.argsort(both, kind="stable")
        level = both[at]
        single.append(at < n)
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for mark in reversed(single):
        own = int(mark[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


class Code:
    """A canonical code: words for writing, one table over the longest word for reading."""

    def __init__(self, symbols: np.ndarray, bits: np.ndarray) -> None:
        order = np.lexsort((symbols, bits))
        symbols, bits = symbols[order], bits[order]
        self.longest = int(bits.max()) if len(bits) else 1
        slots = np.left_shift(1, self.longest - bits)  # table entries that begin with the word
        first = np.cumsum(slots) - slots
        size = int(symbols.max()) + 1 if len(symbols) else 1
        self.bits, self.words = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.bits[symbols], self.words[symbols] = bits, first >> (self.longest - bits)
        self.symbol_at = np.zeros(1 << self.longest, np.uint32)
        self.bits_at = np.ones(1 << self.longest, np.uint8)
        filled = int(slots.sum())
        self.symbol_at[:filled] = np.repeat(symbols, slots)
        self.bits_at[:filled] = np.repeat(bits, slots)

    def write(self, ids: np.ndarray, starts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bits of all documents, each from a byte boundary on; byte bounds; bit offset per id."""
        width = self.bits[ids]
        before = np.append(0, np.cumsum(width))
        size = (before[starts[1:]] - before[starts[:-1]] + 7) >> 3
        bounds = np.append(0, np.cumsum(size))
        shift = bounds[:-1] * 8 - before[starts[:-1]]
        at = before[:-1] + np.repeat(shift, np.diff(starts))
        cell, room = at >> 5, 64 - (at & 31) - width
        word = self.words[ids] << room  # the word within the 64 bits from its cell on
        cells = int(bounds[-1] // 4 + 2)
        # Words do not overlap, so adding is joining; sums stay below 2**32 and are exact.
        bits = np.bincount(cell, (word >> 32) & 0xFFFFFFFF, cells)
        bits += np.bincount(cell + 1, word & 0xFFFFFFFF, cells)
        return bits.astype(np.uint32).astype(">u4").tobytes(), bounds, at

    def read(self, payload: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Ids of segments that start at bits `at`, one after the other, all decoded abreast."""
        padded = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
        window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        order = np.argsort(-length, kind="stable")
        put, at = (np.cumsum(length) - length)[order], at[order].copy()
        active = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), "left")
        out, back = np.empty(int(length.sum()), np.uint32), 32 - self.longest
        for step, n in enumerate(active.tolist()):
            here = at[:n]
            entry = (window[here >> 3] << (here & 7).astype(np.uint32)) >> np.uint32(back)
            out[put[:n] + step] = self.symbol_at[entry]
            here += self.bits_at[entry]
        return out


def _offsets(starts: np.ndarray) -> np.ndarray:
    """Positions of the first and then every STRIDE-th id of each document."""
    lengths = np.diff(starts)
    marks = -(-lengths // STRIDE)
    first = np.repeat(starts[:-1], marks)
    inner = np.arange(len(first)) - np.repeat(np.cumsum(marks) - marks, marks)
    return first + inner * STRIDE


def write_ids(tokens: DataFrame, folder: str, block_tokens: int = BLOCK_TOKENS,
              longest: int = LONGEST_CODE) -> None:
    """Write doc_id, ids in the file format, in ascending order of doc_id, nulls first.

    The counts of all ids come to the driver: no more rows than the vocabulary has. Documents are
    coded before they move, so only coded bits are shuffled. Equal keys are ordered by a hash of
    their bits, which also lets a key that many rows share spread over shards.
    """
    spark = tokens.sparkSession
    counts = symbol_counts(tokens).orderBy("symbol").collect()
    symbols = np.array([r["symbol"] for r in counts], np.int64)
    bits = code_lengths(np.array([r["n"] for r in counts], np.int64), longest)
    spark.createDataFrame(list(zip(symbols.tolist(), bits.tolist(), strict=True)),
                          "symbol long, bits int").coalesce(1).write.parquet(f"{folder}/code")
    shared = spark.sparkContext.broadcast((symbols, bits))  # vocabulary-sized

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Code(*shared.value)
        for whole in batches:
            for batch in text_slices(whole, "ids"):
                raw = batch.column("ids").to_pylist()
                ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
                n = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
                starts = np.append(0, np.cumsum(n))
                out, bounds, at = coder.write(ids, starts)
                marks = _offsets(starts)
                own = at[marks] - np.repeat(bounds[:-1] * 8, -(-n // STRIDE))
                edges = np.append(0, np.cumsum(-(-n // STRIDE)))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(n),
                    pa.array([own[a:b].astype("<i8").tobytes()
                              for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
                    pa.array([out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                             pa.binary())], ["doc_id", "n", "marks", "bits"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, held, size = 0, 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                size += row["n"]
                if size >= block_tokens:
                    yield block(number, first, held)
                    number, first, held, size = number + 1, first + size, [], 0
        if held:
            yield block(number, first, held)

    def block(number: int, first: int, held: list[dict]) -> pa.RecordBatch:
        base = np.cumsum([0, *(len(r["bits"]) for r in held)]) * 8
        marks = np.concatenate([np.frombuffer(r["marks"], "<i8") + b
                                for r, b in zip(held, base, strict=False)])
        return pa.RecordBatch.from_pylist([{
            "block": number, "first": first, "doc_ids": [r["doc_id"] for r in held],
            "n_tokens": [r["n"] for r in held], "offsets": marks.tolist(),
            "payload": b"".join(r["bits"] for r in held)}], schema=pa.schema([
                ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                ("payload", pa.binary())]))

    # Stored, because finding the range bounds reads the rows once more.
    coded = stored(tokens.mapInArrow(
        code, "doc_id long, n long, marks binary, bits binary").withColumn(
        "tie", F.xxhash64("bits")), "coded", folder)
    ordered = coded.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.drop("tie").mapInArrow(
        blocks, "block int, first long, doc_ids array<long>, n_tokens array<long>, "
        "offsets array<long>, payload binary").withColumn(
        "shard", F.spark_partition_id()).write.option("compression", "zstd").parquet(
        f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (as `token_ids` gives them) of files in the format above.

    `start` counts the ids of all documents before. Sizes of shards come to the driver, one row
    per written partition. Every block is decoded by itself, wherever it lands.
    """
    table = spark.read.parquet(f"{folder}/blocks")
    rows = spark.read.parquet(f"{folder}/code").orderBy("symbol").collect()
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)
    shards = table.groupBy("shard").agg(F.sum(size).alias("n")).orderBy("shard").collect()
    begins, total = {}, 0
    for row in shards:
        begins[row["shard"]], total = total, total + row["n"]
    shared = spark.sparkContext.broadcast((
        np.array([r["symbol"] for r in rows], np.int64),
        np.array([r["bits"] for r in rows], np.int64), begins))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, bits, before = shared.value
        coder = Code(symbols, bits)
        for batch in batches:
            for n in range(0, len(batch), 8):
                part = batch.slice(n, 8)
                lengths = part.column("n_tokens").flatten().to_numpy()
                raw = part.column("payload").to_pylist()
                base = np.cumsum([0, *map(len, raw)])[:-1] * 8
                marks = part.column("offsets")
                at = marks.flatten().to_numpy() + np.repeat(
                    base, [len(m) for m in marks])
                pieces = -(-lengths // STRIDE)
                cut = np.full(len(at), STRIDE, np.int64)
                last = np.cumsum(pieces) - 1
                cut[last] = lengths - (pieces - 1) * STRIDE
                ids = coder.read(np.frombuffer(b"".join(raw), np.uint8), at, cut)
                bounds = np.append(0, np.cumsum(lengths))
                docs = [len(d) for d in part.column("doc_ids")]
                edge = np.cumsum([0, *docs])[:-1]
                begin = np.array([before[s] for s in part.column("shard").to_pylist()])
                begin = begin + part.column("first").to_numpy() - bounds[edge]
                raw_ids = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_ids").flatten(), pa.array(bounds[:-1] + np.repeat(begin, docs)),
                    pa.array(lengths),
                    pa.array([raw_ids[4 * a:4 * b] for a, b in
                              zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)],
                             pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return table.select("shard", "first", "doc_ids", "n_tokens", "offsets", "payload").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary")


def encode_corpus(docs: DataFrame, path: str, end_id: int, folder: str | None = None,
                  key: str = "doc_id", text: str = "text") -> str:
    """Tokenize a table, write its ids in the file format, and return the folder.

    Null texts count as empty and have the end id alone; repeated rows are written as often as they
    occur; an empty table gives files without rows. Columns other than key and text stay out of it.
    """
    folder = folder or shared_folder(docs.sparkSession)
    write_ids(stored(token_ids(docs, path, end_id, key, text), "tokens", folder), folder)
    return folder

