"""Packing pieces into sequences of fixed capacity by patterns of few lengths.

The work depends on the histogram of piece lengths alone, which has no more entries than a sequence
has tokens. Patterns of one to three lengths that fill a sequence exactly are fitted to the histogram
by non-negative least squares, rounded, and used as often as the pieces last; what is left over is
packed best fit first, on the histogram too. The result, a list of patterns and how often each is
used, is bounded as well; it goes to the tasks, where every piece finds its place by its length and
its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelake.llm.common import stored
from tidelake.llm.huffman import text_slices
from tidelake.llm.tokens import encoder
from tidelake.session import shared_folder

CAPACITY = 4096
GRID = 16  # of the middle length of three; the other two are any that fill the sequence
ROUNDS = 200
# Pieces that a worker remembers: it runs beside a heap that earlier stages have filled.
REMEMBERED = 200_000
SLICE_BYTES = 2 << 20  # of text that it encodes at once, for the same reason

Pattern = list[tuple[int, int]]  # length, how often


def cut_documents(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
                  with_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part, rank [, ids].

    A document is the ids of its whole text (null: none) and end_id; only one that is longer than a
    sequence is cut, at multiples of the capacity. part is the task, rank counts the pieces of a
    length within it.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
    names += ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # of what the worker did before
        coder, part, seen = encoder(path, REMEMBERED), TaskContext.get().partitionId(), np.zeros(
            capacity + 1, np.int64)
        for whole in batches:
            for batch in text_slices(whole, limit=SLICE_BYTES):
                ids, starts = coder.encode(batch.column("text"), end_id)
                size = np.diff(starts)
                many = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                length = np.minimum(capacity, size[row] - piece * capacity)
                begin = (starts[row] + piece * capacity) * 4
                raw = ids.tobytes()
                bodies = [raw[a:b] for a, b in zip(
                    begin.tolist(), (begin + length * 4).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                same = length[order]
                _, first, n = np.unique(same, return_index=True, return_counts=True)
                rank = np.empty(len(row), np.int64)
                rank[order] = np.arange(len(row)) - np.repeat(first, n) + seen[same]
                np.add.at(seen, length, 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity), pa.array(length),
                    pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                    pa.array(np.full(len(row), part, np.int32)), pa.array(rank),
                    *([pa.array(bodies, pa.binary())] * with_ids)], names)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
        + ", ids binary" * with_ids)


def full_patterns(lengths: np.ndarray, capacity: int, grid: int = GRID) -> np.ndarray:
    """Rows of up to three given lengths, the rest 0, that sum up to the capacity."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    a = lengths[lengths * 2 >= capacity]
    b = capacity - a
    two = np.stack([a, b, np.zeros_like(a)], axis=1)[have[b] | (b == 0)]
    middle = lengths[lengths % grid == 0]
    x, y = (g.ravel() for g in np.meshgrid(lengths, middle, indexing="ij"))
    z = capacity - x - y
    keep = (z >= 1) & (x >= y) & (y >= np.maximum(z, 1))
    # The smallest may also be the one on the grid.
    u = capacity - x - y
    other = (u >= y) & (x >= u)
    three = np.concatenate([np.stack([x, y, z], axis=1)[keep & have[np.clip(z, 0, capacity)]],
                            np.stack([x, u, y], axis=1)[other & have[np.clip(u, 0, capacity)]]])
    return np.unique(np.concatenate([two, three]), axis=0)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative x that brings the lengths used by patterns, x times each, near the histogram.

    Least squares by multiplicative steps, which keep x non-negative and never make the error grow.
    """
    size = len(histogram)
    used = (patterns > 0).astype(float)

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(patterns[:, k], x * used[:, k], size) for k in range(3))

    def back(h: np.ndarray) -> np.ndarray:
        return sum(h[patterns[:, k]] * used[:, k] for k in range(3))

    aim = back(histogram)
    x = aim / np.maximum(back(forward(np.ones(len(patterns)))), 1e-12)
    for _ in range(rounds):
        x = x * aim / np.maximum(back(forward(x)), 1e-12)
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[int, Pattern]]:
    """Pack a histogram, longest pieces first, each into the fullest open sequence it fits."""
    open_: list[list[tuple[int, Pattern]]] = [[] for _ in range(capacity + 1)]
    any_open = np.zeros(capacity + 1, bool)

    def put(room: int, many: int, pattern: Pattern) -> None:
        if many:
            open_[room].append((many, pattern))
            any_open[room] = True

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            room = length + int(np.argmax(any_open[length:]))
            if any_open[room]:
                many, pattern = open_[room].pop()
                any_open[room] = bool(open_[room])
            else:
                room, many, pattern = capacity, n, []
            each = room // length
            whole, rest = min(many, n // each), 0
            if whole < many:
                rest = min(n - whole * each, each - 1) if n - whole * each < each else 0
            put(room - each * length, whole, [*pattern, (length, each)])
            n -= whole * each
            if rest:
                put(room - rest * length, 1, [*pattern, (length, rest)])
                n -= rest
            if pattern:
                put(room, many - whole - bool(rest), pattern)
    return [group for groups in open_ for group in groups]


def solve(histogram: np.ndarray, capacity: int, grid: int = GRID) -> list[tuple[int, Pattern]]:
    """How often to use which pattern so that every piece of the histogram has a place."""
    left = histogram.copy()
    plan: list[tuple[int, Pattern]] = []
    lengths = np.flatnonzero(left)
    patterns = full_patterns(lengths, capacity, grid) if len(lengths) else np.empty((0, 3), int)
    if len(patterns):
        fitted = fit_counts(patterns, histogram.astype(float))
        for k in np.argsort(-fitted, kind="stable").tolist():
            used: dict[int, int] = {}
            for length in patterns[k].tolist():
                if length:
                    used[length] = used.get(length, 0) + 1
            many = min(int(np.ceil(fitted[k])), *(int(left[n]) // c for n, c in used.items()))
            if many:
                plan.append((many, sorted(used.items(), reverse=True)))
                for n, c in used.items():
                    left[n] -= many * c
    return plan + best_fit(left, capacity)


def places(plan: list[tuple[int, Pattern]]) -> dict[str, np.ndarray]:
    """Ranges of ranks by length, and the sequence and offset where each range starts."""
    rows, taken, sequence = [], {}, 0
    for many, pattern in plan:
        offset = 0
        for length, each in pattern:
            first = taken.get(length, 0)
            taken[length] = first + many * each
            rows.append((length, first, each, sequence, offset))
            offset += length * each
        sequence += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "sequence", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY, grid: int = GRID) -> DataFrame:
    """Adds sequence_id and offset to the stored pieces of `cut_documents`.

    A length that very many pieces share is numbered in parts: each task counts its own, and only
    the counts are summed over tasks. An empty table stays empty.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                           .alias("before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        histogram[row["length"]] = row["n"]
    shared = spark.sparkContext.broadcast(places(solve(histogram, capacity, grid)))
    kept = [f for f in pieces.columns if f not in ("part", "rank")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = shared.value
        # One key for (length, first): the ranks of a length stay far below 2**48.
        keys = (where["length"] << 48) + where["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            inner, each = rank - where["first"][at], where["each"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(where["sequence"][at] + inner // each),
                 pa.array(where["offset"][at] + inner % each * length)],
                [*kept, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields
                       if f.name in kept)
    return pieces.join(before, ["part", "length"]).mapInArrow(
        place, fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
                   with_ids: bool = False, folder: str | None = None, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Pieces of all documents with their place: see `cut_documents` and `pack`.

    Repeated rows are packed as often as they occur; other columns are not used.
    """
    folder = folder or shared_folder(docs.sparkSession)
    pieces = cut_documents(docs, path, end_id, capacity, with_ids, key, text)
    return pack(stored(pieces, "pieces", folder), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the ids of each sequence, from pieces packed with their ids.

    A sequence has at most `capacity` ids, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, b: F.concat(a, b["ids"]))
        .alias("ids"))
