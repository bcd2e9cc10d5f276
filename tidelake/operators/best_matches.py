"""Top-k of every query against every corpus row, by blocks.

Scores are computed in blocks inside tasks and cut to k per query before anything leaves a task, so
no query-row pair is ever written or shuffled. A small query table, by measurement, goes to the corpus
partitions, which stay where they are. A larger one meets the corpus in a grid: rows of both sides are
assigned to blocks by hash and each cell of the grid scores one block pair. Every block of one side
costs a copy of the other, so beyond SPARE_BYTES of copies blocks are as large as a task may hold.
Both ways are exact.

Rows are ranked by their scores in double precision. Only the last digits, in which the order of
summation shows, are cut (TIE_DECIMALS), so that copies of a row tie however their blocks were summed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidelake.sizing import measure

QUERY_ROWS = 8_192
QUERY_BYTES = 16 * 1024 * 1024
CORPUS_ROWS = 50_000
SCORE_CELLS = 4_000_000
CELL_BYTES = 64 * 1024 * 1024
SPARE_BYTES = 32 * 1024 * 1024
FOUND_BYTES = 128
TIE_DECIMALS = 12
CROWD = 16  # times k rows a query: so many of a slice may pass before the bar is raised

Prepared = list[tuple[np.ndarray, Any]]
Prepare = Callable[[pa.Table], Prepared]
"""Query table to blocks: positions of the block's queries, and what scoring needs."""

Score = Callable[[pa.Table, Any], Iterator[tuple[int, np.ndarray]]]
"""Corpus rows and one block to slices: first row, and scores of rows by queries."""


class Best:
    """The k best corpus rows so far for each query of one block; ties go to the smaller ID.

    ``bar`` is a query's k-th score so far. What is below it is left out by one comparison; only a
    slice of which more than a few rows a query pass, the first one above all, raises it beforehand.
    It may be given what is known of it beforehand.
    """

    def __init__(self, k: int, queries: int, bar: np.ndarray | None = None) -> None:
        self.k = k
        self._column = np.empty(0, np.int64)
        self._score = np.empty(0, np.float64)
        self._ids: pa.Array | None = None
        self._offered: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self._waiting = 0
        self.bar = np.full(queries, -np.inf) if bar is None else bar

    @property
    def column(self) -> np.ndarray:
        """Places of the queries that the rows belong to."""
        self._settle()
        return self._column

    @property
    def score(self) -> np.ndarray:
        self._settle()
        return self._score

    @property
    def ids(self) -> pa.Array | None:
        self._settle()
        return self._ids

    def add(self, ids: pa.Array, scores: np.ndarray, floor: float,
            queries: np.ndarray | None = None) -> None:
        """Offer a slice of scores, of shape ids by queries; only scores above ``floor`` count.

        Its columns are all queries of the block, or those at the places ``queries``.
        """
        if not scores.size:
            return
        known = self.bar if queries is None else self.bar[queries]
        least = np.maximum(before_rounding(known), np.nextafter(floor, np.inf))
        passed = scores >= least
        for rows in (len(scores) // 16, len(scores)):
            if rows > self.k and np.count_nonzero(passed) > CROWD * self.k * len(least):
                place = rows - self.k
                kth = np.partition(scores[:rows], place, axis=0)[place]
                least = np.fmax(least, before_rounding(kth))
                passed = scores >= least
        row, column = np.divmod(np.flatnonzero(passed), scores.shape[1])
        score = np.round(scores[row, column], TIE_DECIMALS)
        column = column if queries is None else queries[column]
        good = (score >= self.bar[column]) & (score > floor)
        if not good.any():
            return
        self._offered.append((column[good], score[good], ids.take(pa.array(row[good], pa.int64()))))
        self._waiting += len(column[good])
        if self._waiting >= len(self._column):  # so what is held is ordered for as many new rows
            self._settle()

    def _settle(self) -> None:
        """Cut to the k best what was offered so far."""
        if not self._offered:
            return
        columns, scores, ids = zip(*self._offered, strict=True)
        self._offered, self._waiting = [], 0
        column, score = np.concatenate([self._column, *columns]), np.concatenate([self._score, *scores])
        known = pa.concat_arrays([*ids] if self._ids is None else [self._ids, *ids])
        keep, last = self._first(column, score)
        bar = self.bar.copy()
        bar[column[last]] = score[last]
        keep = np.flatnonzero(score >= bar[column])
        if np.bincount(column[keep]).max() > self.k:  # scores equal to the k-th: by ID
            some = known.take(pa.array(keep)).to_numpy(zero_copy_only=False)
            rank = np.unique(some, return_inverse=True)[1]
            keep = keep[self._first(column[keep], score[keep], rank)[0]]
        self.bar, self._column, self._score = bar, column[keep], score[keep]
        self._ids = known.take(pa.array(keep))

    def _first(self, column: np.ndarray, score: np.ndarray, *ties: np.ndarray,
               ) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k best of each query, and of its k-th if it has so many."""
        order = np.lexsort((*ties, -score, column))
        place = np.arange(len(order)) - np.searchsorted(column[order], column[order], side="left")
        return order[place < self.k], order[place == self.k - 1]


def before_rounding(score: np.ndarray) -> np.ndarray:
    """What no score that rounds to at least this one is below."""
    return score - 10.0 ** -TIE_DECIMALS - 1e-15 * np.abs(score)


def scan(
    tables: Iterator[pa.Table], query_ids: pa.ChunkedArray, prepared: Prepared, score: Score,
    corpus_id: str, k: int, floor: float, schema: pa.Schema,
) -> pa.Table:
    """The best rows of all tables for each prepared query."""
    best = [Best(k, len(queries)) for queries, _ in prepared]
    for table in tables:
        ids = table.column(corpus_id).combine_chunks()
        for mine, (_, block) in zip(best, prepared, strict=True):
            for first, scores in score(table, block):
                mine.add(ids.slice(first, len(scores)), scores, floor)
    parts = [
        pa.table([query_ids.take(pa.array(queries[mine.column])), mine.ids, pa.array(mine.score)],
                 schema=schema)
        for mine, (queries, _) in zip(best, prepared, strict=True) if mine.ids is not None]
    return pa.concat_tables(parts) if parts else schema.empty_table()


def top_matches(
    corpus: DataFrame,
    queries: DataFrame,
    prepare: Prepare,
    score: Score,
    k: int,
    corpus_id: str = "chunk_id",
    query_id: str = "query_id",
    score_name: str = "score",
    floor: float = -np.inf,
    sized_by: DataFrame | None = None,
    row_bytes: int = 0,
    query_rows: int = QUERY_ROWS,
    corpus_rows: int = CORPUS_ROWS,
) -> DataFrame:
    """``(query_id, corpus_id, score, rank)`` of the k best rows per query.

    ``sized_by`` is measured first, in place of ``queries``, where that costs less; ``row_bytes`` is
    what a query has besides. Nothing is collected before that fits; what is broadcast is measured
    itself. ``query_rows`` and ``corpus_rows`` are wanted block sizes of the grid (``grid_shape``).
    """
    schema = T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(corpus_id, corpus.schema[corpus_id].dataType),
        T.StructField(score_name, T.DoubleType()),
    ])
    arrow = pa.schema([
        (query_id, arrow_type(queries, query_id)), (corpus_id, arrow_type(corpus, corpus_id)),
        (score_name, pa.float64())])
    rows, size = measure(queries if sized_by is None else sized_by)
    size += rows * row_bytes
    held = queries.toArrow() if rows <= query_rows and size <= QUERY_BYTES else None
    if held is not None and held.nbytes <= QUERY_BYTES:
        # The table as it is goes out; each task makes its blocks.
        shared = corpus.sparkSession.sparkContext.broadcast(held)

        def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = (pa.Table.from_batches([b]) for b in batches)
            mine = shared.value
            yield from scan(tables, mine.column(query_id), prepare(mine), score, corpus_id, k,
                             floor, arrow).to_batches()

        found = corpus.mapInArrow(scan_all, schema)
    else:
        size = max(size, held.nbytes if held is not None else 0)
        def cell(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return arrow.empty_table()
            return scan(iter([left]), right.column(query_id), prepare(right), score, corpus_id,
                         k, floor, arrow)

        held_rows, held_bytes = measure(corpus)
        across, down = grid_shape(held_rows, held_bytes, corpus_rows, rows, size, query_rows, k)
        left = _in_grid(corpus, corpus_id, across, "_a", down, "_d")
        right = _in_grid(queries, query_id, down, "_d", across, "_a")
        found = left.groupBy("_a", "_d").cogroup(right.groupBy("_a", "_d")).applyInArrow(
            cell, schema)
    return rank_matches(found, score_name, k, query_id, corpus_id)


def grid_shape(corpus: int, corpus_bytes: int, corpus_rows: int, queries: int, query_bytes: int,
               query_rows: int, k: int) -> tuple[int, int]:
    """Blocks of the corpus and of the queries.

    As many as the wanted rows ask for while what they copy stays within SPARE_BYTES: a block of
    queries costs a copy of the corpus, a block of the corpus one of the queries and k found rows for
    each of them. Beyond that only as many as CELL_BYTES to a block ask for.
    """

    def blocks(rows: int, wanted: int, size: int, copied: int) -> int:
        most = max(1 + size // CELL_BYTES, SPARE_BYTES // max(copied, 1))
        return min(max(1 + rows // wanted, 1 + size // CELL_BYTES), most)

    found = queries * k * FOUND_BYTES
    return (blocks(corpus, corpus_rows, corpus_bytes, query_bytes + found),
            blocks(queries, query_rows, query_bytes, corpus_bytes))


def arrow_type(frame: DataFrame, column: str) -> pa.DataType:
    return pa.int64() if isinstance(frame.schema[column].dataType, T.LongType) else pa.string()


def _in_grid(frame: DataFrame, key: str, blocks: int, own: str, copies: int, other: str,
             ) -> DataFrame:
    """Rows assigned to one of ``blocks`` and copied to each block of the other side."""
    return frame.withColumn(own, F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def rank_matches(
    found: DataFrame, score: str, k: int, query_id: str = "query_id", corpus_id: str = "chunk_id",
    partition: Sequence[str] = (),
) -> DataFrame:
    """The k best rows per query with their 1-based rank; ties go to the smaller ID."""
    order = Window.partitionBy(query_id, *partition).orderBy(F.col(score).desc(), F.col(corpus_id))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def row_slices(rows: int, width: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose score block stays within a fixed number of cells."""
    step = max(1, SCORE_CELLS // max(1, width))
    return ((start, min(start + step, rows)) for start in range(0, rows, step))
