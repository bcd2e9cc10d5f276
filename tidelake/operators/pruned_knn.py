"""Exact nearest vectors of which only the cells are scored that can hold one.

No vector of a cell is nearer to a query than the query's distance to the pivot less the cell's
radius. A query first visits its nearest cells, until they hold k vectors; the k-th best distance found
there then tells which other cells may hold a nearer one, and only those are visited.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.best_matches import (
    CELL_BYTES,
    CORPUS_ROWS,
    Best,
    arrow_type,
    rank_matches,
    row_slices,
)
from tidelake.operators.dense import CANDIDATES, matrix
from tidelake.session import shared_folder
from tidelake.sources.vector_cells import Cells, distances

# Room for the last digits of distances: a cell on the edge is visited.
ROOM = 1e-6
QUERY_BLOCK = 1024
# Pairs of a group of cells and a block of queries, of which each block costs a copy of the vectors,
# until CELL_BYTES to a block ask for more.
PAIRS = 24


def _chooser(known: Broadcast, k: int, first: bool,
             ) -> Callable[[pa.ChunkedArray | pa.Array, np.ndarray | None], np.ndarray]:
    """Which cells (columns) each of the vectors (rows) visits, in the first or the second round."""

    def choose(vectors: pa.ChunkedArray | pa.Array, reach: np.ndarray | None) -> np.ndarray:
        pivots, radius, rows = known.value
        near = distances(matrix(vectors), pivots)
        order = np.argsort(near, axis=1, kind="stable")
        held = np.cumsum(rows[order], axis=1) - rows[order]
        nearest = np.zeros(near.shape, bool)
        np.put_along_axis(nearest, order, held < k, axis=1)  # until the cells before hold k
        return nearest if first else (near - radius <= reach[:, None] + ROOM) & ~nearest

    return choose


def _parts(table: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch | pa.Table]:
    return (table.slice(at, QUERY_BLOCK) for at in range(0, table.num_rows, QUERY_BLOCK))


def _reach(part: pa.RecordBatch | pa.Table, first: bool) -> np.ndarray | None:
    return None if first else part.column("reach").to_numpy(zero_copy_only=False)


def _groups(rows: np.ndarray, row_bytes: int, corpus_rows: int) -> np.ndarray:
    """Consecutive cells as groups of about CELL_BYTES or corpus_rows, the larger; a group of each cell.

    A query travels once to every group it visits a cell of, however many cells that are.
    """
    wanted = max(CELL_BYTES // max(row_bytes, 1), corpus_rows)
    return ((np.cumsum(rows) - rows) // wanted).astype(np.int32)


def _visits(queries: DataFrame, choose: Callable, place: np.ndarray, first: bool) -> DataFrame:
    """The rows of ``queries`` (query_id, vector[, reach]) with ``place``, once for each place of a cell
    that the query visits."""
    shared = queries.sparkSession.sparkContext.broadcast(place)
    names = queries.columns

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        places, at = np.unique(place, return_inverse=True)
        edges = np.eye(len(places), dtype=np.float32)[at]
        for batch in batches:
            for part in _parts(batch):
                chosen = choose(part.column("vector"), _reach(part, first))
                query, to = np.nonzero(chosen.astype(np.float32) @ edges)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(pa.array(query)) for c in names]
                    + [pa.array(places[to].astype(np.int32))], [*names, "place"])

    return queries.mapInArrow(visits, T.StructType([
        *queries.schema.fields, T.StructField("place", T.IntegerType())]))


def _scored(vectors: DataFrame, queries: DataFrame, choose: Callable, cell: np.ndarray,
            rows: np.ndarray, row_bytes: int, k: int, corpus_rows: int, query_rows: int | None,
            first: bool) -> DataFrame:
    """query_id, id, dense_score: the k best of every cell for the queries that visit it.

    Groups of cells meet blocks of queries. A group of very many vectors, which is one cell, is cut by
    hash. Within a group only the pairs of a query and a cell that it visits are scored.
    """
    spark = vectors.sparkSession
    group = _groups(rows, row_bytes, corpus_rows)
    held = np.bincount(group, rows, len(group) and group.max() + 1)
    cuts = np.ceil(held / max(CELL_BYTES // max(row_bytes, 1), corpus_rows)).astype(int)
    # A row a cell, MOST_CELLS at most.
    known = F.broadcast(spark.createDataFrame(
        [(int(c), int(g), int(cuts[g])) for c, g in zip(cell, group, strict=True)],
        "cell int, place int, cuts int"))
    places = F.broadcast(known.select("place", "cuts").distinct())
    visiting = _visits(queries, choose, group, first)
    asked = queries.count()
    blocks = 1 + asked // query_rows if query_rows else max(
        1 + asked * row_bytes // CELL_BYTES,
        min(1 + asked // QUERY_BLOCK, -(-PAIRS // max(1, int(cuts.sum())))))
    left = vectors.join(known, "cell").select(
        "id", "embedding", "cell", "place", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int").alias(
            "cut"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = visiting.join(places, "place").withColumns({
        "cut": F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)),
        "block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")}).drop("cuts")
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", vectors.schema["id"].dataType), T.StructField("dense_score", T.DoubleType())])
    arrow = pa.schema([("query_id", arrow_type(queries, "query_id")), ("id", arrow_type(vectors, "id")),
                       ("dense_score", pa.float64())])
    shared = spark.sparkContext.broadcast(cell)
    pairs = ["place", "cut", "block"]

    def grid(corpus: pa.Table, asked: pa.Table) -> pa.Table:
        if not corpus.num_rows or not asked.num_rows:
            return arrow.empty_table()
        cell = shared.value
        corpus = corpus.sort_by("cell")
        found, starts = np.unique(corpus.column("cell").to_numpy(), return_index=True)
        ends = np.append(starts[1:], corpus.num_rows)
        ids, held = corpus.column("id").combine_chunks(), matrix(corpus.column("embedding"))
        done = []
        for part in _parts(asked):
            vectors, reach = part.column("vector"), _reach(part, first)
            chosen = choose(vectors, reach)[:, np.searchsorted(cell, found)]
            vectors = matrix(vectors)
            best = Best(k, len(vectors), None if first else 1 - (reach + ROOM) ** 2 / 2)
            for n in range(len(found)):
                mine = np.flatnonzero(chosen[:, n])
                block = vectors[mine].T
                for start, end in row_slices(ends[n] - starts[n], len(mine)):
                    at = starts[n] + start
                    best.add(ids.slice(at, end - start), held[at:starts[n] + end] @ block, -np.inf, mine)
            if best.ids is not None:
                query = part.column("query_id").take(pa.array(best.column))
                done.append(pa.table([query, best.ids, pa.array(best.score)], schema=arrow))
        return pa.concat_tables(done) if done else arrow.empty_table()

    return left.groupBy(*pairs).cogroup(right.groupBy(*pairs)).applyInArrow(grid, schema)


def pruned_knn(
    cells: Cells, queries: DataFrame, k: int = CANDIDATES, query_id: str = "query_id",
    embedding: str = "embedding", corpus_id: str = "chunk_id", corpus_rows: int = CORPUS_ROWS,
    query_rows: int | None = None, report: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """``(query_id, corpus_id, dense_score, rank)`` of the k nearest vectors, as `dense_knn`.

    Vectors have length one, so nearness is the dot product. How much is scored depends on how well the
    vectors lie in clusters; data without any is scored whole, for which `dense_knn` costs less.
    ``report`` is given every visit (query_id, cell). A visit costs no copy of the query: it travels to
    groups of cells, of which a table has as many as it has CELL_BYTES.
    """
    spark = queries.sparkSession
    folder = shared_folder(spark)

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    known = cells.cells.orderBy("cell").toArrow()  # MOST_CELLS rows at most
    pivots = matrix(known.column("pivot"))
    radius, rows, cell = (known.column(c).to_numpy() for c in ("radius", "rows", "cell"))
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(embedding).alias("vector"))
    row_bytes = 8 * pivots.shape[1] + 64
    sizes = (cell, rows, row_bytes, k, corpus_rows, query_rows)
    shared = spark.sparkContext.broadcast((pivots, radius, rows))
    nearest, within = _chooser(shared, k, True), _chooser(shared, k, False)
    found = kept(_scored(cells.vectors, asked, nearest, *sizes, True), "found")
    best = rank_matches(found, "dense_score", k, "query_id", "id")
    bars = best.where(F.col("rank") == k).select("query_id", F.sqrt(
        F.greatest(2 - 2 * F.col("dense_score"), F.lit(0.0))).alias("reach"))
    open_ = asked.join(bars, "query_id", "left").select(
        "query_id", "vector", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    open_ = kept(open_, "open")
    if report is not None:
        report(_visits(asked, nearest, cell, True).select("query_id", F.col("place").alias(
            "cell")).unionByName(_visits(open_, within, cell, False).select(
                "query_id", F.col("place").alias("cell"))))
    more = _scored(cells.vectors, open_, within, *sizes, False)
    ranked = rank_matches(found.unionByName(more), "dense_score", k, "query_id", "id")
    return ranked.select(F.col("query_id").alias(query_id), F.col("id").alias(corpus_id),
                         "dense_score", "rank")


def scored_share(cells: Cells, visits: DataFrame) -> float:
    """The share of query-vector pairs that visits score."""
    row = visits.join(F.broadcast(cells.cells.select("cell", "rows")), "cell").agg(
        F.sum("rows"), F.count_distinct("query_id")).first()
    total = cells.cells.agg(F.sum("rows")).first()[0]
    return (row[0] or 0) / (row[1] * total) if row[1] and total else 0.0
