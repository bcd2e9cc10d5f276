"""Vectors on storage by their nearest pivot, with the radius of every cell around its pivot."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.dense import matrix

# Pivots travel to every task: this many vectors at most.
MOST_CELLS = 1024


@dataclass(frozen=True)
class Cells:
    """``vectors``: id, embedding, cell. ``cells``: cell, pivot, rows, radius."""

    vectors: DataFrame
    cells: DataFrame


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to pivots, never negative under the root."""
    squares = (vectors ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def write_cells(
    vectors: DataFrame, root: str, corpus_id: str = "chunk_id", embedding: str = "embedding",
    cells: int | None = None,
) -> None:
    """Store vectors (read twice: store them first), all of one length and none null.

    Pivots are the vectors with the smallest hashes of their IDs, as many as the square root of their
    number, MOST_CELLS at most. Files hold ranges of cells; a cell that holds very many is cut.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(corpus_id).alias("id"), F.col(embedding).alias("embedding"))
    wanted = cells or int(rows.count() ** 0.5) + 1
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(min(wanted, MOST_CELLS)).select(
        "embedding").toArrow()
    pivots = np.unique(matrix(drawn.column("embedding")), axis=0)
    shared = spark.sparkContext.broadcast(pivots)

    @F.arrow_udf("struct<cell:int,distance:double>")
    def placed(batch: pa.Array) -> pa.Array:
        found = distances(matrix(batch), shared.value)
        cell = found.argmin(axis=1) if len(found) else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(found[np.arange(len(cell)), cell], pa.float64())],
            ["cell", "distance"])

    rows.withColumn("p", placed("embedding")).select("id", "embedding", "p.*").repartitionByRange(
        "cell", F.xxhash64("id")).sortWithinPartitions("cell").write.mode("overwrite").parquet(
        f"{root}/vectors")
    known = spark.createDataFrame(
        [(n, [float(x) for x in p]) for n, p in enumerate(pivots)], "cell int, pivot array<double>")
    spark.read.schema("cell int, distance double").parquet(f"{root}/vectors").groupBy("cell").agg(
        F.count("*").alias("rows"), F.max("distance").alias("radius")).join(
        F.broadcast(known), "cell").coalesce(1).write.mode("overwrite").parquet(f"{root}/cells")


def read_cells(spark: SparkSession, root: str) -> Cells:
    return Cells(*[spark.read.parquet(f"{root}/{part}") for part in ("vectors", "cells")])
