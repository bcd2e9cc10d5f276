"""Connected components by alternating large-star and small-star steps.

Every step sends each node the smallest node it knows of. Only aggregates and joins on nodes are
used; edges never meet on the driver, and a node with very many neighbours is a skewed join key,
which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import stored
from tidelake.session import shared_folder


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    # In every edge a > b holds after a large-star step.
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    own = least.select("a", F.col("least").alias("b"))
    moved = edges.join(least, "a").where("b <> least").select(
        F.col("b").alias("a"), F.col("least").alias("b"))
    return own.union(moved)


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """node, component (its smallest node) for every node of the links' columns a and b.

    Links may repeat, run either way, or join a node to itself. Every round is written before the
    next begins, so a lost executor costs one round at most.
    """
    folder = folder or shared_folder(links.sparkSession)
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges-0", folder)
    before, turn = None, 0
    while (state := _state(edges)) != before:
        before, turn = state, turn + 1
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(),
                       f"edges-{turn}", folder)
    roots = edges.select(F.col("b").alias("node")).distinct()
    alone = links.where("a = b").select(F.col("a").alias("node"))
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = found.union(roots.select("node", F.col("node").alias("component")))
    return found.union(alone.distinct().join(found, "node", "left_anti").select(
        "node", F.col("node").alias("component")))
