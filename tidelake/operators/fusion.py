"""Fusion of ranked lists and reranking of the fused candidates."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import tokens
from tidelake.operators.best_matches import TIE_DECIMALS, rank_matches
from tidelake.operators.dense import CANDIDATES

# Fusion constant and number of final results.
RRF_CONSTANT = 60
RESULTS = 5
SCORES = ("dense_score", "lexical_score")

PairScorer = Callable[[pd.Series, pd.Series], pd.Series]


def rrf_fuse(lists: dict[str, DataFrame], constant: int = RRF_CONSTANT) -> DataFrame:
    """``fused_score``, the sum of ``1 / (constant + rank)`` over the lists that hold a chunk.

    Each list has ``(query_id, chunk_id, rank)`` and its score; both scores are kept.
    """
    if constant <= 0:
        raise ValueError("the fusion constant must be positive")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        frame.select("query_id", "chunk_id", "rank",
                     *[F.col(s) for s in SCORES if s in frame.columns])
        for frame in lists.values()])
    present = [s for s in SCORES if s in rows.columns]
    return rows.groupBy("query_id", "chunk_id").agg(
        F.sum(1.0 / (constant + F.col("rank"))).alias("fused_score"),
        *[F.coalesce(F.max(s), F.lit(0.0)).alias(s) for s in present])


def hybrid_fuse(
    dense: DataFrame, lexical: DataFrame, constant: int = RRF_CONSTANT, k: int = CANDIDATES,
) -> DataFrame:
    """The k best chunks of both lists fused, with their rank."""
    return rank_matches(
        rrf_fuse({"dense": dense, "lexical": lexical}, constant).withColumn(
            "fused_score", F.round("fused_score", TIE_DECIMALS)), "fused_score", k)


def term_share(query: Column, text: Column) -> Column:
    """Share of a query's distinct terms that occur in a text."""
    wanted = F.array_distinct(tokens(query))
    return F.when(F.size(wanted) > 0,
                  F.size(F.array_intersect(wanted, tokens(text))) / F.size(wanted)).otherwise(0.0)


def rerank(
    candidates: DataFrame, score_pairs: PairScorer | None = None, k: int = RESULTS,
) -> DataFrame:
    """The k best candidates per query by the score of (query, text) pairs.

    ``candidates`` carries ``query``, ``text`` and ``fused_score``. Without a scorer the score is
    the share of query terms found. Equal scores keep the fused order.
    """
    query, text = F.col("query"), F.col("text")
    score = (term_share(query, text) if score_pairs is None
             else F.pandas_udf(score_pairs, "double")(query, text))
    scored = candidates.withColumn("rerank_score", F.round(score, TIE_DECIMALS)).withColumn(
        "_order", F.struct("rerank_score", "fused_score"))
    return rank_matches(scored.drop("rank"), "_order", k).drop("_order")
