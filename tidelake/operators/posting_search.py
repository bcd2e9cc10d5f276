"""BM25 search that uses the blocks of postings that can matter. Exact.

A first look at the best block of every query term gives each query a score that its k-th result
reaches. Terms whose greatest contributions together stay below it find no chunk by themselves. Of the
other terms a block is used if a chunk in it could reach that score were all its other terms at their
greatest; the chunks found there that may still reach it are then looked up, block by block, under the
remaining terms. What is skipped can't be among the k best. No pair of a query and a chunk is a row
before it is among the k best of its shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.best_matches import (
    TIE_DECIMALS,
    arrow_type,
    before_rounding,
    rank_matches,
)
from tidelake.operators.dense import CANDIDATES
from tidelake.operators.lexical import BOOST, query_terms
from tidelake.operators.term_index import FIELDS
from tidelake.session import shared_folder
from tidelake.sizing import broadcast_if_small, measure
from tidelake.sources.postings_table import Postings, blocks_of

# So many distinct query terms, by measurement, are named to the file reader, which then skips files
# and row groups without them.
NAMED_TERMS = 10_000
NAMED_BYTES = 1 << 20
# Bounds are compared with this much room for the last digits of sums.
ROOM = 1e-9
_KEY = ["field", "term"]
_TERM = ["query_id", "field"]
_PIECE = ["part", *_KEY, "block", "groups", "greatest"]
_PIECE_TYPES = "part int, field string, term string, block int, groups long, greatest double"
# A shard has about so many chunks, or entries of the asked terms, whichever makes more shards.
SHARD_CHUNKS = 1 << 14
SHARD_ENTRIES = 1 << 20
# Queries that meet a copy of the blocks they ask for.
QUERY_ROWS = 1024


def _kept(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """A small result written and read back: what follows measures it, and reads it several times."""
    frame.write.parquet(f"{folder}/{name}")
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/{name}")


def _named(postings: Postings, asked: DataFrame) -> Postings:
    """The postings of the asked terms, as far as file statistics tell."""
    distinct = asked.select("term").distinct()
    rows, size = measure(distinct)
    if rows > NAMED_TERMS or size > NAMED_BYTES:
        return postings
    names = [r["term"] for r in distinct.collect()]
    return replace(postings, **{f: getattr(postings, f).where(F.col("term").isin(names))
                                for f in ("blocks", "terms")})


def weighted(postings: Postings, asked: DataFrame) -> DataFrame:
    """query_id, field, term, groups, weight, most: a term's weight and its greatest contribution."""
    chunks = {r["field"]: r["chunks"] for r in postings.stats.collect()}  # a row per field
    number, boost = (F.create_map(*[x for f in FIELDS for x in (F.lit(f), F.lit(v[f]))])[
        F.col("field")] for v in ({f: float(chunks.get(f, 0)) for f in FIELDS}, BOOST))
    df = F.col("document_frequency")
    idf = F.log(1 + (number - df + 0.5) / (df + 0.5))
    return postings.terms.join(broadcast_if_small(asked), "term").select(
        "query_id", *_KEY, "groups", (boost * F.col("tf") * idf).alias("weight"),
        (boost * F.col("tf") * idf * F.col("greatest")).alias("most"))


def _seeded(blocks: DataFrame, terms: DataFrame, folder: str) -> DataFrame:
    """query_id, field, number, score by the best block of every query term alone."""
    best = blocks.select(*_KEY, "block", "greatest").join(
        broadcast_if_small(terms.select(*_KEY).distinct()), _KEY).groupBy(*_KEY).agg(
        F.min_by("block", F.struct(-F.col("greatest"), "block")).alias("block"))
    wanted = _kept(terms.join(best, _KEY).select("query_id", *_KEY, "block", "weight"), folder, "seeds")
    return blocks.join(broadcast_if_small(wanted), [*_KEY, "block"]).select(
        "query_id", "field", "weight", F.explode(F.arrays_zip("ids", "impacts")).alias("e")).groupBy(
        "query_id", "field", F.col("e.ids").alias("number")).agg(
        F.sum(F.col("weight") * F.col("e.impacts")).alias("score"))


def plan_terms(postings: Postings, terms: DataFrame, k: int, folder: str) -> DataFrame:
    """Terms with ``bar`` (what the k-th result of the query reaches at least), ``essential`` and
    ``spare`` (the most that the other terms add)."""
    seen = _seeded(postings.blocks, terms, folder).groupBy("query_id", "number").agg(
        F.max("score").alias("score"))
    bars = _kept(rank_matches(seen, "score", k, "query_id", "number").where(
        F.col("rank") == k).select("query_id", (F.col("score") * (1 - ROOM)).alias("bar")),
        folder, "bars")
    total = Window.partitionBy(*_TERM)
    weakest = total.orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    rated = terms.join(broadcast_if_small(bars), "query_id", "left").withColumns({
        "bar": F.coalesce("bar", F.lit(0.0)),
        "spare": F.sum("most").over(total) - F.col("most"),
        "so_far": F.sum("most").over(weakest)})
    return _kept(rated.withColumn("essential", F.col("so_far") >= F.col("bar")), folder, "rated")


def _split(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks as pieces (``shard`` first) that each lie in one shard; most lie in one as they are."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            sizes = np.diff(ids.offsets.to_numpy())
            flat, impacts = ids.flatten(), batch.column("impacts").flatten()
            place = np.repeat(np.arange(len(sizes)), sizes) * shards + blocks_of(flat.to_numpy(), shards)
            order = np.argsort(place, kind="stable")
            found, starts = np.unique(place[order], return_index=True)
            edges = pa.array(np.append(starts, len(place)).astype(np.int32))
            rows = pa.array(found // shards)
            lists = [pa.ListArray.from_arrays(edges, c.take(pa.array(order))) for c in (flat, impacts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array((found % shards).astype(np.int32)),
                 *[batch.column(c).take(rows) for c in _PIECE], *lists],
                ["shard", *_PIECE, "ids", "impacts"])

    return split


class _Shard:
    """The postings of one shard: entries of a term lie together, those of a block as well."""

    def __init__(self, pieces: pa.Table) -> None:
        pieces = pieces.sort_by([(c, "ascending") for c in (*_KEY, "block")]).combine_chunks()
        ids, impacts = (pieces.column(c).combine_chunks() for c in ("ids", "impacts"))
        self.numbers, self.at = np.unique(ids.flatten().to_numpy(), return_inverse=True)
        self.impact = impacts.flatten().to_numpy()
        self.sizes = np.diff(ids.offsets.to_numpy())
        self.edges = np.append(0, np.cumsum(self.sizes))
        self.block, self.greatest = (pieces.column(c).to_numpy() for c in ("block", "greatest"))
        names = list(zip(*(pieces.column(c).to_pylist() for c in _KEY), strict=True))
        starts = [n for n, name in enumerate(names) if not n or name != names[n - 1]]
        self.terms = {names[a]: (a, b) for a, b in zip(starts, [*starts[1:], len(names)], strict=True)}
        self.groups = pieces.column("groups").to_numpy()
        self.used = np.zeros(len(names), bool)

    def add(self, score: np.ndarray, weight: float, first: int, wanted: np.ndarray,
            among: np.ndarray | None = None) -> None:
        """A term's contributions from the wanted ones of its blocks, ``among`` the marked chunks."""
        self.used[first:first + len(wanted)] |= wanted
        part = slice(self.edges[first], self.edges[first + len(wanted)])
        at, impact = self.at[part], self.impact[part]
        if not wanted.all() or among is not None:
            take = np.repeat(wanted, self.sizes[first:first + len(wanted)])
            take = take if among is None else take & among[at]
            at, impact = at[take], impact[take]
        score[at] += weight * impact  # a chunk is in a term's entries once

    def field_scores(self, terms: list[dict], bar: float) -> np.ndarray:
        """What the chunks that may reach the bar score in a field; 0 for all others."""
        score = np.zeros(len(self.numbers))
        held = [(t, *self.terms[t["field"], t["term"]]) for t in terms
                if (t["field"], t["term"]) in self.terms]
        for t, a, b in held:
            if t["essential"]:
                self.add(score, t["weight"], a, t["weight"] * self.greatest[a:b] + t["spare"] >= bar)
        slack = sum(t["most"] for t in terms if not t["essential"])
        open_ = (score > 0) & (score + slack >= bar)
        score[~open_] = 0
        if slack and open_.any():
            numbers = self.numbers[open_]
            for t, a, b in held:
                if not t["essential"]:
                    needed = np.isin(self.block[a:b], blocks_of(numbers, int(self.groups[a])))
                    self.add(score, t["weight"], a, needed, open_)
        return score

    def best(self, terms: list[dict], bar: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the k best chunks of a query and of those that tie with the last."""
        score = np.zeros(len(self.numbers))
        for field in FIELDS:
            mine = [t for t in terms if t["field"] == field]
            if mine:
                np.maximum(score, self.field_scores(mine, bar), out=score)
        least = np.partition(score, len(score) - k)[len(score) - k] if k < len(score) else 0.0
        good = np.flatnonzero((score > 0) & (score >= before_rounding(least)))
        return self.numbers[good], score[good]


def _by_shard(postings: Postings, rated: DataFrame, pairs: Callable[[pa.Table, pa.Table], pa.Table],
              schema: str) -> DataFrame:
    """``pairs`` of the blocks in a shard that some query of a part may need, and of those queries.

    Chunks are dealt to shards by the hash that gives their block, so what a chunk scores is added up
    in one place. Blocks of terms that are essential to all their queries are left out if they can't
    matter to any; of the others a shard uses those that its chunks need.
    """
    known = rated.agg(F.count_distinct("query_id").alias("queries")).first()["queries"]
    parts = F.lit(1 + known // QUERY_ROWS)
    rated = rated.withColumn("part", F.pmod(F.xxhash64("query_id"), parts).cast("int"))
    entries = postings.terms.join(broadcast_if_small(rated.select(*_KEY).distinct()), _KEY).agg(
        F.coalesce(F.sum("document_frequency"), F.lit(0)).alias("n")).first()["n"]
    shards = 1
    while shards < max(postings.chunks.count() // SHARD_CHUNKS, entries // SHARD_ENTRIES):
        shards *= 2
    enough = (F.col("bar") - F.col("spare")) / F.col("weight") - ROOM
    wanted = rated.groupBy(*_KEY, "groups", "part").agg(
        F.min(F.when(F.col("essential"), enough).otherwise(0.0)).alias("enough"))
    pieces = postings.blocks.join(broadcast_if_small(wanted), _KEY).where("greatest >= enough").select(
        *_PIECE, "ids", "impacts").mapInArrow(_split(shards), f"shard int, {_PIECE_TYPES}, "
                                              "ids array<long>, impacts array<double>")
    asked = rated.groupBy("part", "query_id").agg(F.max("bar").alias("bar"), F.collect_list(F.struct(
        *_KEY, "weight", "most", "spare", "essential")).alias("terms")).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "*")
    by = ["shard", "part"]
    return pieces.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(pairs, schema)


def _planned(postings: Postings, queries: DataFrame, k: int, query: str, query_id: str,
             ) -> tuple[Postings, DataFrame]:
    folder = shared_folder(queries.sparkSession)
    asked = _kept(query_terms(queries, query, query_id).withColumnRenamed(query_id, "query_id"),
                  folder, "asked")
    postings = _named(postings, asked)
    terms = _kept(weighted(postings, asked), folder, "terms")
    return postings, plan_terms(postings, terms, k, folder)


def posting_search(
    postings: Postings, queries: DataFrame, k: int = CANDIDATES, query: str = "query",
    query_id: str = "query_id",
) -> DataFrame:
    """``(query_id, chunk_id, lexical_score, rank)`` of the k best chunks per query, as `bm25_search`.

    Work grows with the postings of the asked terms that can matter, not with the index. Scores are
    added up in arrays, a shard of the chunks at a time; k of each query leave it.
    """
    postings, rated = _planned(postings, queries, k, query, query_id)
    arrow = pa.schema([("query_id", arrow_type(rated, "query_id")), ("number", pa.int64()),
                       ("score", pa.float64())])

    def searched(pieces: pa.Table, asked: pa.Table) -> pa.Table:
        if not pieces.num_rows or not asked.num_rows:
            return arrow.empty_table()
        shard, found = _Shard(pieces), []
        for q in _rows(asked):
            numbers, score = shard.best(q["terms"], q["bar"], k)
            found.append(pa.table([pa.repeat(pa.scalar(q["query_id"], arrow.types[0]), len(numbers)),
                                   pa.array(numbers), pa.array(score)], schema=arrow))
        return pa.concat_tables(found)

    kind = rated.schema["query_id"].dataType.simpleString()
    scores = _by_shard(postings, rated, searched, f"query_id {kind}, number long, score double").select(
        "query_id", "number", F.round("score", TIE_DECIMALS).alias("lexical_score"))
    # Ties go to the smaller chunk ID: all that tie with the k-th best get theirs.
    order = Window.partitionBy("query_id").orderBy(F.col("lexical_score").desc())
    best = scores.where("lexical_score > 0").withColumn("place", F.rank().over(order)).where(
        F.col("place") <= k).drop("place")
    best = _kept(best, shared_folder(queries.sparkSession), "best")
    named = postings.chunks.join(broadcast_if_small(best), "number").select(
        "query_id", "chunk_id", "lexical_score")
    return rank_matches(named, "lexical_score", k, "query_id", "chunk_id").withColumnRenamed(
        "query_id", query_id)


def _rows(asked: pa.Table) -> Iterator[dict]:
    """The queries one by one: their terms as Python objects, of as many as a batch has at a time."""
    for batch in asked.to_batches():
        yield from batch.to_pylist()


def block_report(
    postings: Postings, queries: DataFrame, k: int = CANDIDATES, query: str = "query",
    query_id: str = "query_id",
) -> DataFrame:
    """One row: distinct blocks of the asked terms, and how many of them a search uses and skips."""
    postings, rated = _planned(postings, queries, k, query, query_id)
    arrow = pa.schema([("field", pa.string()), ("term", pa.string()), ("block", pa.int32())])

    def used(pieces: pa.Table, asked: pa.Table) -> pa.Table:
        if not pieces.num_rows or not asked.num_rows:
            return arrow.empty_table()
        shard = _Shard(pieces)
        for q in _rows(asked):
            shard.best(q["terms"], q["bar"], k)
        ordered = pieces.sort_by([(c, "ascending") for c in arrow.names]).select(arrow.names)
        return ordered.filter(pa.array(shard.used)).cast(arrow)

    every = postings.blocks.select(*_KEY, "block").join(
        broadcast_if_small(rated.select(*_KEY).distinct()), _KEY, "left_semi").withColumn(
        "read", F.lit(0))
    read = _by_shard(postings, rated, used, "field string, term string, block int").withColumn(
        "read", F.lit(1))
    seen = every.unionByName(read).groupBy(*_KEY, "block").agg(F.max("read").alias("read"))
    return seen.agg(
        F.count("*").alias("blocks"), F.coalesce(F.sum("read"), F.lit(0)).alias("blocks_read"),
        F.coalesce(F.sum(1 - F.col("read")), F.lit(0)).alias("blocks_skipped"))
