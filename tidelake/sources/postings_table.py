"""Postings on storage: for every term blocks of chunks, with the greatest impact in each block.

Chunks are numbered, so that a posting is two numbers and no text. A block holds the chunks whose hashed
number falls to it, so the block of a chunk is known without looking. A term has as many blocks as it
needs for BLOCK chunks each, a power of two. Files hold ranges of terms; a term that occurs everywhere is
cut between its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.lexical import K1, B
from tidelake.operators.term_index import FIELDS, field_stats
from tidelake.sizing import broadcast_if_small

BLOCK = 128
# Postings that a task gathers by term at a time before they are shuffled.
GATHERED = 1 << 20


@dataclass(frozen=True)
class Postings:
    """``blocks``: field, term, block, greatest, ids, impacts. ``terms``: field, term,
    document_frequency, groups, greatest. ``stats``: field, chunks, average_length. ``chunks``: number,
    chunk_id; ``ids`` are numbers."""

    blocks: DataFrame
    terms: DataFrame
    stats: DataFrame
    chunks: DataFrame


# A hash of a number that Spark and numpy work out alike; products stay within 63 bits.
_MIX, _LOW, _DROP = 2654435761, 0x7FFFFFFF, 24


def block_of(number: Column, groups: Column) -> Column:
    """The block of a chunk in a term of so many: a power of two, so blocks of one lie within those of
    a smaller one."""
    low = number.bitwiseXOR(F.shiftrightunsigned(number, 33)).bitwiseAND(F.lit(_LOW).cast("long"))
    return F.shiftrightunsigned(low * F.lit(_MIX).cast("long"), _DROP).bitwiseAND(
        groups.cast("long") - 1).cast("int")


def blocks_of(numbers: np.ndarray, groups: int | np.ndarray) -> np.ndarray:
    """The same of an array."""
    return ((((numbers ^ (numbers >> 33)) & _LOW) * _MIX) >> _DROP) & (groups - 1)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows term, block, id, impact to one row per block with lists of the others, GATHERED at a time."""

    def gathered(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        coded = rows.column("term").dictionary_encode()
        key = coded.indices.to_numpy().astype(np.int64) << 32 | rows.column("block").to_numpy()
        order = np.argsort(key, kind="stable")
        found, starts = np.unique(key[order], return_index=True)
        edges = pa.array(np.append(starts, len(key)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [coded.dictionary.take(pa.array(found >> 32)).cast(pa.string()),
             pa.array((found & 0xFFFFFFFF).astype(np.int32)),
             *[pa.ListArray.from_arrays(edges, rows.column(c).take(pa.array(order)))
               for c in ("id", "impact")]], ["term", "block", "ids", "impacts"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held += [batch] if len(batch) else []
        if sum(map(len, held)) >= GATHERED:
            yield gathered(held)
            held = []
    if held:
        yield gathered(held)


def write_postings(index: DataFrame, root: str, block: int = BLOCK) -> None:
    """Store an index (chunk_id, <field>_terms, <field>_length), its chunks numbered, and its postings.

    An impact is what a term's frequency in a chunk counts, between 0 and 1, at the average lengths of
    this index: write the postings anew with every index.
    """
    spark = index.sparkSession
    index.select(F.monotonically_increasing_id().alias("number"), "*").write.mode("overwrite").option(
        "compression", "zstd").parquet(f"{root}/chunks")
    index = spark.read.parquet(f"{root}/chunks")
    field_stats(index).coalesce(1).write.mode("overwrite").parquet(f"{root}/stats")
    average = {r["field"]: r["average_length"]
               for r in spark.read.parquet(f"{root}/stats").collect()}  # a row a field
    flat = {f: index.select(
        "number", F.col(f"{f}_length").alias("length"), F.inline(f"{f}_terms")).select(
            "term", "number", (F.col("tf") / (F.col("tf") + K1 * (
                1 - B + B * F.col("length") / average.get(f, 1.0)))).alias("impact"))
        for f in FIELDS}

    def of_fields(frames: dict[str, DataFrame]) -> DataFrame:
        title, text = (frames[f].select(F.lit(f).alias("field"), "*") for f in FIELDS)
        return title.unionByName(text)

    counted = of_fields(flat).groupBy("field", "term").agg(
        F.count("*").alias("document_frequency"), F.max("impact").alias("greatest"))
    needed = F.ceil(F.log2(F.col("document_frequency") / block))
    counted.select(
        "field", "term", "document_frequency", "greatest",
        F.pow(F.lit(2.0), F.greatest(needed, F.lit(0))).cast("long").alias("groups"),
    ).repartitionByRange("term", "field").sortWithinPartitions("term", "field").write.mode(
        "overwrite").parquet(f"{root}/terms")
    # Most terms have one block; only the others are looked up. A block's postings of a task travel as
    # one row.
    several = broadcast_if_small(spark.read.parquet(f"{root}/terms").where("groups > 1").select(
        "field", "term", "groups"))
    placed = {f: flat[f].join(several.where(F.col("field") == f).drop("field"), "term", "left").select(
        "term", F.coalesce(block_of(F.col("number"), F.col("groups")), F.lit(0)).alias("block"),
        F.col("number").alias("id"), "impact") for f in FIELDS}
    parts = of_fields({f: placed[f].mapInArrow(
        _by_block, "term string, block int, ids array<long>, impacts array<double>") for f in FIELDS})
    parts.repartitionByRange("term", "field", "block").groupBy("term", "field", "block").agg(
        F.sort_array(F.flatten(F.collect_list(F.arrays_zip("ids", "impacts")))).alias("e")).select(
        "field", "term", "block", F.array_max("e.impacts").alias("greatest"),
        F.col("e.ids").alias("ids"), F.col("e.impacts").alias("impacts")).sortWithinPartitions(
        "term", "field", "block").write.mode("overwrite").parquet(f"{root}/blocks")


def read_postings(spark: SparkSession, root: str) -> Postings:
    blocks, terms, stats, chunks = (
        spark.read.parquet(f"{root}/{part}") for part in ("blocks", "terms", "stats", "chunks"))
    return Postings(blocks, terms, stats, chunks.select("number", "chunk_id"))
