"""What several operators share: words, stored tables, and positions in a global order."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.session import shared_folder

# A word is a run of characters other than these six, as every contract of these operators says.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def stored(frame: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The frame written as a table in the shared folder and read back.

    It cuts the lineage: what is read later does not depend on executors that may be lost, and a
    later pass does not repeat the work. The folder is a new one below spark.checkpoint.dir unless
    the caller names one.
    """
    path = f"{folder or shared_folder(frame.sparkSession)}/{name}"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: neighbouring numbers become unrelated ones (modulo 2**64)."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64, copy=True)
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(32)
        return v


def unit(values: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((values >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


SIEVE_BITS = 1 << 27  # at most: 16 MB in every task
_SIEVE_HASHES = 4


def _sieve_places(keys: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salted = keys.astype(np.uint64)[:, None] + np.arange(1, _SIEVE_HASHES + 1, dtype=np.uint64) \
            * np.uint64(0x9E3779B97F4A7C15)
    return (mixed(salted) & np.uint64(bits - 1)).astype(np.int64)


def sieve(keys: DataFrame, most_bits: int = SIEVE_BITS) -> Callable[[Column], Column]:
    """A test that lets all of the keys (one long column) pass and few others: a Bloom filter.

    It spares rows a shuffle whose partners are few, wherever they lie. Its size follows the number of
    keys up to a fixed bound; beyond that it lets more pass, and what it feeds must be exact anyway.
    """
    spark = keys.sparkSession
    name, count = keys.columns[0], keys.count()
    bits = min(most_bits, 1 << max(12, (16 * count).bit_length()))

    @F.arrow_udf("array<long>")
    def places(key: pa.Array) -> pa.Array:
        found = _sieve_places(key.to_numpy(), bits)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(0, found.size + 1, _SIEVE_HASHES), pa.int32()), pa.array(found.ravel()))

    words = keys.select(F.explode(places(name)).alias("p")).groupBy(
        F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("set")).toArrow()
    table = np.zeros(bits >> 6, np.int64)
    table[words["word"].to_numpy()] = words["set"].to_numpy()
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def passes(key: pa.Array) -> pa.Array:
        at = _sieve_places(key.to_numpy(), bits)
        held = shared.value[at >> 6] >> (at & 63) & 1
        return pa.array(held.all(axis=1))

    return passes
