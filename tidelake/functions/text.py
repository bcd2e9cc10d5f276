"""Text normalisation and tokens."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters str.split() treats as whitespace, as the inside of a regex class.
SPLIT_WHITESPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"

# The Unicode White_Space characters, which the contract strips from strings. They
# are those of SPLIT_WHITESPACE without the four information separators.
CONTRACT_WHITESPACE = "".join(
    c for c in map(chr, range(0x3001)) if c.isspace() and not 0x1C <= ord(c) <= 0x1F)

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def normalize_space(text: Column) -> Column:
    """Collapse every whitespace run to one space and strip both ends."""
    return F.trim(F.regexp_replace(text, f"[{SPLIT_WHITESPACE}]+", " "))


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(text, F.lit(CONTRACT_WHITESPACE))


def is_blank(text: Column) -> Column:
    """Null or without any visible character; reads no further than the first one."""
    return text.isNull() | ~text.rlike(f"[^{SPLIT_WHITESPACE}]")


def require_text(text: Column, message: str) -> Column:
    """``text``, failing the job when a value is null or blank."""
    return F.when(is_blank(text), F.raise_error(F.lit(message))).otherwise(text)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


# Tokens that a Python function takes at a time, whatever the rows of an Arrow batch hold.
SLICE_TOKENS = 1 << 18


def in_slices(rows: Any, sizes: pa.Array, most: int) -> Iterator[Any]:
    """Consecutive parts of an array or batch whose sizes add up to about ``most``; a row at least."""
    part = (np.cumsum(sizes.to_numpy(zero_copy_only=False)) - 1).clip(0) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(rows)]
    return (rows.slice(a, b - a) for a, b in itertools.pairwise(edges))


def by_slices(function: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    """The batch function of token lists, run on slices: its memory doesn't grow with the batch."""

    def sliced(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0)
        return pa.concat_arrays([function(p) for p in in_slices(lists, sizes, SLICE_TOKENS)])

    return sliced


def counted_terms(lists: pa.Array) -> pa.Array:
    """Batch function from token lists to their distinct tokens in order, each with its count.

    Tokens of a batch become numbers in order once; the counts of all texts are runs of one sorted
    array. Lambda functions in the JVM took several times as long.
    """
    coded = lists.flatten().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    width = max(len(order), 1)
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    found, counts = np.unique(owner * width + place[coded.indices.to_numpy()], return_counts=True)
    owner, place = np.divmod(found, width)
    runs = pa.StructArray.from_arrays(
        [coded.dictionary.take(pa.array(order[place])).cast(pa.string()),
         pa.array(counts.astype(np.int32))], ["term", "tf"])
    starts = np.searchsorted(owner, np.arange(len(lists) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(starts), runs, mask=lists.is_null() if lists.null_count else None)


def term_frequencies(text: Column) -> Column:
    """``array<struct<term, tf>>`` of one text, in term order; null for a null."""
    count = F.arrow_udf(by_slices(counted_terms), "array<struct<term:string,tf:int>>")
    return count(tokens(text))
