"""Vectors of texts: a default that counts hashed terms, and a hook for any model."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import by_slices, require_text, tokens
from tidelake.functions.vectors import unit_vector

DIMENSION = 64
Encoder = Callable[[pd.Series], pd.Series]


def hashed_terms(dim: int) -> Callable[[pa.Array], pa.Array]:
    """Batch function from token lists to unit vectors of term counts per hash bucket.

    A bucket is the first eight hex digits of a term's md5, modulo ``dim``. Each distinct term of
    a batch is hashed once; the counts of all texts are one histogram. The same in lambda functions
    took twice as long.
    """

    def vectors(texts: pa.Array) -> pa.Array:
        terms = texts.flatten().dictionary_encode()
        buckets = np.array([int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim
                            for t in terms.dictionary.to_pylist()], dtype=np.int64)
        rows = np.repeat(np.arange(len(texts)), np.diff(texts.offsets.to_numpy()))
        cells = rows * dim + buckets[terms.indices.to_numpy()]
        counts = np.bincount(cells, minlength=len(texts) * dim).reshape(-1, dim).astype(float)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        np.divide(counts, norms, out=counts, where=norms > 0)
        starts = np.arange(0, (len(texts) + 1) * dim, dim, dtype=np.int32)
        return pa.ListArray.from_arrays(starts, pa.array(counts.ravel().astype(np.float32)))

    return vectors


def embed_text(
    frame: DataFrame, text: str = "text", encode: Encoder | None = None, dim: int = DIMENSION,
) -> DataFrame:
    """Add ``embedding``, a unit vector of each text; an empty text fails the job.

    Without a model the vector counts hashed terms. ``encode`` receives Arrow batches of texts and
    returns one vector each; it should load its model once per process.
    """
    checked = require_text(F.col(text), "embedding input must not be empty")
    if encode is None:
        vector = F.arrow_udf(by_slices(hashed_terms(dim)), "array<float>")(tokens(checked))
    else:
        vector = unit_vector(F.pandas_udf(encode, "array<double>")(checked))
    return frame.withColumn("embedding", vector.cast("array<float>"))


def normalize_vectors(frame: DataFrame, column: str = "embedding") -> DataFrame:
    return frame.withColumn(column, unit_vector(F.col(column)))
