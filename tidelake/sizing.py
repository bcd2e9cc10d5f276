"""Measured size of a DataFrame, to decide whether it may be broadcast."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def _field_bytes(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("long") + 16
    return F.lit(16).cast("long")


def measure(frame: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of a DataFrame: one map-side aggregate, one row to the driver."""
    width = reduce(add, [_field_bytes(f.name, f.dataType) for f in frame.schema.fields])
    row = frame.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
    found = row.first()
    return found["rows"], found["bytes"]


def fits_broadcast(frame: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the measured data is small enough to copy to every executor."""
    return measure(frame)[1] <= limit


def broadcast_if_small(frame: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame with a broadcast hint when its measured size allows it, else unchanged."""
    return F.broadcast(frame) if fits_broadcast(frame, limit) else frame
