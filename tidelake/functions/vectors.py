"""Dense vectors as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.functions.arrays import let


def unit_vector(vector: Column) -> Column:
    """Scale to length one in double precision; an all-zero vector stays as it is."""

    def scaled(v: Column) -> Column:
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
        return let(norm, lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(x)))

    return let(vector.cast("array<double>"), scaled)
