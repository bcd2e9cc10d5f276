"""Array expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use the result several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)
