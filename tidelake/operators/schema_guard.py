"""Schema enforcement on write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaError(ValueError):
    """Rows do not have the layout of the table they are meant for."""


def assert_schema(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in table column order, refused when its schema differs from the table's.

    Extra columns, other types and absent required columns are errors; an absent nullable column
    becomes null. That is found before any row is read. A null in a required column fails the job
    that reads the row, and with it the write.
    """
    given = {f.name: f.dataType for f in frame.schema.fields}
    expected = {f.name: f for f in schema.fields}
    problems = [f"unexpected column {name}" for name in given if name not in expected]
    for name, field in expected.items():
        if name not in given:
            if not field.nullable:
                problems.append(f"missing required column {name}")
        elif _shape(given[name]) != _shape(field.dataType):
            problems.append(f"column {name} is {given[name].simpleString()}, "
                            f"expected {field.dataType.simpleString()}")
    if problems:
        raise SchemaError("; ".join(problems))
    return frame.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) if f.name not in given
        else F.col(f.name) if f.nullable else _filled(f.name) for f in schema.fields
    ])


def _filled(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(
        F.raise_error(F.lit(f"null in required column {name}"))).alias(name)


def _shape(kind: T.DataType) -> str:
    """Type without nullability, which a projection may change."""
    return kind.simpleString()


def verify_schema_enforcement(rows: DataFrame, append: Callable[[DataFrame], None]) -> None:
    """Offer the writer of a table rows with one column too many; succeed only if it refuses."""
    try:
        append(rows.limit(1).withColumn("column_nobody_asked_for", F.lit(True)))
    except SchemaError:
        return
    raise SchemaError("the writer took rows with a column that the table doesn't have")
