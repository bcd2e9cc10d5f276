"""Parquet tables of which a change rewrites the partitions it touches, and no others.

The new content of those partitions is staged beside the table and then replaces them by dynamic
partition overwrite. A step has a name: if it is repeated, as a stream repeats its last batch after a
failure, and its rows are already staged, they are put in place as they are. So a step that failed
half way through replacing partitions ends with the same rows, whatever the table then holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing this folder."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _files(spark, path)
    files.delete(folder, True)


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table; empty before its first change."""
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def bucket_of(buckets: int, *columns: str) -> Column:
    """Name of a row's bucket. It tells how many there are: tables don't mix numbers unnoticed."""
    number = F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("string")
    return F.concat(number, F.lit(f"-of-{buckets}"))


def check_buckets(spark: SparkSession, root: str, buckets: int) -> None:
    """Refuse another number of buckets than the table was begun with."""
    files, folder = _files(spark, root)
    if not files.exists(folder):
        return
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("bucket=") and not name.endswith(f"-of-{buckets}"):
            raise ValueError(f"{root} has {name}, not buckets of {buckets}")


def touched(rows: DataFrame, partition: str) -> list:
    """Partitions that the rows belong to: as many values as the table has partitions at most."""
    return [r[0] for r in rows.select(partition).distinct().collect()]


def staged(
    rows: DataFrame, root: str, step: str, measures: dict[str, Column],
) -> tuple[DataFrame, dict[str, int]]:
    """The rows of a step as written beside the table, with sums measured while they were written."""
    spark, path = rows.sparkSession, f"{root}/_staged/{step}"
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in measures.items()]
    if is_written(spark, path):  # the step is repeated
        found = spark.read.schema(rows.schema).parquet(path)
        return found, found.agg(*sums).first().asDict() if sums else {}
    seen = Observation()
    if sums:
        rows = rows.observe(seen, *sums)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path), seen.get if sums else {}


def replace_partitions(rows: DataFrame, root: str, partition: str) -> None:
    """Replace the partitions that occur in the rows."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").partitionBy(partition).parquet(root)


def apply_step(
    rows: DataFrame, root: str, step: str, partition: str,
    measures: dict[str, Column] | None = None, columns: list[str | Column] | None = None,
    before: Callable[[DataFrame, dict[str, int]], None] | None = None,
) -> dict[str, int]:
    """Stage the rows, tell ``before`` about them, put ``columns`` of them in place, clean up."""
    found, sums = staged(rows, root, step, measures or {})
    if before is not None:
        before(found, sums)
    replace_partitions(found.select(*columns) if columns else found, root, partition)
    remove(rows.sparkSession, f"{root}/_staged/{step}")
    return sums
