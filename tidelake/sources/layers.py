"""Layer tables on shared storage.

Plain Parquet has no atomic overwrite, so a snapshot goes to a new version directory and becomes
visible when a line naming it is added to the table's list of versions. Formats with their own
transactions (``delta``, ``iceberg``) are passed through by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.schema_guard import assert_schema


@dataclass(frozen=True)
class LakePaths:
    """Table locations under one root."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self._at("raw")

    @property
    def topics(self) -> str:
        """Messages published by the validation stream, one directory per topic.

        Readers of a stream's files follow its log and see nothing else, so no batch job may write
        here.
        """
        return self._at("topics")

    @property
    def batch_topics(self) -> str:
        """Messages published by batch jobs, one directory per topic."""
        return self._at("topics_batch")

    @property
    def bronze(self) -> str:
        return self._at("bronze")

    @property
    def silver(self) -> str:
        return self._at("silver")

    @property
    def silver_changes(self) -> str:
        """Which events changed in history, one directory per step."""
        return self._at("silver_changes")

    @property
    def ledger(self) -> str:
        """Rows that each stage counted while it wrote them, one directory per step."""
        return self._at("ledger")

    @property
    def silver_current(self) -> str:
        return self._at("silver_current")

    @property
    def gold(self) -> str:
        return self._at("gold")

    @property
    def chunks(self) -> str:
        return self._at("chunks")

    @property
    def checkpoints(self) -> str:
        return self._at("checkpoints")


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Make a folder that a reader may look into before anything is written there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def current_version(spark: SparkSession, root: str) -> int | None:
    """Newest published version; None before the first one."""
    try:
        published = spark.read.schema("version bigint").json(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return published.agg(F.max("version")).first()[0]


def _version_path(root: str, version: int) -> str:
    return f"{root}/version-{version:010d}"


def read_layer(spark: SparkSession, root: str, table_format: str = "parquet") -> DataFrame:
    """The current snapshot of a versioned table, or a table of another format."""
    if table_format != "parquet":
        return spark.read.format(table_format).load(root)
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(_version_path(root, version))


def write_snapshot(
    frame: DataFrame, root: str, schema: T.StructType, table_format: str = "parquet",
) -> str:
    """Replace a whole table, whose schema must not change. Returns where the rows are.

    Rows may come from the current version: it stays in place. A write that failed before it was
    published is overwritten by the next one.
    """
    rows = assert_schema(frame, schema)
    if table_format != "parquet":
        rows.write.format(table_format).mode("overwrite").option("overwriteSchema", "false").save(
            root)
        return root
    spark = frame.sparkSession
    newest = current_version(spark, root)
    version = 0 if newest is None else newest + 1
    rows.write.mode("overwrite").option("compression", "zstd").parquet(_version_path(root, version))
    spark.range(1).select(F.lit(version).cast("bigint").alias("version")).coalesce(
        1).write.mode("append").json(f"{root}/versions")
    return _version_path(root, version)


def expire_versions(spark: SparkSession, root: str, retain: int = 2) -> list[str]:
    """Delete what belongs to versions older than the newest ``retain`` ones; returns what went.

    Snapshots, changes and states carry their version in their name. Nothing is deleted unless this
    is called: readers of an older version must have ended. Changes from before the first version
    count as older than it.
    """
    newest = current_version(spark, root)
    if retain < 1 or newest is None:
        raise ValueError("at least the current version stays, and there must be one")
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files, gone = folder.getFileSystem(spark._jsc.hadoopConfiguration()), []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        kind, _, number = name.rpartition("-")
        if kind not in ("version", "changes", "state"):
            continue
        if number == "first" or (number.isdigit() and int(number) <= newest - retain):
            files.delete(entry.getPath(), True)
            gone.append(name)
    return sorted(gone)


def write_create(
    frame: DataFrame, path: str, schema: T.StructType, table_format: str = "parquet",
) -> None:
    """First write of a table; an existing target is an error."""
    assert_schema(frame, schema).write.format(table_format).mode("errorifexists").save(path)


def merge_into(
    source: DataFrame, table: str, key: str = "event_id",
    order_by: Sequence[str] = ("ingested_at",),
) -> None:
    """The same merge as ``merge_upsert``, done in place by a table whose format supports it.

    Only the files that hold matches are rewritten. Plain Parquet tables refuse it; no format that
    supports it is at hand here, so that a merge succeeds is untested.
    """
    source_age, table_age = (F.struct(*[F.col(f"{side}.{c}") for c in order_by])
                             for side in ("source", table))
    (
        source.alias("source")
        .mergeInto(table, F.col(f"{table}.{key}") == F.col(f"source.{key}"))
        .whenMatched(source_age >= table_age).updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )
