"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Days are cut and timestamps printed in UTC. The rest lets Spark re-plan from measured sizes:
# it splits skewed join partitions and merges small shuffle partitions after the fact, so
# spark.sql.shuffle.partitions may be set for the largest shuffle of a job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Of a key that a JSON object repeats the last value counts, as JSON readers have it.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names for checkpoints.

    Without that setting only a local session, whose executors share the machine, gets a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidelake-")
    return f"{base.rstrip('/')}/tidelake-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for what is run or started inside: a stream keeps those it was started with."""
    earlier = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in earlier.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
