"""The local session of tests and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from tidelake.session import configure


def session(cpus: str = "8", memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', cpus)}]")
        .appName("tidelake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
