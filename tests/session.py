"""Local Spark session for tests and benchmarks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(name: str, cpus: str | None = None, partitions: int | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", partitions or (cpus if cpus.isdigit() else "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
