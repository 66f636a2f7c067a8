"""A local Spark session for tests and benchmarks. On a cluster, use the session at hand."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cpus: int | None = None) -> SparkSession:
    cpus = cpus or os.cpu_count() or 1
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
