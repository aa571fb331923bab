"""The Spark session that tests, the bench and scripts use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "quern", cpus: int | str | None = None) -> SparkSession:
    """A local session in UTC with adaptive execution; on a cluster use the cluster's own."""
    n = cpus or os.environ.get("BENCH_CPUS") or "*"
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("QUERN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
