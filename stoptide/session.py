"""Session factory and the settings every query relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "stoptide", cores: int | str | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("STOPTIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
