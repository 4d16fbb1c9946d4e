"""Session for tests and benchmarks; on a cluster the jobs take the session they are given."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "ledgerloom", cores: str | int | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or 8
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
