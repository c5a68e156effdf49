"""Session defaults for local runs; a cluster brings its own settings."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their working folder.

    On a cluster whose nodes don't have that folder, install the package or pass it with --py-files.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
