"""Session helpers: where intermediate tables go, and how the test session is built."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "quillsift", cpus: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    cores = cpus or os.cpu_count() or 8
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for the tables one run writes.

    The folder lies under ``spark.checkpoint.dir``, which every executor can reach. Where the
    setting is missing, only a local session may fall back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
