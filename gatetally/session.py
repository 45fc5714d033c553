"""Session settings the library relies on, and shared scratch folders."""

import os
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(
    app: str = "gatetally", cores: int | str = 8, memory: str = "12g", **settings: str
) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    Further ``settings`` are given with underscores for dots.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        # Small test layers have many folders: let several tasks write them.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: text times and day keys are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession) -> SparkSession:
    """A sibling session for streams with one state partition per core.

    A stream keeps its number of state partitions for good and every batch
    visits all of them, so it is chosen apart from the batch setting.
    """
    sibling = use_utc(spark.newSession())
    sibling.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return sibling


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for ``label`` in the shared folder the cluster names.

    The shared folder is ``spark.checkpoint.dir``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex}")
