"""Scratch folders of the test workload."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from gatetally import session

_OWN: list[str] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where a single-machine
    session leaves that unset, below one temporary folder of this process."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return session.scratch_dir(spark, label)
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="gatetally-"))
    return os.path.join(_OWN[0], f"{label}-{uuid.uuid4().hex}")
