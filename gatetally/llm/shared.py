"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where scratch goes in a session that names no shared folder, as in tests.
_own_folder: list[str] = []


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder that the session names.

    The folder is ``spark.checkpoint.dir``. Where a session on a single machine leaves
    that unset, as in tests, one temporary folder serves for the whole process; on a
    cluster, where each machine would write to its own disk, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="corpus-"))
        base = _own_folder[0]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


#: With this setting Spark drops the shuffle files of a query when it ends, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, freed: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: what is stored survives lost executors, and a frame that
    several later steps read is computed once. ``freed``: its shuffle files go
    before the next step begins.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    if freed:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if freed:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def returned() -> None:
    """Give memory that a task has freed back to the system: idle workers of an executor share its memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returning(run):
    """``run``, a function for ``mapInArrow``, that gives memory back at the end of a task."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        returned()

    return whole


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table ``documents``; the package goes to the executors that will read it."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))
