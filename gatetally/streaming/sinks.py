"""Starting streams and storing their output so that reruns change nothing."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BATCH = "batch_id"


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run every so often, or once over what is there if no interval is given."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run a ``foreachBatch`` function on every batch."""
    return _triggered(df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), every).start()


def append_files(
    df: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = (), every: str | None = None
) -> StreamingQuery:
    """Append to Parquet files, each row exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*keys) if keys else writer
    return _triggered(writer, every).start(path)


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each batch's rows as a version.

    A batch writes the folder of its own number only. If it is repeated after a
    failure it replaces that folder, and no older rows are read or rewritten.
    The rebalance joins the small outputs of the state partitions.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        (
            rows.hint("rebalance")
            .withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(path)
        )

    return write


def upsert_metrics(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep a metric up to date from a stream in update mode."""
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return _triggered(writer, every).foreachBatch(batch_writer(path)).start()


def latest_metrics(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """For each key the row of the newest batch that had one."""
    versioned = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    stored = spark.read.schema(versioned).parquet(path)
    rest = [c for c in schema.fieldNames() if c not in keys]
    newest = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("row"))
    return newest.select(*keys, "row.*").select(*schema.fieldNames())


def compact_metrics(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: list[str]) -> None:
    """Write the newest rows to an empty ``target``, where a restarted stream can
    go on; they count as older than any batch."""
    batch_writer(target)(latest_metrics(spark, path, schema, keys), -1)
