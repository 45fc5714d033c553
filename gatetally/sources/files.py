"""Readers and writers of the raw, curated and analytics layers."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatetally import schemas as S
from gatetally.operators.curate import with_missing
from gatetally.sources import days, tail


def layer_path(base: str, layer: str, name: str) -> str:
    """Path of a dataset in a layer; ``base`` is any Hadoop URI."""
    return "/".join([base.rstrip("/"), layer.strip("/"), name.strip("/")])


def _wider(schema: T.StructType, extra: tuple[str, ...]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in extra]])


def read_clickstream(spark: SparkSession, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """JSON Lines as text columns; a malformed line becomes a row of nulls.

    ``extra`` names further fields to read, nested ones as their JSON text.
    """
    return spark.read.schema(_wider(S.CLICK_RAW, extra)).json(path)


def stream_clickstream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same rows as a stream over the files arriving in a folder."""
    reader = spark.readStream.schema(S.CLICK_RAW)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def tail_clickstream(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """The same rows as a stream of the lines that are appended to files; see :mod:`sources.tail`.

    ``path`` is a file, a folder, or a folder with a wild card in its last part.
    """
    spark.dataSource.register(tail.LineTail)
    reader = spark.readStream.format(tail.LineTail.name())
    if split_bytes:
        reader = reader.option("splitBytes", split_bytes)
    return reader.load(path).select(F.from_json("value", S.CLICK_RAW).alias("row")).select("row.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV as text columns taken by their names in the header; an empty cell is null.

    Columns may come in any order, others are left out, missing ones are null;
    the files of one path share a header. A record is one line unless
    ``multi_line``, which reads quoted line breaks but cannot split a file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return with_missing(reader.csv(path), schema).select(*schema.fieldNames())


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored layer, however it was written. The schema is given, since partition
    values read without one change type with the data (a day column turns to text
    once it holds ``unknown``)."""
    if days.kept_by_day(spark, path):
        return days.read_days(spark, path, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def write_layer(df: DataFrame, path: str, keys: tuple[str, ...]) -> int:
    """Replace a layer by Parquet partitioned by ``keys``; returns how many rows were written.

    Rows are brought together by partition before writing, so that each folder
    gets few, evenly sized files; the rebalance splits a folder with a third of
    the data over many tasks. To replace some days only, see
    :func:`sources.days.write_days`.
    """
    counted = Observation()
    (
        # Counted behind the shuffle, in the tasks that write: none of those counts twice.
        df.hint("rebalance", *[F.col(k) for k in keys])
        .observe(counted, F.count(F.lit(1)).alias("n_rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*keys)
        .parquet(path)
    )
    return counted.get["n_rows"]


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, in as many part files as ``df`` has partitions."""
    df.write.mode("overwrite").json(path)
