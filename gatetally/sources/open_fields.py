"""Clickstream lines with the fields that the contract does not name, and lines that are no JSON.

A collector accepts further fields, of any type, nested ones too. They are kept in one
``VARIANT`` column ``extra``: an object of what the contract lacks, with its types, or
null. Lines that cannot be parsed keep their text in ``malformed`` instead of becoming
rows of nulls. Both columns go through curation beside the contract's; malformed lines
belong to no tenant and are set apart by :func:`malformed_lines`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatetally import schemas as S

EXTRA, MALFORMED = "extra", "malformed"
#: Curated rows with their further fields.
CLICK_OPEN = T.StructType([*S.CLICK_CURATED.fields, T.StructField(EXTRA, T.VariantType())])


def opened(lines: DataFrame) -> DataFrame:
    """Contract columns, ``extra`` and ``malformed`` of the JSON Lines in ``value``, batch or stream.

    Other columns of ``lines`` stay. Empty lines are left out.
    """
    schema = T.StructType([*S.CLICK_RAW.fields, T.StructField(MALFORMED, T.StringType())])
    row = F.from_json("value", schema, {"columnNameOfCorruptRecord": MALFORMED})
    every = F.from_json("value", "map<string, variant>")
    further = F.map_filter(every, lambda name, _: ~name.isin(S.CLICK_RAW.fieldNames()))
    kept = [c for c in lines.columns if c != "value"]
    return (
        lines.filter(F.length(F.trim("value")) > 0)
        .select(*kept, row.alias("row"), F.when(F.size(further) > 0, F.parse_json(F.to_json(further))).alias(EXTRA))
        .select("row.*", EXTRA, *kept)
    )


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """The lines of files; ``file`` names the file of each."""
    return opened(spark.read.text(path).withColumn("file", F.col("_metadata.file_path")))


def stream_open(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream over the files arriving in a folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return opened(reader.text(path))


def malformed_lines(rows: DataFrame) -> DataFrame:
    """(file, malformed): the lines that could not be parsed."""
    return rows.filter(F.col(MALFORMED).isNotNull()).select("file", MALFORMED)
