"""Derived inputs written once per session to the shared scratch folder."""

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from gatetally.operators import curate
from gatetally.plans import jobs
from gatetally.session import stream_session
from gatetally.sources import files
from workload import inputs
from workload.scratch import scratch_dir


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw clickstream as JSON text, and a cut-off line for some events."""
    rows = inputs.clickstream(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    events = inputs.table(spark, sf_dir, "events")
    cut_off = events.filter(F.col("event_id") % 97 == 0).select(
        F.concat(F.lit('{"student_id": "t1", "page": "'), F.col("event_id").cast("string")).alias("value")
    )
    return rows.unionByName(cut_off)


def open_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw clickstream as JSON text; rows with a referrer have fields outside the contract."""
    rows = inputs.clickstream(spark, sf_dir)
    told = F.col("referrer").isNotNull()
    plan = F.when(told, F.struct(F.length("page").alias("tier"))).alias("plan")
    score = F.when(told, F.length(F.coalesce("ip", F.lit("")))).alias("score")
    return rows.select(F.to_json(F.struct(*rows.columns, plan, score)).alias("value"))


#: A file has at most one in so many of the rows, so that small inputs too make several batches of a stream.
_FILES = 8


def _in_files(rows: DataFrame, n_rows: int) -> DataFrameWriter:
    """A writer whose tasks write what they read, without a shuffle."""
    return rows.write.option("maxRecordsPerFile", max(1, -(-n_rows // _FILES)))


def _write_csv(df: DataFrame, path: str) -> None:
    keep = {"header": True, "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**keep).csv(path)


def _n_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the clickstream: a browser and a server row of each event."""
    return 2 * inputs.table(spark, sf_dir, "events").count()


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Path of a scratch folder that ``write`` has filled in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _WRITTEN:
        path = scratch_dir(spark, label)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def raw_base(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the raw layer as files."""

    def write(base: str) -> None:
        lines = _in_files(json_lines(spark, sf_dir), _n_rows(spark, sf_dir))
        lines.text(files.layer_path(base, "raw", "clickstream/derived.jsonl"))
        tables = {"events": inputs.catalog, "campaigns": inputs.campaigns, "transactions": inputs.transactions}
        for name, derive in tables.items():
            _write_csv(derive(spark, sf_dir), files.layer_path(base, "raw", f"business/{name}.csv"))

    return _once(spark, sf_dir, "lake", write)


def curated_base(spark: SparkSession, sf_dir: str) -> str:
    """The same folder once its curated layer is written."""
    base = raw_base(spark, sf_dir)
    _once(spark, sf_dir, "curated", lambda _: jobs.curate_all(spark, base, inputs.TENANT))
    return base


def copies_dir(spark: SparkSession, sf_dir: str) -> str:
    """JSON Lines of the clickstream with repeated rows."""

    def write(path: str) -> None:
        _in_files(inputs.clickstream_with_copies(spark, sf_dir), _n_rows(spark, sf_dir)).json(path)

    return _once(spark, sf_dir, "copies", write)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated clickstream straight from the derived rows, without files."""
    return curate.curate_clickstream(inputs.clickstream(spark, sf_dir), inputs.TENANT)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate_transactions(inputs.transactions(spark, sf_dir))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate_catalog(inputs.catalog(spark, sf_dir))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate_campaigns(inputs.campaigns(spark, sf_dir))


def _per_batch(spark: SparkSession, path: str, batches: int | None) -> int | None:
    """Files of a batch, if a stream over ``path`` takes so many batches at most."""
    return batches and max(1, -(-len(spark.read.text(path).inputFiles()) // batches))


def click_stream(spark: SparkSession, sf_dir: str, batches: int | None = None) -> DataFrame:
    """Curated clickstream as a stream over the raw JSON Lines, all at once or in so many batches."""
    path = files.layer_path(raw_base(spark, sf_dir), "raw", "clickstream/derived.jsonl")
    stream = files.stream_clickstream(stream_session(spark), path, _per_batch(spark, path, batches))
    return curate.curate_clickstream(stream, inputs.TENANT)


def copies_stream(spark: SparkSession, sf_dir: str, batches: int | None = None) -> DataFrame:
    """Raw rows with copies as a stream, all at once or in so many batches."""
    path = copies_dir(spark, sf_dir)
    return files.stream_clickstream(stream_session(spark), path, _per_batch(spark, path, batches))
