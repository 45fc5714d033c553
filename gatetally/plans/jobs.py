"""The two batch jobs: raw to curated, and curated to analytics."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.operators import curate, funnel, interest, joins, traffic
from gatetally.session import use_utc
from gatetally.sources import days, files, relational
from gatetally.sources import open_fields as open_fields_of

CURATED = {
    "clickstream": S.CLICK_CURATED,
    "events": S.CATALOG_CURATED,
    "campaigns": S.CAMPAIGN_CURATED,
    "transactions": S.TX_CURATED,
}
ANALYTICS = {
    "metrics_funnel_daily": S.FUNNEL,
    "metrics_event_rank": S.RANK,
    "metrics_anomalies": S.ANOMALY,
}


@dataclass(frozen=True)
class Database:
    """Where the metric tables are published."""

    url: str
    options: dict[str, str]
    keep_definition: bool = False


def open_layer(spark: SparkSession, base: str, layer: str, schemas: dict) -> dict[str, DataFrame]:
    return {n: files.read_layer(spark, files.layer_path(base, layer, n), s) for n, s in schemas.items()}


def _store(
    spark: SparkSession,
    base: str,
    layer: str,
    frames: dict[str, DataFrame],
    replace: str,
    named: list[str] | None = None,
) -> DataFrame:
    """Write independent datasets at the same time, so that the small ones do
    not wait for the large one. The first error is raised once all have ended.
    Returns the rows of each dataset: those just written are counted on their
    way, only a dataset of which some days were replaced is counted again.

    ``replace`` is ``all`` for whole datasets, or ``days`` for the days ``named``,
    else those that a dataset has rows for.
    """
    if replace not in ("all", "days"):
        raise ValueError(f"replace all or days, not {replace}")

    @inheritable_thread_target(spark)
    def write(name: str) -> int | None:
        path, keys = files.layer_path(base, layer, name), S.LAYER_KEYS[name]
        if replace == "days":
            days.write_days(frames[name], path, keys, named)
        elif days.kept_by_day(spark, path):
            days.write_days(frames[name], path, keys, whole=True)
        else:
            return files.write_layer(frames[name], path, keys)
        return None

    with ThreadPoolExecutor(len(frames)) as pool:
        started = {name: pool.submit(write, name) for name in frames}
    counts = {name: done.result() for name, done in started.items()}
    schemas = {"curated": CURATED, "analytics": ANALYTICS}[layer]
    other = {
        n: files.read_layer(spark, files.layer_path(base, layer, n), schemas[n]) for n in frames if counts[n] is None
    }
    told = funnel.known_counts(spark, {n: c for n, c in counts.items() if c is not None})
    return told.unionByName(funnel.layer_counts(other)) if other else told


def curate_all(
    spark: SparkSession,
    base: str,
    tenant: str,
    strict: bool = False,
    replace: str = "all",
    open_fields: bool = False,
) -> DataFrame:
    """Curate the four raw inputs under ``base`` and return their row counts.

    With ``open_fields`` clickstream rows keep what the contract does not name in
    a column ``extra``, and lines that are no JSON go to ``curated/malformed``.

    ``strict`` adds the documented steps: copies of clickstream rows and sales
    of events outside the catalog are removed.
    """
    use_utc(spark)
    raw = {
        n: files.read_csv(spark, files.layer_path(base, "raw", f"business/{n}.csv"), s)
        for n, s in {"events": S.CATALOG_RAW, "campaigns": S.CAMPAIGN_RAW, "transactions": S.TX_RAW}.items()
    }
    logs = files.layer_path(base, "raw", "clickstream/*.jsonl")
    clicks = open_fields_of.read_open(spark, logs) if open_fields else files.read_clickstream(spark, logs)
    catalog = curate.curate_catalog(raw["events"])
    by_tenant = curate.curate_clickstream_strict if strict else curate.curate_clickstream
    sales = (
        joins.curate_transactions_strict(raw["transactions"], catalog)
        if strict
        else curate.curate_transactions(raw["transactions"])
    )
    curated = {
        "clickstream": by_tenant(clicks, tenant).drop("file", open_fields_of.MALFORMED),
        "events": catalog,
        "campaigns": curate.curate_campaigns(raw["campaigns"]),
        "transactions": sales,
    }
    if open_fields:
        lost = open_fields_of.malformed_lines(clicks)
        lost.write.mode("overwrite").json(files.layer_path(base, "curated", "malformed"))
    return _store(spark, base, "curated", curated, replace)


def analyse_all(
    spark: SparkSession,
    base: str,
    database: Database | None = None,
    replace: str = "all",
    some_days: list[str] | None = None,
) -> DataFrame:
    """Compute, store and optionally publish the three metrics; return counts.

    With ``some_days`` only those days are read and computed, and replaced as a
    whole; every metric is one of its day alone.

    Each metric is computed once, on its way to storage, and counted there. The
    relational tables are served from the stored copy.
    """
    use_utc(spark)
    clicks = files.read_layer(spark, files.layer_path(base, "curated", "clickstream"), S.CLICK_CURATED)
    if some_days is not None:
        clicks, replace = clicks.filter(F.col("dt").isin(some_days)), "days"
    metrics = {
        "metrics_funnel_daily": funnel.funnel_daily(clicks, ordered=False),
        "metrics_event_rank": interest.event_rank(clicks, ordered=False),
        "metrics_anomalies": traffic.anomalies(clicks, ordered=False),
    }
    counts = _store(spark, base, "analytics", metrics, replace, some_days)
    if database:
        publish(open_layer(spark, base, "analytics", ANALYTICS), database)
    return counts


def publish(stored: dict[str, DataFrame], database: Database) -> None:
    """All funnel days, all ranks and all flagged anomalies."""
    tables = [
        (relational.FUNNEL_TABLE, stored["metrics_funnel_daily"]),
        (relational.RANK_TABLE, stored["metrics_event_rank"]),
        (relational.ANOMALY_TABLE, traffic.flagged_rows(stored["metrics_anomalies"])),
    ]
    for table, df in tables:
        relational.write_jdbc(df, database.url, table, database.options, database.keep_definition)
