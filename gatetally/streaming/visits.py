"""Attribution of browser events as they arrive, in any order.

The attribution of an event depends on its session and time alone: the last campaign
up to then, the first referrer, the time of the first campaign. What a session says at
an instant (the greatest campaign and the smallest referrer of its events then) is
state of its own, so a session with a third of all events is spread over all tasks, and
an event costs the same however many its session has. Each batch stores the instants
that are new or have changed, with the batch as version. The reader takes the newest of
each instant and carries them along the session in time slices, as in batch; so an event
that comes late corrects the events after it.

State is bounded by ``horizon``: Spark forgets instants behind the watermark, which stays
that far behind the newest event. Events older than that are no longer taken in by the
stream (Spark leaves them out), and correct nothing; the reader still shows them, with
their own values. What was stored stays in force, however long a session is silent.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gatetally import schemas as S
from gatetally.operators.attribution import SESSION, TIME, carried_along
from gatetally.operators.curate import client_events
from gatetally.streaming.sinks import latest_metrics, upsert_metrics

_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

INSTANTS = T.StructType([S.CLICK_CURATED[c] for c in (SESSION, TIME, "utm_campaign", "referrer")])


def instant_updates(curated: DataFrame, horizon: str = "1 hour") -> DataFrame:
    """What sessions say at the instants that events have arrived for, as a stream of :data:`INSTANTS`."""
    spark = curated.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    events = client_events(curated).filter(F.col(TIME).isNotNull()).withWatermark(TIME, horizon)
    campaign, referrer = F.max("utm_campaign").alias("utm_campaign"), F.min("referrer").alias("referrer")
    return events.groupBy(SESSION, TIME).agg(campaign, referrer)


def store_attribution(
    curated: DataFrame, path: str, checkpoint: str, horizon: str = "1 hour", every: str | None = None
) -> StreamingQuery:
    """Keep what is needed to attribute every event that has arrived; see :func:`attributed`."""
    return upsert_metrics(instant_updates(curated, horizon), path, checkpoint, every)


def attributed(spark: SparkSession, path: str, curated: DataFrame) -> DataFrame:
    """Browser events of ``curated`` with the attribution of their instant by all that was stored.

    Events without a time, and those that came too late for the stream, have their
    own values.
    """
    told = carried_along(latest_metrics(spark, path, INSTANTS, [SESSION, TIME]))
    named = told.select(SESSION, TIME, F.struct("attr_campaign", "attr_referrer", "first_seen_ts").alias("told"))
    found, own = F.col("told").isNotNull(), F.lit(None).cast("timestamp")
    return client_events(curated).join(named, [SESSION, TIME], "left").select(
        *curated.columns,
        F.when(found, F.col("told.attr_campaign")).otherwise(F.col("utm_campaign")).alias("attr_campaign"),
        F.when(found, F.col("told.attr_referrer")).otherwise(F.col("referrer")).alias("attr_referrer"),
        F.when(found, F.col("told.first_seen_ts")).otherwise(own).alias("first_seen_ts"),
    )
