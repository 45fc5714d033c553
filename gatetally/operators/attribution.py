"""Campaign attribution carried along a visitor's session."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatetally.operators.curate import client_events

SESSION, TIME, SLICE = "session_id", "event_ts", "_slice"


def _evidence() -> dict[str, Column]:
    """What one event contributes, as values whose maximum or minimum is kept.

    Events at the same instant have no order; the greatest campaign and the
    smallest referrer of that instant win. Events without a time contribute
    nothing to others.
    """
    at, utm, ref = F.col(TIME), F.col("utm_campaign"), F.col("referrer")
    timed = at.isNotNull()
    return {
        "_utm": F.when(timed & utm.isNotNull(), F.struct(at.alias("at"), utm.alias("text"))),
        "_ref": F.when(timed & ref.isNotNull(), F.struct(at.alias("at"), ref.alias("text"))),
        "_since": F.when(utm.isNotNull(), at),
    }


def _kept(name: str) -> Column:
    return F.max(name) if name == "_utm" else F.min(name)


def carried_along(timed: DataFrame, slice_unit: str = "minute") -> DataFrame:
    """Rows with a time (session_id, event_ts, utm_campaign, referrer and others), and what is in force at each of them.

    A session may hold a third of all events, so its history is cut into time
    slices: state runs inside each slice, and the state at the end of earlier
    slices is carried in from one summary row per slice. A task sorts one slice
    of events or one session's slices, never all events of a session.
    """
    evidence = _evidence()
    events = timed.withColumns({**evidence, SLICE: F.date_trunc(slice_unit, TIME)})

    inside = (
        Window.partitionBy(SESSION, SLICE)
        .orderBy(TIME)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = events.withColumns({name: _kept(name).over(inside) for name in evidence})

    before = Window.partitionBy(SESSION).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    ends = events.groupBy(SESSION, SLICE).agg(*[_kept(n).alias(n) for n in evidence])
    carried = ends.select(SESSION, SLICE, *[_kept(n).over(before).alias(f"{n}_in") for n in evidence])

    joined = local.join(carried, [SESSION, SLICE], "left")
    return joined.select(
        *timed.columns,
        F.greatest("_utm", "_utm_in")["text"].alias("attr_campaign"),
        F.least("_ref", "_ref_in")["text"].alias("attr_referrer"),
        F.least("_since", "_since_in").alias("first_seen_ts"),
    )


def session_attribution(curated: DataFrame, slice_unit: str = "minute") -> DataFrame:
    """Browser events with the attribution in force at each of them.

    ``attr_campaign`` is the last campaign so far in the session,
    ``attr_referrer`` the first referrer, ``first_seen_ts`` the time of the first
    campaign. Events without a time have their own values only and take no part
    in the windows.
    """
    browsed = client_events(curated)
    with_time = carried_along(browsed.filter(F.col(TIME).isNotNull()), slice_unit)
    without = browsed.filter(F.col(TIME).isNull()).select(
        *curated.columns,
        F.col("utm_campaign").alias("attr_campaign"),
        F.col("referrer").alias("attr_referrer"),
        F.lit(None).cast(curated.schema[TIME].dataType).alias("first_seen_ts"),
    )
    return with_time.unionByName(without)
