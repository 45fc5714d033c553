import datetime as dt
import random

import pytest

from gatetally.operators.attribution import session_attribution

START = dt.datetime(2024, 1, 1)


def event(session, second, utm=None, referrer=None):
    at = None if second is None else START + dt.timedelta(seconds=second)
    return {"session_id": session, "source": "client", "event_ts": at, "utm_campaign": utm, "referrer": referrer}


def visitor_memory(rows):
    """What a browser that remembers its attribution would send, row by row.
    All rows of an instant are remembered before any of them is sent."""
    out = []
    for session in {r["session_id"] for r in rows}:
        mine = [r for r in rows if r["session_id"] == session]
        utm = referrer = since = None
        for at in sorted({r["event_ts"] for r in mine if r["event_ts"]}):
            now = [r for r in mine if r["event_ts"] == at]
            new = [r["utm_campaign"] for r in now if r["utm_campaign"]]
            if new:
                utm, since = max(new), since or at
            seen = [r["referrer"] for r in now if r["referrer"]]
            referrer = referrer or (min(seen) if seen else None)
            out += [(session, at, utm, referrer, since)] * len(now)
        out += [(session, None, r["utm_campaign"], r["referrer"], None) for r in mine if r["event_ts"] is None]
    return sorted(out, key=repr)


def told(df, **options):
    columns = ["session_id", "event_ts", "attr_campaign", "attr_referrer", "first_seen_ts"]
    return sorted(map(tuple, session_attribution(df, **options).select(*columns).collect()), key=repr)


def test_last_campaign_first_referrer_first_time(clicks):
    rows = [event("a", 0), event("a", 10, referrer="r1"), event("a", 20, "c1", "r2"), event("a", 90), event("a", 200, "c2"),
            event("a", 300)]
    assert told(clicks(*rows)) == visitor_memory(rows)
    last = told(clicks(*rows))[-1]
    assert last[2:] == ("c2", "r1", START + dt.timedelta(seconds=20))


@pytest.mark.parametrize("unit", ["second", "minute", "hour", "day", "year"])
def test_slices_do_not_change_the_answer(clicks, unit):
    dice = random.Random(7)
    rows = [
        event(
            "hot" if dice.random() < 0.6 else f"s{dice.randrange(9)}",
            dice.randrange(9000) if dice.random() < 0.95 else None,
            f"c{dice.randrange(5)}" if dice.random() < 0.1 else None,
            f"r{dice.randrange(5)}" if dice.random() < 0.1 else None,
        )
        for _ in range(600)
    ]
    assert told(clicks(*rows), slice_unit=unit) == visitor_memory(rows)


def test_long_silent_slices_carry_state(clicks):
    rows = [event("a", 0, "c", "r")] + [event("a", 60 * n) for n in range(1, 50)]
    assert told(clicks(*rows)) == visitor_memory(rows)


def test_server_rows_and_rows_without_session_are_not_visits(clicks):
    df = clicks(event("a", 1, "c"), event("a", 2) | {"source": "server"}, event(None, 3, "c"))
    assert session_attribution(df).count() == 1
