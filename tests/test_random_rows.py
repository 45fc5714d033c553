"""Metrics over random curated rows against plain loops."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from conftest import dicts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gatetally import schemas as S
from gatetally.operators import curate, funnel, interest, traffic

KINDS = [*S.FUNNEL_STEPS, "click", "server_request", "unknown"]
ROWS = st.lists(
    st.fixed_dictionaries(
        {
            "dt": st.sampled_from(["2024-01-01", "2024-01-02", "unknown"]),
            "session_id": st.sampled_from([None, "hot", "hot", "hot", "a", "b"]),
            "event_type": st.sampled_from(KINDS),
            "source": st.sampled_from(["client", "client", "server", "unknown"]),
            "event_id": st.sampled_from([None, 1, 1, 1, 2]),
            "amount": st.one_of(st.none(), st.integers(-500, 9999).map(lambda cents: cents / 100)),
            "ip": st.sampled_from([None, "hot", "hot", "x"]),
            "status_code": st.sampled_from([None, 200, 399, 400, 503]),
            "latency_ms": st.one_of(st.none(), st.integers(0, 300000).map(lambda hundredths: hundredths / 100)),
            "page": st.sampled_from(["/", None]),
        }
    ),
    max_size=80,
)
fuzz = settings(
    max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def half_up(number, digits):
    return float(Decimal(repr(number)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def exact(numbers):
    return sum((Decimal(repr(n)) for n in numbers), Decimal(0))


def grouped(rows, *keys):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in keys)].append(r)
    return groups


def client(rows):
    return [r for r in rows if r["source"] == "client" and r["session_id"]]


@fuzz
@given(ROWS)
def test_funnel(clicks, rows):
    wanted = {}
    for (day,), mine in grouped(client(rows), "dt").items():
        sessions = [len({r["session_id"] for r in mine if r["event_type"] == step}) for step in S.FUNNEL_STEPS]
        total = len({r["session_id"] for r in mine})
        wanted[day] = (total, *sessions, half_up(sessions[-1] / total, 6))
    got = {r["dt"]: tuple(r)[1:-1] for r in funnel.funnel_daily(clicks(*rows)).collect()}
    assert got == wanted


@fuzz
@given(ROWS)
def test_rank(clicks, rows):
    wanted = {}
    about = [r for r in client(rows) if r["event_id"] and r["event_type"] in ("view_event_detail", "purchase")]
    for key, mine in grouped(about, "dt", "event_id").items():
        bought = [r for r in mine if r["event_type"] == "purchase"]
        views = len(mine) - len(bought)
        revenue = float(exact(r["amount"] for r in bought if r["amount"] is not None))
        wanted[key] = (views, len(bought), revenue, half_up(views / (len(bought) or 1), 6))
    df = clicks(*rows)
    assert {(r[0], r[1]): tuple(r)[2:] for r in interest.event_rank(df).collect()} == wanted
    joined = interest.join_interest(interest.detail_views(df), interest.event_purchases(df))
    assert {(r[0], r[1]): tuple(r)[2:] for r in joined.collect()} == wanted


@fuzz
@given(ROWS)
def test_traffic(clicks, rows):
    wanted = {}
    requests = [r for r in rows if r["event_type"] == "server_request" and r["ip"]]
    for key, mine in grouped(requests, "dt", "ip").items():
        times = [r["latency_ms"] for r in mine if r["latency_ms"] is not None]
        mean = (exact(times) / len(times)).quantize(Decimal("0.01"), ROUND_HALF_UP) if times else None
        errors = sum(1 for r in mine if (r["status_code"] or 0) >= 400)
        sessions = len({r["session_id"] for r in mine} - {None})
        wanted[key] = (len(mine), errors, 0, sessions, None if mean is None else float(mean), max(times, default=None))
    got = {(r["dt"], r["ip"]): tuple(r)[2:] for r in traffic.daily_traffic(clicks(*rows)).collect()}
    assert got == wanted


@fuzz
@given(ROWS)
def test_distinct_rows(clicks, rows):
    df = clicks(*rows, *rows[::2], *rows[:10])
    got = dicts(curate.distinct_rows(df).select(*S.CLICK_RAW.fieldNames()))
    wanted = {tuple(r.items()) for r in dicts(clicks(*rows).select(*S.CLICK_RAW.fieldNames()))}
    assert len(got) == len(wanted)
    assert {tuple(r.items()) for r in got} == wanted
