import math
import random

import pytest

from gatetally.operators import logqueries


def nearest_rank(values, percent=95):
    ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    if not ordered:
        return None
    return ordered[-(-len(ordered) * percent // 100) - 1]


def request(path, latency, status=200, at=None):
    return {"event_type": "server_request", "source": "server", "request_path": path, "latency_ms": latency,
            "status_code": status, "event_ts": at}


def check(clicks, by_path):
    df = clicks(*[request(p, v, s) for p, values in by_path.items() for v, s in values])
    got = {r["request_path"]: r for r in logqueries.endpoint_health(df).collect()}
    assert set(got) == set(by_path)
    for path, values in by_path.items():
        latencies = [v for v, _ in values]
        known = [v for v in latencies if v is not None]
        row = got[path]
        assert repr(row["p95_latency_ms"]) == repr(nearest_rank(latencies)), path
        assert row["requests"] == len(values)
        assert row["max_status"] == max((s for _, s in values if s is not None), default=None)
        if known and all(map(math.isfinite, known)):
            assert row["avg_latency_ms"] == pytest.approx(sum(known) / len(known))
        elif not known:
            assert row["avg_latency_ms"] is None


def test_small_groups(clicks):
    sizes = {f"/{n}": [(float(i), 200 + i) for i in range(n)] for n in (1, 2, 19, 20, 21, 40, 99, 100, 101)}
    check(clicks, sizes)


def test_missing_odd_and_negative_values(clicks):
    nan, inf = float("nan"), float("inf")
    check(
        clicks,
        {
            "/none": [(None, 200), (None, None)],
            "/some": [(None, 200)] * 30 + [(5.0, 404), (7.0, None)],
            "/zero": [(0.0, 200)] * 5,
            "/negative": [(-float(i), 200) for i in range(1, 60)],
            "/mixed": [(float(i), 200) for i in range(-30, 30)],
            "/inf": [(inf, 200)] * 3 + [(1.0, 200)] * 3,
            "/minusinf": [(-inf, 200)] * 30 + [(-1.0, 200)],
            "/nan": [(nan, 200)] * 2 + [(1.0, 200)] * 2,
            "/tiny": [(5e-324, 200), (1e308, 200)],
            None: [(3.0, 200), (4.0, 200)],
        },
    )


def test_random_values_of_any_spread(clicks):
    dice = random.Random(3)
    check(
        clicks,
        {
            "/narrow": [(1000 + dice.random() / 100, 200) for _ in range(700)],
            "/wide": [(10 ** dice.uniform(-6, 9), 200) for _ in range(700)],
            "/copies": [(float(dice.randrange(4)), dice.choice([200, 500])) for _ in range(700)],
        },
    )


def test_hours_without_time_are_a_group_of_their_own(clicks):
    import datetime as dt

    at = dt.datetime(2024, 1, 1, 5, 59)
    df = clicks(request("/", 1.0, at=at), request("/", 3.0), request("/", 2.0))
    got = {r["hour"]: r["p95_latency_ms"] for r in logqueries.endpoint_hourly(df).collect()}
    assert got == {at.replace(minute=0): 1.0, None: 3.0}


def test_sketch_is_close_to_exact(clicks):
    dice = random.Random(5)
    df = clicks(*[request("/", dice.uniform(1, 500)) for _ in range(3000)])
    (exact,), (quick,) = logqueries.endpoint_health(df).collect(), logqueries.endpoint_health(df, exact=False).collect()
    assert set(exact.asDict()) == set(quick.asDict())
    assert quick["p95_latency_ms"] == pytest.approx(exact["p95_latency_ms"], rel=0.01)
