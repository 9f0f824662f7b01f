"""Rate audit and endpoint health against direct simulation."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postpulse.config import RequestConfig
from postpulse.operators import request_log as rl

START = datetime(2024, 1, 1)


def make(spark, rows):
    return spark.createDataFrame(rows, "request_id long, client string, ts timestamp, ok boolean, response_time double")


def random_log(n, seed, clients=3, spread=7200):
    rng = random.Random(seed)
    # One client makes two thirds of the calls.
    names = ["busy"] * (2 * clients) + [f"c{i}" for i in range(clients)]
    return [
        (i, rng.choice(names), START + timedelta(seconds=rng.randrange(spread)), rng.random() < 0.7, rng.random())
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_matches_brute_force(spark, seed):
    rows = random_log(400, seed)
    cfg = RequestConfig(per_minute=3, per_hour=40)
    got = {r.request_id: r for r in rl.rate_audit(make(spark, rows), cfg).collect()}
    assert len(got) == len(rows)
    for i, client, ts, _, _ in rows:
        ages = [(ts - t).total_seconds() for _, c, t, _, _ in rows if c == client and t < ts]
        minute, hour = [a for a in ages if a <= 60], [a for a in ages if a <= 3600]
        wait = max(
            60 - max(minute) if len(minute) >= 3 else 0, 3600 - max(hour) if len(hour) >= 40 else 0
        )
        row = got[i]
        assert (row.calls_minute, row.calls_hour) == (len(minute), len(hour))
        assert row.limited == (len(minute) >= 3 or len(hour) >= 40)
        assert row.wait_seconds == pytest.approx(wait)


def test_audit_splits_a_busy_client(spark):
    plan = rl.rate_audit(make(spark, random_log(5, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(client" in plan and ", hour" in plan
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(("spread", "crowd"), [(7200, 20), (7200, 60), (300, 15), (20, 10)])
def test_audit_of_crowded_hours(spark, spread, crowd):
    """Finer slices give what the plain definition gives: minutes, and seconds where minutes are crowded too."""
    rng = random.Random(spread + crowd)
    rows = [(i, c, ts + timedelta(microseconds=rng.choice([0, 0, 1, 999_999])), ok, x) for i, c, ts, ok, x in random_log(500, 3, spread=spread)]
    rows += [(1000 + i, None, START, True, 1.0) for i in range(3)]
    cfg = RequestConfig(per_minute=3, per_hour=25)
    df = make(spark, rows)
    widths = {r.client: r.width for r in rl.busy_clients(df.selectExpr("request_id", "client", "unix_micros(ts) AS at"), crowd).collect()}
    assert "busy" in widths and (set(widths.values()) <= {rl.MINUTE, rl.SECOND}) and (spread > 300) == (widths["busy"] == rl.MINUTE)
    got = {r.request_id: r for r in rl.rate_audit(df, cfg, crowd).collect()}
    plain = {r.request_id: r for r in rl.rate_audit(df, cfg).collect()}
    assert got == plain and len(got) == len(rows)
    for i, client, ts, _, _ in rows[:500:7]:
        ages = [(ts - t) / timedelta(seconds=1) for _, c, t, _, _ in rows if c == client and t < ts]
        assert (got[i].calls_minute, got[i].calls_hour) == (sum(a <= 60 for a in ages), sum(a <= 3600 for a in ages))


def test_one_crowded_hour_takes_several_tasks(spark):
    rows = [(i, "busy", START + timedelta(seconds=i % 3600), True, 1.0) for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counted = [rl.rate_audit(make(spark, rows), crowd=c).groupBy(F.spark_partition_id()).agg(F.sum("calls_hour")).collect() for c in (100, 10_000)]
        assert len(counted[0]) >= 3 and len(counted[1]) == 1
        assert sum(r[1] for r in counted[0]) == counted[1][0][1]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def simulate(rows, cfg):
    state = {}
    for i, client, ts, ok, response in sorted(rows, key=lambda r: (r[2], r[0])):
        s = state.setdefault(client, dict(good=0, bad=0, run=0, active=True, time=0.0))
        if ok:
            s["good"] += 1
            s["time"] += response
            s["run"] = 0
            s["active"] = s["good"] / (s["good"] + s["bad"]) >= cfg.min_success_rate
        else:
            s["bad"] += 1
            s["run"] += 1
            if s["run"] >= cfg.max_failures:
                s["active"] = False
    return state


@pytest.mark.parametrize("seed", range(3))
def test_health_matches_sequential_updates(spark, seed):
    cfg = RequestConfig()
    rows = random_log(300, seed, clients=12, spread=200)
    health = rl.endpoint_active(rl.endpoint_health(make(spark, rows)), cfg)
    got = {r.endpoint: r for r in health.collect()}
    want = simulate(rows, cfg)
    assert set(got) == set(want)
    for name, s in want.items():
        r = got[name]
        assert (r.success_count, r.failure_count, r.consecutive_failures, r.is_active) == (s["good"], s["bad"], s["run"], s["active"])
        assert r.total_response_time == pytest.approx(s["time"])
    summary = rl.endpoint_summary(health).first()
    assert summary.total_endpoints == len(want)
    assert summary.active_endpoints == sum(s["active"] for s in want.values())
    assert summary.avg_success_rate == pytest.approx(sum(s["good"] for s in want.values()) / len(rows))


def test_health_edges(spark):
    at = lambda i: START + timedelta(seconds=i)
    rows = [(i, "never ok", at(i), False, 1.0) for i in range(3)]
    rows += [(10 + i, "exactly .7", at(i), i >= 3, 1.0) for i in range(10)]
    rows += [(30, "two bad", at(0), False, 1.0), (31, "two bad", at(1), False, 1.0)]
    got = {r.endpoint: r for r in rl.endpoint_active(rl.endpoint_health(make(spark, rows))).collect()}
    assert not got["never ok"].is_active and got["exactly .7"].is_active and got["two bad"].is_active
    assert got["never ok"].mean_response_time is None


def test_ranking(spark):
    health = spark.createDataFrame(
        [("a", 9, 1, 0, 0.9, START), ("b", 9, 1, 5, 0.9, None), ("c", 0, 0, 0, None, START + timedelta(days=1)), ("d", 9, 1, 0, 0.9, START)],
        "endpoint string, success_count long, failure_count long, consecutive_failures long, success_rate double, last_used timestamp",
    )
    assert [r.endpoint for r in rl.endpoint_rank(health).collect()] == ["a", "d", "c", "b"]
    assert rl.endpoint_rank(health, 1).first().endpoint == "a"
    assert rl.endpoint_least_recent(health).first().endpoint == "b"
    assert rl.endpoint_least_recent(health.where("last_used is not null")).first().endpoint == "a"


def test_empty_log(spark):
    empty = make(spark, [])
    assert tuple(rl.rate_summary(rl.rate_audit(empty)).first()) == (0, 0, 0.0, 0.0)
    summary = rl.endpoint_summary(rl.endpoint_active(rl.endpoint_health(empty))).first()
    assert summary.total_endpoints == 0 and summary.active_percentage == 0


def test_error_messages(spark):
    texts = ["HTTP 429", "Rate Limit hit", "Too many requests", "quota", "limit exceeded", "throttled!", "timeout"]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    assert [r[0] for r in df.select(rl.is_rate_limit_error(F.col("m"))).collect()] == [True] * 6 + [False]
