"""Properties: the rewritten operators equal the direct SQL forms on random
NULL-laden data, and the KPI invariants hold on the driver tables."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import MASTER_SCHEMA, SF_SMALL
from questlog.operators import audience, difficulty, monetization, progression, retention
from questlog.plans.catalog import QUERIES
from questlog.sources.driver_tables import DriverTables

EVENTS = ["session_start", "level_complete", "level_fail", "iap_purchase", "ad_reward_claim"]


def random_events(seed: int, n: int = 400):
    rnd = random.Random(seed)
    users = [f"u{i}" for i in range(25)] + [None]
    base = dt.date(2025, 11, 1)
    rows = []
    for i in range(n):
        user = rnd.choice(users)
        day = None if rnd.random() < 0.05 else base + dt.timedelta(days=rnd.randint(0, 12))
        name = rnd.choice(EVENTS)
        level = rnd.choice([None, 1, 2, 3, 5, 8, 21, 24]) if name in ("level_complete", "level_fail") else None
        rev = Decimal(rnd.choice(["0.99", "4.99", "9.99"])) if name == "iap_purchase" and rnd.random() < 0.9 else None
        ts_ = dt.datetime.combine(day, dt.time(rnd.randint(0, 23))) if day else None
        rows.append(
            (i, user, user, day, ts_, name, level, "Win" if name == "level_complete" else ("Fail" if name == "level_fail" else None),
             rnd.randint(50, 200) if name == "level_complete" else None, 50 if name == "ad_reward_claim" else None,
             rev, None, None, None, None)
        )
    return rows


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda row: tuple((x is None, str(x)) for x in row))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rewrites_equal_direct_sql(spark, seed):
    ev = spark.createDataFrame(random_events(seed), MASTER_SCHEMA)
    ev.createOrReplaceTempView("me_prop")
    rows = [r.asDict() for r in ev.collect()]
    # retention from plain sets: the days of each user, numbered from the first
    days = {}
    for r in rows:
        days.setdefault(r["user_pseudo_id"], set()).add(r["event_date"])
    cohorts = {}
    for user, seen in days.items():
        first = min((x for x in seen if x), default=None)
        size = cohorts.setdefault(first, [0, 0, 0, 0])
        if user is not None:
            size[0] += 1
            for i, n in enumerate((1, 3, 7), 1):
                size[i] += first is not None and first + dt.timedelta(days=n) in seen
    want = sorted(((first, *size) for first, size in cohorts.items()), key=lambda row: tuple((x is None, str(x)) for x in row))
    assert as_set(retention.retention(ev)) == want

    money = {}
    for r in rows:
        users, payers, total = money.setdefault(r["event_date"], (set(), set(), []))
        if r["user_id"] is not None:
            users.add(r["user_id"])
            if r["event_name"] == "iap_purchase":
                payers.add(r["user_id"])
        total.append(r["revenue"] or Decimal(0))
    want = [(day, len(u), len(p), float(sum(t))) for day, (u, p, t) in money.items()]
    want.sort(key=lambda row: tuple((x is None, str(x)) for x in row))
    got = monetization.monetization_daily(ev).select("event_date", "dau", "paying_users", "total_revenue")
    assert as_set(got) == want

    for length in (20, None):  # the report's steps, and all of them
        direct_funnel = spark.sql(
            f"""
            WITH ml AS (SELECT user_id, max(level_id) AS m FROM me_prop WHERE user_id IS NOT NULL GROUP BY 1),
                 l AS (SELECT explode(sequence(1, {length or "(SELECT max(m) FROM ml)"})) AS id)
            SELECT l.id AS level, CAST(COUNT(ml.user_id) AS BIGINT) AS users
            FROM l LEFT JOIN ml ON ml.m >= l.id GROUP BY 1"""
        )
        got = progression.level_funnel(ev, length).select("level", "users")
        assert as_set(got) == as_set(direct_funnel)


@pytest.mark.parametrize("seed", [4, 5])
def test_stickiness_window_form_equals_join_form(spark, seed):
    rows = random_events(seed)
    # spread over two months so the month boundary is exercised
    rows = [r[:3] + ((r[3] + dt.timedelta(days=25)) if (r[3] and r[0] % 2) else r[3],) + r[4:] for r in rows]
    ev = spark.createDataFrame(rows, MASTER_SCHEMA).where("event_name = 'session_start'")
    ev.createOrReplaceTempView("me_stick")
    direct = spark.sql(
        """
        WITH d AS (SELECT event_date AS date, COUNT(DISTINCT user_pseudo_id) AS dau FROM me_stick GROUP BY 1),
             m AS (SELECT trunc(event_date, 'MM') AS month_start, COUNT(DISTINCT user_pseudo_id) AS mau FROM me_stick GROUP BY 1)
        SELECT d.date, d.dau, m.mau FROM d LEFT JOIN m ON trunc(d.date, 'MM') = m.month_start"""
    )
    from questlog.operators import engagement

    got = engagement.engagement(ev).select("date", "dau", "mau")
    assert as_set(got) == as_set(direct)


def test_invariants_on_driver_tables(spark):
    t = DriverTables(spark, SF_SMALL)
    me = t.master_events()
    diff = difficulty.difficulty(me).collect()
    assert all(r["wins"] + r["fails"] == r["total_attempts"] for r in diff)
    funnel = [r["users"] for r in progression.level_funnel(me).collect()]
    assert all(a >= b for a, b in zip(funnel, funnel[1:]))
    ret = retention.retention(me).collect()
    assert all(max(r["d1_retention"], r["d3_retention"], r["d7_retention"]) <= r["cohort_size"] for r in ret)
    users = audience.user_revenue(t.user_acquisition(), t.iap(), t.ads())
    assert sum(r["users"] for r in audience.tier_distribution(users).collect()) == users.count()
    curve = QUERIES["ltv_curve"](spark, SF_SMALL).collect()
    by_tier: dict[str, list] = {}
    for r in curve:
        by_tier.setdefault(r["tier"], []).append(r)
    for rows in by_tier.values():
        rows.sort(key=lambda r: r["day_diff"])
        assert [r["day_diff"] for r in rows] == list(range(31))
        assert all(a["ltv"] <= b["ltv"] for a, b in zip(rows, rows[1:]))


def test_wallet_split_equals_single_window(spark):
    ev = spark.createDataFrame(random_events(7, 600), MASTER_SCHEMA)
    from questlog.operators import economy
    from pyspark.sql import Window

    sinks = {"level_fail": 10}
    split = economy.wallet_balance(ev, sinks=sinks, ranges=5)
    src, snk = economy._signed_amount(economy.DEFAULT_SOURCES, sinks)
    w = Window.partitionBy("user_id").orderBy("event_ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    # one window per user, ordered by the same keys (NULL times first)
    single = ev.select("user_id", "event_id", "event_ts", (src - snk).alias("delta")).select(
        "user_id", "event_id", "delta", F.sum("delta").over(w).alias("balance")
    )
    assert as_set(split.select("user_id", "event_id", "delta", "balance")) == as_set(single)
