"""Hand-made goldens for the KPI queries (expected values worked out by hand)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from conftest import d, ev_row
from questlog.operators import difficulty, economy, engagement, monetization, retention


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_retention_counts_with_null_users(master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "session_start"),
            ev_row(2, "a", "2025-11-02", "session_start"),
            ev_row(3, "a", "2025-11-02", "level_complete"),  # same day twice: counted once
            ev_row(4, "a", "2025-11-08", "session_start"),
            ev_row(5, "b", "2025-11-01", "session_start"),
            ev_row(6, "b", "2025-11-04", "session_start"),
            ev_row(7, "c", "2025-11-02", "session_start"),
            ev_row(8, "c", "2025-11-03", "session_start"),
            ev_row(9, None, "2025-11-05", "session_start"),  # NULL user: own cohort of size 0
            ev_row(10, "e", None, "session_start"),  # user with only NULL dates
        ]
    )
    got = rows(retention.retention(ev))
    assert got == [
        (d("2025-11-05"), 0, 0, 0, 0),
        (d("2025-11-02"), 1, 1, 0, 0),
        (d("2025-11-01"), 2, 1, 1, 1),
        (None, 1, 0, 0, 0),
    ]


def test_retention_rates_null_until_old_enough(master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "session_start"),
            ev_row(2, "a", "2025-11-02", "session_start"),
            ev_row(3, "b", "2025-11-01", "session_start"),
            ev_row(4, "c", "2025-11-05", "session_start"),
            ev_row(5, "c", "2025-11-08", "session_start"),
        ]
    )
    got = {r["cohort_date"]: r for r in retention.retention_rates(ev, days=(1, 7, 30)).collect()}
    # last date 2025-11-08: cohort 11-01 is 7 days old, 11-05 only 3
    assert got[d("2025-11-01")]["d1_retention_rate"] == 0.5
    assert got[d("2025-11-01")]["d7_retention_rate"] == 0.0
    assert got[d("2025-11-01")]["d30_retention_rate"] is None
    assert got[d("2025-11-05")]["d1_retention_rate"] == 0.0
    assert got[d("2025-11-05")]["d7_retention_rate"] is None


def test_retention_matrix(master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "session_start"),
            ev_row(2, "a", "2025-11-03", "session_start"),
            ev_row(3, "b", "2025-11-01", "session_start"),
            ev_row(4, "b", "2025-11-03", "session_start"),
            ev_row(5, "c", "2025-11-01", "session_start"),
        ]
    )
    got = rows(retention.retention_matrix(ev))
    assert got == [(d("2025-11-01"), 0, 3, 1.0), (d("2025-11-01"), 2, 2, 0.6667)]


def test_economy_by_level_rounding_and_nulls(master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "level_complete", level=1, gold=100),
            ev_row(2, "a", "2025-11-01", "level_complete", level=1, gold=151),
            ev_row(3, "b", "2025-11-01", "level_complete", level=1, gold=50),
            ev_row(4, "b", "2025-11-01", "level_complete", level=None, gold=999),  # no level: dropped
            ev_row(5, "b", "2025-11-01", "level_fail", level=1),  # not a completion
        ]
    )
    got = rows(economy.economy_by_level(ev))
    # avg = 301/3 = 100.33 -> 100; per user = 301/2 = 150.5 -> 151 (half up)
    assert got == [(1, 2, 301, 100.0, 151.0)]


def test_difficulty_curve(master_df):
    ev = master_df(
        [ev_row(i, "u", "2025-11-01", "level_complete", level=3, status="Win") for i in range(2)]
        + [ev_row(10 + i, "u", "2025-11-01", "level_fail", level=3, status="Fail") for i in range(6)]
        + [ev_row(20, "u", "2025-11-01", "level_start", level=3)]  # not an attempt
    )
    got = rows(difficulty.difficulty(ev))
    # 2/8 = 0.25, 6/8 = 0.75
    assert got == [(3, 8, 2, 6, 0.25, 0.75)]
    pinch = rows(difficulty.pinch_points(ev, threshold=0.30))
    assert pinch == [(3, 8, 2, 6, 0.25)]
    assert rows(difficulty.pinch_points(ev, threshold=0.25)) == []  # strict <


def test_monetization_day_without_revenue(master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "session_start"),
            ev_row(2, "a", "2025-11-01", "iap_purchase", revenue=4.99),
            ev_row(3, "a", "2025-11-01", "iap_purchase", revenue=0.99),
            ev_row(4, "b", "2025-11-01", "session_start"),
            ev_row(5, "c", "2025-11-01", "session_start"),
            ev_row(6, None, "2025-11-01", "iap_purchase", revenue=1.00),  # NULL user: revenue counts, user does not
            ev_row(7, "a", "2025-11-02", "session_start"),
        ]
    )
    got = rows(monetization.monetization_daily(ev))
    assert got == [
        (d("2025-11-02"), 1, 0, 0.0, None, None, 0.0),
        # revenue 6.98 over 3 users = 2.3267 -> 2.327; one payer
        (d("2025-11-01"), 3, 1, 6.98, 2.327, 6.98, 0.3333),
    ]


def test_ua_roas_organic_zero_spend_sorts_last(spark, master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-02", "iap_purchase", revenue=3.00),
            ev_row(2, "a", "2025-11-03", "iap_purchase", revenue=1.00),
            ev_row(3, "c", "2025-11-03", "iap_purchase", revenue=9.99),
            ev_row(4, "z", "2025-11-03", "iap_purchase", revenue=5.00),  # installed outside the window
        ]
    )
    ua_schema = T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("install_date", T.TimestampType()),
            T.StructField("source", T.StringType()),
            T.StructField("cpi", T.DecimalType(18, 2)),
        ]
    )
    ua = spark.createDataFrame(
        [
            ("a", dt.datetime(2025, 11, 1), "Facebook Ads", Decimal("2.00")),
            ("b", dt.datetime(2025, 11, 30, 10, 0), "Facebook Ads", Decimal("2.00")),  # 10:00 on the last day: inside
            ("c", dt.datetime(2025, 11, 5), "Organic", Decimal("0.00")),
            ("z", dt.datetime(2025, 12, 1), "Facebook Ads", Decimal("2.00")),
        ],
        ua_schema,
    )
    got = rows(monetization.ua_roas(ev, ua, "2025-11-01", "2025-11-30"))
    assert got == [
        ("Facebook Ads", 2, 4.0, 4.0, 2.0, 2.0, 100.0),
        ("Organic", 1, 0.0, 9.99, 0.0, 9.99, None),
    ]


def test_engagement_two_months(spark):
    schema = "event_date string, user_pseudo_id string, event_name string"
    raw = spark.createDataFrame(
        [
            ("20251130", "a", "session_start"),
            ("20251130", "b", "session_start"),
            ("20251129", "a", "session_start"),
            ("20251201", "a", "session_start"),
            ("20251201", "a", "level_start"),
        ],
        schema,
    )
    got = rows(engagement.engagement(raw))
    assert got == [
        (d("2025-12-01"), 1, 1, 100.0),
        (d("2025-11-30"), 2, 2, 100.0),
        (d("2025-11-29"), 1, 2, 50.0),
    ]
    assert rows(engagement.mau(raw)) == [(d("2025-12-01"), 1), (d("2025-11-01"), 2)]


def test_economy_flow_and_wallet(master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "level_complete", gold=100, ts_="2025-11-01T10:00:00"),
            ev_row(2, "a", "2025-11-01", "level_fail", ts_="2025-11-01T10:05:00"),
            ev_row(3, "a", "2025-11-02", "ad_reward_claim", gold_reward=50, ts_="2025-11-02T00:10:00"),
            ev_row(4, "a", "2025-11-02", "level_fail", ts_="2025-11-02T00:10:00"),  # same time: id breaks the tie
            ev_row(5, "b", "2025-11-02", "level_fail", ts_="2025-11-02T09:00:00"),
        ]
    )
    flow = rows(economy.economy_flow(ev, sinks={"level_fail": 10}))
    assert flow == [(d("2025-11-01"), 100, 10, 90), (d("2025-11-02"), 50, 20, 30)]
    wallet = sorted(
        (r["user_id"], r["event_id"], r["balance"])
        for r in economy.wallet_balance(ev, sinks={"level_fail": 10}).collect()
    )
    assert wallet == [("a", 1, 100), ("a", 2, 90), ("a", 3, 140), ("a", 4, 130), ("b", 5, -10)]


def test_economy_flow_by_date_and_level(master_df):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "level_complete", level=1, gold=100),
            ev_row(2, "a", "2025-11-01", "level_fail", level=2),
            ev_row(3, "b", "2025-11-01", "level_complete", level=2, gold=40),
            ev_row(4, "b", "2025-11-01", "ad_reward_claim", gold_reward=50),
        ]
    )
    got = rows(economy.economy_flow(ev, sinks={"level_fail": 10}, by=("event_date", "level_id")))
    assert got == [
        (d("2025-11-01"), None, 50, 0, 50),
        (d("2025-11-01"), 1, 100, 0, 100),
        (d("2025-11-01"), 2, 40, 10, 30),
    ]
