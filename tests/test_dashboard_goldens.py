"""Hand-made goldens for the dashboard marts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from conftest import d, ev_row
from questlog.operators import audience, progression, revenue

UA_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("install_date", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("cpi", T.DecimalType(18, 2)),
        T.StructField("tier", T.StringType()),
    ]
)
IAP_SCHEMA = "user_id string, timestamp timestamp, price decimal(18,2), pack string"
ADS_SCHEMA = "user_id string, timestamp timestamp, revenue decimal(18,2), placement string"


@pytest.fixture()
def ua(spark):
    return spark.createDataFrame(
        [
            ("a", d("2025-11-01"), "Facebook Ads", "CMP_100", Decimal("2.00"), "Tier 1"),
            ("b", d("2025-11-02"), "Organic", None, Decimal("0.00"), "Tier 1"),
            ("c", d("2025-11-03"), "Unity Ads", "CMP_101", Decimal("1.00"), "Tier 2"),
        ],
        UA_SCHEMA,
    )


@pytest.fixture()
def iap(spark):
    t = dt.datetime
    return spark.createDataFrame(
        [
            ("a", t(2025, 11, 1, 9), Decimal("4.99"), "pack_gem_4"),
            ("a", t(2025, 10, 31, 23), Decimal("0.99"), "pack_gem_0"),  # an hour before install: day -1
            ("a", t(2025, 12, 5, 1), Decimal("9.99"), "pack_gem_9"),  # day 34: outside the curve
            ("c", t(2025, 11, 4, 12), Decimal("0.99"), "pack_gem_0"),
            ("x", t(2025, 11, 4, 12), Decimal("100.00"), "pack_gem_9"),  # not an acquired user
        ],
        IAP_SCHEMA,
    )


@pytest.fixture()
def ads(spark):
    t = dt.datetime
    return spark.createDataFrame(
        [
            ("b", t(2025, 11, 2, 8), Decimal("0.05"), "End Game"),
            ("b", t(2025, 11, 3, 8), Decimal("0.05"), "End Game"),
            ("a", t(2025, 11, 2, 8), Decimal("0.10"), "Shop"),
        ],
        ADS_SCHEMA,
    )


def test_user_revenue_fills_only_revenue(ua, iap, ads):
    users = {r["user_id"]: r for r in audience.user_revenue(ua, iap, ads).collect()}
    assert set(users) == {"a", "b", "c"}  # x has no acquisition row: dropped
    assert users["a"]["iap_rev"] == Decimal("15.97") and users["a"]["ads_rev"] == Decimal("0.10")
    assert users["a"]["total_revenue"] == Decimal("16.07")
    assert users["b"]["iap_rev"] == Decimal("0.00") and users["b"]["ads_rev"] == Decimal("0.10")
    assert users["b"]["campaign_id"] is None  # not filled with 0
    assert users["c"]["ads_rev"] == Decimal("0.00")


def test_tiers_filter_and_distribution(ua, iap, ads):
    assert [r[0] for r in audience.tiers(ua).collect()] == ["Tier 1", "Tier 2"]
    only_t2 = audience.filter_by_tier(iap, ua, ["Tier 2"])
    assert sorted(r["user_id"] for r in only_t2.collect()) == ["c"]
    everyone = audience.filter_by_tier(iap, ua)
    assert sorted(r["user_id"] for r in everyone.collect()) == ["a", "a", "a", "c"]
    users = audience.user_revenue(ua, iap, ads)
    assert [tuple(r) for r in audience.tier_distribution(users).collect()] == [("Tier 1", 2), ("Tier 2", 1)]
    assert tuple(audience.reporting_period(ua).first()) == (d("2025-11-01"), d("2025-11-03"))


def test_headline_and_payer_kpis(master_df, ua, iap, ads):
    ev = master_df(
        [
            ev_row(1, "a", "2025-11-01", "session_start", duration=120.0),
            ev_row(2, "b", "2025-11-01", "session_start", duration=60.0),
            ev_row(3, "a", "2025-11-02", "session_start", duration=30.0),
        ]
    )
    users = audience.user_revenue(ua, iap, ads)
    k = audience.headline_kpis(ev, users, ads).first().asDict()
    # DAU 2 and 1 -> mean 1.5 -> 1; revenue 16.07 + 0.10 + 0.99 = 17.16 over 3 users
    assert k == {
        "avg_dau": 1,
        "total_revenue": 17.16,
        "arpu": 5.72,
        "avg_session_minutes": 1.1667,
        "ads_views_per_user": 1.0,
    }
    p = revenue.payer_kpis(users).first().asDict()
    # payers a (15.97) and c (0.99): ARPPU 8.48; CPI (2 + 0 + 1) / 3; ads 0.20 / 17.16
    assert p == {"paying_users": 2, "payer_share": 0.6667, "arppu": 8.48, "avg_cpi": 1.0, "ads_revenue_share": 0.0117}


def test_funnel_churn_outcomes(master_df):
    rows = []
    eid = 0
    # user a reaches level 25 (above the funnel's last step), b level 2, c level 1, d none
    for user, top in (("a", 25), ("b", 2), ("c", 1)):
        for lvl in range(1, top + 1):
            eid += 1
            rows.append(ev_row(eid, user, "2025-11-01", "level_complete", level=lvl, status="Win"))
    rows.append(ev_row(999, "b", "2025-11-01", "level_fail", level=2, status="Fail"))
    rows.append(ev_row(1000, "d", "2025-11-01", "session_start"))
    ev = master_df(rows)
    funnel = progression.level_funnel(ev, max_level=20).collect()
    assert [r["users"] for r in funnel] == [3, 2] + [1] * 18
    assert funnel[0]["pct_previous"] is None and funnel[1]["pct_previous"] == 66.67 and funnel[2]["pct_previous"] == 50.0
    assert funnel[4]["level_label"] == "Lvl 5"
    churn = [tuple(r) for r in progression.churn_levels(ev, n=10).collect()]
    assert churn == [(1, 1), (2, 1), (25, 1)]
    outcomes = [tuple(r) for r in progression.level_outcomes(ev, n=3).collect()]
    assert outcomes == [(1, 3, 0), (2, 2, 1), (3, 1, 0)]
    assert {r["user_id"]: r["max_level"] for r in progression.user_max_level(ev).collect()}["d"] is None


def test_day_diff_and_ltv_curve(ua, iap, ads):
    dd = {(r["user_id"], r["price"]): r["day_diff"] for r in revenue.with_day_diff(iap, ua).collect()}
    assert dd[("a", Decimal("0.99"))] == -1  # an hour before install
    assert dd[("a", Decimal("4.99"))] == 0
    assert dd[("a", Decimal("9.99"))] == 34
    assert dd[("c", Decimal("0.99"))] == 1
    curve = revenue.ltv_curve(iap, ads, ua, max_day=30).collect()
    assert len(curve) == 2 * 31
    t1 = [r for r in curve if r["tier"] == "Tier 1"]
    # Tier 1 (a, b): day 0: 4.99 (a) + 0.05 (b, installed 11-02); day 1: 0.10 (a) + 0.05 (b)
    assert (t1[0]["rev"], t1[1]["rev"], t1[2]["rev"]) == (5.04, 0.15, 0.0)
    assert t1[30]["cumulative_rev"] == 5.19 and t1[30]["ltv"] == 2.595
    assert all(x["cumulative_rev"] <= y["cumulative_rev"] for x, y in zip(t1, t1[1:]))
    assert t1[0]["avg_cpi"] == 1.0
    packs = [tuple(r) for r in revenue.revenue_by_pack(iap).collect()]
    assert packs[0] == ("pack_gem_9", 109.99)
    places = [tuple(r) for r in revenue.revenue_by_placement(ads).collect()]
    assert places == [("End Game", 0.1), ("Shop", 0.1)]
