"""Tables bucketed by user (joins without a shuffle), and CSV headers found by a job."""

from __future__ import annotations

import datetime as dt
import gzip

import pytest

from conftest import SF_SMALL
from questlog.operators import audience, monetization, revenue, rollups
from questlog.plans import warehouse
from questlog.plans.explain import physical_plan
from questlog.schemas import AD_REWARD_CLAIM, IAP_PURCHASE
from questlog.sources.bucketed import append_bucketed, read_bucketed
from questlog.sources.readers import header_groups, read_iap

EVENTS = "user_id long, event_ts timestamp, event_name string, revenue decimal(18,2), ad_revenue decimal(18,2)"
USERS = "user_id long, install_date date, source string, campaign_id string, cpi decimal(18,2), tier string"


@pytest.mark.parametrize("query", ["bucketed_ua_roas", "bucketed_user_revenue", "bucketed_revenue_by_tier_day"])
def test_no_exchange_below_the_join(spark, query):
    own = spark.newSession()
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        own.conf.set(name, "-1")
    plan = physical_plan(warehouse.WAREHOUSE_QUERIES[query](own, SF_SMALL))
    below = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in below and below.count("Bucketed: true") == 2


def test_days_are_appended_and_equal_the_facts(spark, tmp_path):
    from decimal import Decimal as D

    ua = spark.createDataFrame(
        [(u, dt.date(2024, 1, 1 + u % 3), f"s{u % 2}", None, D(u), f"Tier {u % 2}" if u % 5 else None) for u in range(20)], USERS
    )
    # user 3 holds most events; some have no user, no amount or no acquisition row
    rows = [(3, dt.datetime(2024, 1, 1 + i % 4, 23, 59), IAP_PURCHASE, D(1), None) for i in range(500)]
    rows += [(i % 25, dt.datetime(2024, 1, 1 + i % 4, 0, 1), AD_REWARD_CLAIM if i % 3 else IAP_PURCHASE, D(i), D(2 * i) if i % 7 else None) for i in range(100)]
    rows += [(None, dt.datetime(2024, 1, 2), IAP_PURCHASE, D(9), None), (4, dt.datetime(2024, 1, 2), IAP_PURCHASE, None, None), (5, None, AD_REWARD_CLAIM, None, D(1))]
    ev = spark.createDataFrame(rows, EVENTS)
    state = rollups.user_day_revenue(ev)
    days = str(tmp_path / "days")
    append_bucketed(spark, state.where("day < DATE'2024-01-03' OR day IS NULL"), days, "user_id", 4)
    for day in (3, 4):
        append_bucketed(spark, state.where(f"day = DATE'2024-01-0{day}'"), days, "user_id", 4)
    users = str(tmp_path / "users")
    append_bucketed(spark, ua, users, "user_id", 4)
    got, who = read_bucketed(spark, state, days, "user_id", 4), read_bucketed(spark, ua, users, "user_id", 4)
    assert got.where("user_id = 3").count() == 4  # a hot user is a row a day
    same = lambda a, b: sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert same(got, state)
    iap = ev.where(f"event_name = '{IAP_PURCHASE}'").selectExpr("user_id", "event_ts AS timestamp", "revenue AS price")
    ads = ev.where(f"event_name = '{AD_REWARD_CLAIM}'").selectExpr("user_id", "event_ts AS timestamp", "ad_revenue AS revenue")
    assert same(rollups.user_revenue_of(got, who), audience.user_revenue_from_events(ua, ev))
    assert same(rollups.tier_day_revenue_of(got, who), revenue.revenue_by_tier_day(iap, ads, ua))
    window = ("2024-01-01", "2024-01-30")
    assert same(monetization.ua_roas_of(rollups.ltv_of(got), who, *window), monetization.ua_roas(ev, ua, *window))
    none = state.where("false")
    append_bucketed(spark, none, str(tmp_path / "none"), "user_id", 4)
    empty = read_bucketed(spark, none, str(tmp_path / "none"), "user_id", 4)
    assert rollups.tier_day_revenue_of(empty, who).collect() == [] and rollups.user_revenue_of(empty, who).count() == 20


def test_headers_are_found_by_a_job(spark, tmp_path):
    folder = tmp_path / "iap of [2024]"
    (folder / "a").mkdir(parents=True)
    (folder / "a" / "1.csv").write_text("user_id,price\nu1,1.50\n")
    (folder / "a" / "2 b.csv").write_text("﻿price,user_id,timestamp\n2,u2,2024-01-01 00:00:00\n")
    (folder / "3.csv").write_text("user_id,price\n" + "u3,3\n" * 2000)
    (folder / "4.csv").write_text("")
    (folder / "5.csv").write_text("user_id,price\n")
    (folder / "_6.csv").write_text("user_id\nhidden\n")
    with gzip.open(folder / "7.csv.gz", "wt") as f:
        f.write("user_id,price\nu7,7\n")
    from questlog.sources.readers import glob_free

    groups = header_groups(spark, glob_free(str(folder)))
    assert sorted((h, len(f)) for h, f in groups.items()) == [("price,user_id,timestamp", 1), ("user_id,price", 4)]
    got = {r.user_id: (float(r.n), float(r.price)) for r in read_iap(spark, glob_free(str(folder))).groupBy("user_id").agg({"price": "max", "*": "count"}).toDF("user_id", "price", "n").collect()}
    assert got == {"u1": (1, 1.5), "u2": (1, 2.0), "u3": (2000, 3.0), "u7": (1, 7.0)}
