"""Hot keys: one user holds a third of all rows. The skew-aware forms must
equal the naive ones exactly."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import MASTER_SCHEMA
from questlog.operators import economy, revenue
from questlog.plans.explain import physical_plan


def hot_events(n=3000, seed=11):
    rnd = random.Random(seed)
    start = dt.datetime(2025, 11, 1)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rnd.randint(0, 200)}"
        ts = start + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        name = rnd.choice(["level_complete", "level_fail", "ad_reward_claim", "iap_purchase"])
        rows.append(
            (i, user, user, ts.date(), ts, name, 1, None,
             rnd.randint(50, 200) if name == "level_complete" else None,
             50 if name == "ad_reward_claim" else None,
             Decimal("4.99") if name == "iap_purchase" else None,
             Decimal("0.05") if name == "ad_reward_claim" else None, None, None, None)
        )
    return rows


@pytest.mark.parametrize("case", ["hot user", "hot hour", "hot instant", "no user"])
def test_wallet_split_with_hot_user(spark, case):
    rows = [list(r) for r in hot_events()]
    for r in rows:
        if r[1] == "hot":
            r[4] = {"hot hour": dt.datetime(2025, 11, 1, 5, r[0] % 60), "hot instant": dt.datetime(2025, 11, 1, 5)}.get(case, r[4])
            r[1] = None if case == "no user" else r[1]
    ev = spark.createDataFrame([tuple(r) for r in rows], MASTER_SCHEMA)
    sinks = {"level_fail": 10}
    split = economy.wallet_balance(ev, sinks=sinks, ranges=12)
    plan = physical_plan(split)
    assert "_r" in plan and "Window" in plan  # windows are keyed by (user, range)
    sizes = [r["n"] for r in spark.read.parquet(split.inputFiles()[0].rsplit("/", 1)[0]).groupBy("_u", "_un", "_r").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2.5 * len(rows) / 12  # however the rows are skewed
    src, snk = economy._signed_amount(economy.DEFAULT_SOURCES, sinks)
    w = Window.partitionBy("user_id").orderBy("event_ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    single = ev.select("user_id", "event_id", (src - snk).alias("delta"), "event_ts").select(
        "user_id", "event_id", "delta", F.sum("delta").over(w).alias("balance")
    )
    got = split.select("user_id", "event_id", "delta", "balance")
    assert got.exceptAll(single).count() == 0 and single.exceptAll(got).count() == 0


def test_tier_day_preaggregation_equals_row_level(spark):
    ev = spark.createDataFrame(hot_events(), MASTER_SCHEMA)
    users = ev.select("user_id").distinct()
    ua = users.select(
        "user_id",
        F.lit(dt.date(2025, 11, 3)).alias("install_date"),
        F.when(F.col("user_id") == "hot", "Tier 1").otherwise("Tier 2").alias("tier"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("cpi"),
    )
    iap = ev.where("event_name = 'iap_purchase'").select("user_id", F.col("event_ts").alias("timestamp"), F.col("revenue").alias("price"))
    ads = ev.where("event_name = 'ad_reward_claim'").select("user_id", F.col("event_ts").alias("timestamp"), F.col("ad_revenue").alias("revenue"))
    fast = revenue.revenue_by_tier_day(iap, ads, ua)
    # row-level reference: every transaction joined, then summed
    facts = iap.select("user_id", "timestamp", F.col("price").alias("rev")).unionByName(
        ads.select("user_id", "timestamp", F.col("revenue").alias("rev"))
    )
    slow = revenue.with_day_diff(facts, ua).groupBy("tier", "day_diff").agg(F.sum("rev").alias("rev"))
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    assert fast.where("day_diff < 0").count() > 0  # transactions before install are kept


def test_tagged_facts_equal_joined_facts(spark):
    from conftest import SF_SMALL
    from questlog.operators import audience
    from questlog.sources.driver_tables import DriverTables, ad_impressions_from_master, iap_transactions_from_master

    t = DriverTables(spark, SF_SMALL)
    ua = t.user_acquisition()
    ev = audience.filter_tagged_by_tier(t.acquired_events())
    tags = ("tier", "install_date")
    iap_t, ads_t = iap_transactions_from_master(ev, tags), ad_impressions_from_master(ev, tags)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    cols = ["user_id", "tier", "day_diff", "price"]
    assert same(revenue.with_day_diff(iap_t).select(cols), revenue.with_day_diff(t.iap(), ua).select(cols))
    assert same(revenue.revenue_by_tier_day(iap_t, ads_t), revenue.revenue_by_tier_day(t.iap(), t.ads(), ua))
    assert same(revenue.ltv_curve(iap_t, ads_t, ua, tagged_facts=True), revenue.ltv_curve(t.iap(), t.ads(), ua))
    # the tagged path has no join at all
    assert "Join" not in physical_plan(revenue.with_day_diff(iap_t))


def test_tagged_tier_filter_equals_semi_join_for_a_subset(spark):
    from conftest import SF_SMALL
    from questlog.operators import audience
    from questlog.sources.driver_tables import DriverTables

    t = DriverTables(spark, SF_SMALL)
    chosen = ["Tier 2"]
    tagged = audience.filter_tagged_by_tier(t.acquired_events(), chosen).select("event_id")
    joined = audience.filter_by_tier(t.master_events(), t.user_acquisition(), chosen).select("event_id")
    assert tagged.count() > 0
    assert tagged.exceptAll(joined).count() == 0 and joined.exceptAll(tagged).count() == 0
    curve = revenue.ltv_curve(t.iap(), t.ads(), t.user_acquisition(), 30, chosen=chosen).collect()
    assert {r["tier"] for r in curve} == {"Tier 2"} and len(curve) == 31
