"""Dashboard marts over the user table: revenue master, tiers, tier filter,
reporting period and headline KPIs (D01-D08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, round_money
from ..schemas import AD_REWARD_CLAIM, IAP_PURCHASE
from .engagement import daily_users


def revenue_by_user(fact: DataFrame, amount: str, alias: str | None = None) -> DataFrame:
    """Summed ``amount`` per user (NULL users dropped, as in pandas)."""
    return (
        fact.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.sum(amount).alias(alias or amount))
    )


def user_revenue(ua: DataFrame, iap: DataFrame, ads: DataFrame) -> DataFrame:
    """Every acquisition row with its IAP and ads revenue (0 when
    none) and their total.

    Both facts are unioned into one narrow frame and aggregated once per
    user, so there is one aggregate and one join instead of two of each.
    Only the revenue columns are filled with 0 (an organic user's NULL
    campaign stays NULL).
    """
    zero = F.lit(0).cast("decimal(18,2)")
    facts = iap.select("user_id", F.col("price").cast("decimal(18,2)").alias("_iap"), zero.alias("_ads")).unionByName(
        ads.select("user_id", zero.alias("_iap"), F.col("revenue").cast("decimal(18,2)").alias("_ads"))
    )
    per_user = (
        facts.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.sum("_iap").alias("iap_rev"), F.sum("_ads").alias("ads_rev"))
    )
    return with_revenue(ua, per_user)


def user_revenue_from_events(ua: DataFrame, ev: DataFrame) -> DataFrame:
    """D02 from the event table: both revenues in one scan and one aggregate
    (D01 for each event kind), then one join with the users."""
    iap, ads = F.col("event_name") == IAP_PURCHASE, F.col("event_name") == AD_REWARD_CLAIM
    facts = ev.where(iap | ads).select(
        "user_id", F.when(iap, F.col("revenue")).alias("_iap"), F.when(ads, F.col("ad_revenue")).alias("_ads")
    )
    per_user = (
        facts.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.sum("_iap").alias("iap_rev"), F.sum("_ads").alias("ads_rev"))
    )
    return with_revenue(ua, per_user)


def with_revenue(ua: DataFrame, per_user: DataFrame) -> DataFrame:
    """D02 from each user's ``iap_rev`` and ``ads_rev`` (one row a user)."""
    joined = ua.join(per_user, "user_id", "left")
    iap_rev = F.coalesce(F.col("iap_rev"), F.lit(0)).cast("decimal(28,2)")
    ads_rev = F.coalesce(F.col("ads_rev"), F.lit(0)).cast("decimal(28,2)")
    return joined.select(
        *[F.col(c) for c in ua.columns],
        iap_rev.alias("iap_rev"),
        ads_rev.alias("ads_rev"),
        (iap_rev + ads_rev).alias("total_revenue"),
    )


def user_revenue_report(users: DataFrame) -> DataFrame:
    """D02 as a report: money as doubles."""
    return users.select(
        *[c for c in users.columns if c not in ("cpi", "iap_rev", "ads_rev", "total_revenue")],
        *[round_money(c).alias(c) for c in ("cpi", "iap_rev", "ads_rev", "total_revenue")],
    )


def tiers(ua: DataFrame) -> DataFrame:
    """Distinct tiers."""
    return ua.select("tier").where(F.col("tier").isNotNull()).distinct().orderBy("tier")


def filter_by_tier(facts: DataFrame, ua: DataFrame, chosen: Sequence[str] | None = None) -> DataFrame:
    """Facts of the users in the chosen tiers (all tiers when None).

    A left-semi join against the user table, not an id list collected to
    the driver: no row of either side passes through the driver, and the
    fact side is never multiplied. With all tiers chosen, facts of users
    absent from the acquisition table are still dropped, as in the source.
    """
    users = ua.where(F.col("user_id").isNotNull())
    if chosen is not None:
        users = users.where(F.col("tier").isin(list(chosen)))
    return facts.join(users.select("user_id"), "user_id", "left_semi")


def filter_tagged_by_tier(facts: DataFrame, chosen: Sequence[str] | None = None) -> DataFrame:
    """D04 on facts already tagged with ``tier`` and ``in_ua`` (the staged
    acquired-events table): the same rows as :func:`filter_by_tier`, as a
    plain filter that reaches the Parquet scan, with no join per query."""
    keep = F.col("in_ua")
    if chosen is not None:
        keep = keep & F.col("tier").isin(list(chosen))
    return facts.where(keep)


def reporting_period(ua: DataFrame) -> DataFrame:
    """First and last install date."""
    d = F.col("install_date").cast("date")
    return ua.agg(F.min(d).alias("period_start"), F.max(d).alias("period_end"))


def tier_distribution(users: DataFrame) -> DataFrame:
    """Users per tier, largest first."""
    return (
        users.where(F.col("tier").isNotNull())
        .groupBy("tier")
        .agg(F.count(F.lit(1)).alias("users"))
        .orderBy(F.col("users").desc(), F.col("tier"))
    )


def headline_kpis(ev: DataFrame, users: DataFrame, ads: DataFrame, digits: int = 4) -> DataFrame:
    """One row: mean DAU (truncated to int), total revenue, lifetime
    ARPU (0 without users), mean session minutes and ad views per user.

    The inputs have different grains, so each contributes its rows to one
    union of narrow, mostly-NULL columns and a single global aggregate
    computes every figure (partial aggregation per partition; no join).
    """
    dbl = F.lit(None).cast("double")
    dec = F.lit(None).cast("decimal(28,2)")
    lng = F.lit(None).cast("long")
    daily = daily_users(ev).select(
        F.col("dau").cast("double").alias("dau"), dec.alias("rev"), lng.alias("usr"), dec.alias("dur"), lng.alias("ad")
    )
    user_rows = users.select(
        dbl.alias("dau"),
        F.col("total_revenue").cast("decimal(28,2)").alias("rev"),
        F.lit(1).cast("long").alias("usr"),
        dec.alias("dur"),
        lng.alias("ad"),
    )
    sessions = ev.where(F.col("duration").isNotNull()).select(
        dbl.alias("dau"), dec.alias("rev"), lng.alias("usr"), F.col("duration").cast("decimal(28,2)").alias("dur"), lng.alias("ad")
    )
    ad_rows = ads.select(dbl.alias("dau"), dec.alias("rev"), lng.alias("usr"), dec.alias("dur"), F.lit(1).cast("long").alias("ad"))
    agg = (
        daily.unionByName(user_rows)
        .unionByName(sessions)
        .unionByName(ad_rows)
        .agg(
            F.avg("dau").alias("_avg_dau"),
            F.sum("rev").alias("_rev"),
            F.coalesce(F.sum("usr"), F.lit(0)).alias("_users"),
            F.sum("dur").alias("_dur"),
            F.count("dur").alias("_n_dur"),
            F.coalesce(F.sum("ad"), F.lit(0)).alias("_ads"),
        )
    )
    return agg.select(
        F.col("_avg_dau").cast("int").alias("avg_dau"),
        round_money(F.coalesce(F.col("_rev"), F.lit(0))).alias("total_revenue"),
        F.when(F.col("_users") > 0, ratio("_rev", "_users", digits, num_scale=2)).otherwise(F.lit(0.0)).alias("arpu"),
        ratio("_dur", F.col("_n_dur") * 60, digits, num_scale=2).alias("avg_session_minutes"),
        ratio("_ads", "_users", digits).alias("ads_views_per_user"),
    )


def headline_kpis_from_events(ev: DataFrame, ua: DataFrame, digits: int = 4) -> DataFrame:
    """D07 from the tagged events of the users in ``ua``, in one scan.

    Rows are first combined per (day, user), which carries everything the five
    figures need; days are counted on top of that, and the number of users
    joins as one more row of the final aggregate.
    """
    iap, ads = F.col("event_name") == IAP_PURCHASE, F.col("event_name") == AD_REWARD_CLAIM
    money = F.when(iap, F.col("revenue")).when(ads, F.col("ad_revenue"))
    per_user_day = ev.groupBy("event_date", "user_id").agg(
        F.sum(money).alias("rev"),
        F.sum(F.col("duration").cast("decimal(28,2)")).alias("dur"),
        F.count("duration").alias("n_dur"),
        F.count_if(ads).alias("ad"),
    )
    daily = per_user_day.groupBy("event_date").agg(
        F.count("user_id").alias("pairs"), F.sum("rev").alias("rev"), F.sum("dur").alias("dur"),
        F.sum("n_dur").alias("n_dur"), F.sum("ad").alias("ad"),
    )
    dated = F.col("event_date").isNotNull()
    days = daily.select(
        F.when(dated, F.col("pairs")).alias("dau"), F.col("rev").cast("decimal(28,2)").alias("rev"),
        F.col("dur").cast("decimal(28,2)").alias("dur"), "n_dur", "ad", F.lit(0).cast("long").alias("users"),
    )
    none = {c: F.lit(None).cast(days.schema[c].dataType).alias(c) for c in ("dau", "rev", "dur", "n_dur", "ad")}
    users = ua.agg(F.count(F.lit(1)).alias("users")).select(*none.values(), "users")
    agg = days.unionByName(users).agg(
        F.avg("dau").alias("_avg_dau"),
        F.coalesce(F.sum("rev"), F.lit(0)).alias("_rev"),
        F.sum("users").alias("_users"),
        F.sum("dur").alias("_dur"),
        F.coalesce(F.sum("n_dur"), F.lit(0)).alias("_n_dur"),
        F.coalesce(F.sum("ad"), F.lit(0)).alias("_ads"),
    )
    return agg.select(
        F.col("_avg_dau").cast("int").alias("avg_dau"),
        round_money("_rev").alias("total_revenue"),
        F.when(F.col("_users") > 0, ratio("_rev", "_users", digits, num_scale=2)).otherwise(F.lit(0.0)).alias("arpu"),
        ratio("_dur", F.col("_n_dur") * 60, digits, num_scale=2).alias("avg_session_minutes"),
        ratio("_ads", "_users", digits).alias("ads_views_per_user"),
    )
