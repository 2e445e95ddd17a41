"""Monetization marts of the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import floored_days_since
from ..functions.numeric import ratio, round_money
from ..schemas import AD_REWARD_CLAIM, IAP_PURCHASE


def payer_kpis(users: DataFrame, digits: int = 4) -> DataFrame:
    """Payers (IAP revenue > 0), their share of users, ARPPU (mean IAP
    revenue of payers), mean CPI over all users (organic zeros included)
    and the ads share of total revenue. One global aggregate."""
    payer = F.col("iap_rev") > 0
    agg = users.agg(
        F.count_if(payer).alias("paying_users"),
        F.count(F.lit(1)).alias("_users"),
        F.sum(F.when(payer, F.col("iap_rev"))).alias("_payer_rev"),
        F.sum("cpi").alias("_cpi"),
        F.count("cpi").alias("_n_cpi"),
        F.sum("ads_rev").alias("_ads"),
        F.sum("total_revenue").alias("_total"),
    )
    return agg.select(
        "paying_users",
        ratio("paying_users", "_users", digits).alias("payer_share"),
        ratio("_payer_rev", "paying_users", digits, num_scale=2).alias("arppu"),
        ratio("_cpi", "_n_cpi", digits, num_scale=2).alias("avg_cpi"),
        ratio("_ads", "_total", digits, num_scale=2, den_scale=2).alias("ads_revenue_share"),
    )


def with_day_diff(fact: DataFrame, ua: DataFrame | None = None, ts: str = "timestamp") -> DataFrame:
    """Each transaction with its user's tier and whole days since
    install (floored; negative before install).

    With ``ua``: an inner join on user_id (a shuffle join whose hot-user
    partitions AQE splits). Without: ``fact`` already carries ``tier`` and
    ``install_date`` (the staged tagged events) and no join is needed.
    """
    joined = fact if ua is None else fact.join(ua.select("user_id", "install_date", "tier"), "user_id", "inner")
    return joined.withColumn("day_diff", floored_days_since(F.col(ts), F.col("install_date")))


def revenue_facts(ev: DataFrame) -> DataFrame:
    """(user_id, timestamp, rev, tier, install_date) of the purchases and ad
    views among tagged events, in one scan."""
    iap, ads = F.col("event_name") == IAP_PURCHASE, F.col("event_name") == AD_REWARD_CLAIM
    return ev.where(iap | ads).select(
        "user_id", F.col("event_ts").alias("timestamp"),
        F.when(iap, F.col("revenue")).otherwise(F.col("ad_revenue")).cast("decimal(18,2)").alias("rev"), "tier", "install_date",
    )


def revenue_by_tier_day(iap: DataFrame, ads: DataFrame, ua: DataFrame | None = None) -> DataFrame:
    """IAP and ads revenue per (tier, day since install).

    Facts tagged with ``tier`` / ``install_date`` (``ua`` None) are summed
    directly: one aggregate, no join. Otherwise the facts are unioned and first
    summed per (user, whole day since the install's time of day): the sum is
    combined map-side, so even a user holding a large share of all transactions
    reaches the join as at most a few rows per active day, and the join with
    the user table is never skewed.
    """
    tags = ("tier", "install_date") if ua is None else ()
    facts = iap.select("user_id", "timestamp", F.col("price").cast("decimal(18,2)").alias("rev"), *tags).unionByName(
        ads.select("user_id", "timestamp", F.col("revenue").cast("decimal(18,2)").alias("rev"), *tags)
    )
    if ua is None:
        return tier_day_sums(with_day_diff(facts))
    users = ua.select("user_id", "install_date", "tier")
    if isinstance(ua.schema["install_date"].dataType, T.DateType):
        part = F.to_date(F.col("timestamp").cast("timestamp"))
    else:  # installs have a time of day: the same instant is the finest unit that gives exact days
        part = F.col("timestamp").cast("timestamp")
    summed = (
        facts.where(F.col("user_id").isNotNull()).groupBy("user_id", part.alias("timestamp")).agg(F.sum("rev").alias("rev"))
    )
    return tier_day_sums(with_day_diff(summed, users))


def tier_day_sums(dated: DataFrame) -> DataFrame:
    return (
        dated.where(F.col("tier").isNotNull() & F.col("day_diff").isNotNull())
        .groupBy("tier", "day_diff")
        .agg(F.sum("rev").alias("rev"))
    )


def revenue_outside_days(by_tier_day: DataFrame, max_day: int = 30) -> DataFrame:
    """What an LTV curve of days 0 to ``max_day`` leaves out: revenue per tier
    before the install and after the last day."""
    d = F.col("day_diff")
    outside = by_tier_day.groupBy("tier").agg(
        F.sum(F.when(d < 0, F.col("rev"))).alias("before"), F.sum(F.when(d > max_day, F.col("rev"))).alias("after")
    )
    zero = F.lit(0).cast("decimal(28,2)")
    return outside.select(
        "tier", round_money(F.coalesce("before", zero)).alias("before_install"), round_money(F.coalesce("after", zero)).alias("after_last_day")
    )


def ltv_curve(
    iap: DataFrame,
    ads: DataFrame,
    ua: DataFrame,
    max_day: int | None = None,
    chosen: Sequence[str] | None = None,
    digits: int = 4,
    tagged_facts: bool = False,
) -> DataFrame:
    """D17 from purchase and ad-view facts (see :func:`ltv_curve_of`).
    ``tagged_facts``: they carry ``tier`` and ``install_date``, so no
    fact-to-user join is needed."""
    return ltv_curve_of(revenue_by_tier_day(iap, ads, None if tagged_facts else ua), ua, max_day, chosen, digits)


def ltv_curve_of(
    by_tier_day: DataFrame,
    ua: DataFrame,
    max_day: int | None = None,
    chosen: Sequence[str] | None = None,
    digits: int = 4,
) -> DataFrame:
    """Per tier and day from 0 to the last day with revenue (or to the
    report's ``max_day``): revenue of that day (0 when none), cumulative
    revenue, cumulative revenue per user of the tier (LTV) and the tier's mean
    CPI. :func:`revenue_outside_days` tells what a shorter curve leaves out.

    The day spine is generated per tier with ``explode(sequence(...))`` (a
    generator on the tier rows, not a join), left-joined to the aggregated
    revenue; the running sum is a window over one row per tier and day.
    ``ua`` gives the tier's user count and mean CPI.
    """
    tiers = ua.where(F.col("tier").isNotNull())
    if chosen is not None:
        tiers = tiers.where(F.col("tier").isin(list(chosen)))
    stats = tiers.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("cpi").alias("_cpi"), F.count("cpi").alias("_n_cpi")
    )
    rev = by_tier_day.where("day_diff >= 0")
    if max_day is None:  # one more aggregate, of the summed rows only
        last = rev.groupBy("tier").agg(F.max("day_diff").alias("last"))
        stats = stats.join(last, "tier", "left").withColumn("last", F.coalesce("last", F.lit(0)))
    else:
        stats = stats.withColumn("last", F.lit(max_day))
        rev = rev.where(F.col("day_diff") <= max_day)
    spine = stats.select(
        "tier", "n_users", "_cpi", "_n_cpi", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("day_diff")
    )
    curve = spine.join(rev, ["tier", "day_diff"], "left").withColumn(
        "rev", F.coalesce(F.col("rev"), F.lit(0)).cast("decimal(28,2)")
    )
    running = Window.partitionBy("tier").orderBy("day_diff").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = curve.withColumn("_cum", F.sum("rev").over(running))
    return curve.select(
        "tier",
        "day_diff",
        round_money("rev").alias("rev"),
        round_money("_cum").alias("cumulative_rev"),
        ratio("_cum", "n_users", digits, num_scale=2).alias("ltv"),
        ratio("_cpi", "_n_cpi", digits, num_scale=2).alias("avg_cpi"),
    ).orderBy("tier", "day_diff")


def revenue_by_pack(iap: DataFrame) -> DataFrame:
    """IAP revenue per pack, largest first."""
    return (
        iap.where(F.col("pack").isNotNull())
        .groupBy("pack")
        .agg(F.sum("price").alias("_rev"))
        .select("pack", round_money("_rev").alias("revenue"))
        .orderBy(F.col("revenue").desc(), F.col("pack"))
    )


def revenue_by_placement(ads: DataFrame) -> DataFrame:
    """Ads revenue per placement."""
    return (
        ads.where(F.col("placement").isNotNull())
        .groupBy("placement")
        .agg(F.sum("revenue").alias("_rev"))
        .select("placement", round_money("_rev").alias("revenue"))
        .orderBy("placement")
    )
