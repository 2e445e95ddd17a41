"""Daily monetization (K09), lifetime value (K10), installs (K11) and
return on ad spend per acquisition source (K12)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, round_money
from ..schemas import IAP_PURCHASE

PURCHASE = IAP_PURCHASE


def monetization_daily(ev: DataFrame, purchase_event: str = PURCHASE) -> DataFrame:
    """Per day DAU, paying users, revenue, ARPU, ARPPU, conversion.

    Revenue is summed over every event's ``revenue``; a day without any has
    ``total_revenue`` 0 but ``arpu`` / ``arppu`` NULL (the source coalesces
    only the total). Two-level aggregation: (day, user) first, so each
    distinct count becomes a plain count and no ``Expand`` is planned; a hot
    user or a hot day is pre-aggregated map-side before either shuffle.
    """
    return daily_ratios(daily_sums(ev, purchase_event)).orderBy(F.col("event_date").desc())


def daily_sums(ev: DataFrame, purchase_event: str = PURCHASE) -> DataFrame:
    """What K09's ratios are made of: (event_date, dau, paying_users, revenue)."""
    per_user = ev.groupBy("event_date", "user_id").agg(
        F.max(F.col("event_name") == purchase_event).alias("_payer"),
        F.sum("revenue").alias("_rev"),
    )
    return per_user.groupBy("event_date").agg(
        F.count("user_id").alias("dau"),
        F.count_if(F.col("user_id").isNotNull() & F.col("_payer")).alias("paying_users"),
        F.sum("_rev").alias("revenue"),
    )


def daily_ratios(daily: DataFrame) -> DataFrame:
    """K09's columns from :func:`daily_sums`."""
    return daily.select(
        "event_date",
        "dau",
        "paying_users",
        round_money(F.coalesce(F.col("revenue"), F.lit(0))).alias("total_revenue"),
        ratio("revenue", "dau", 3, num_scale=2).alias("arpu"),
        ratio("revenue", "paying_users", 3, num_scale=2).alias("arppu"),
        ratio("paying_users", "dau", 4).alias("conversion_rate"),
    )


def user_ltv(ev: DataFrame, purchase_event: str = PURCHASE) -> DataFrame:
    """Lifetime purchase revenue per user (decimal)."""
    return (
        ev.where(F.col("event_name") == purchase_event)
        .groupBy("user_id")
        .agg(F.sum("revenue").alias("total_ltv"))
    )


def installs(ua: DataFrame, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """Users installed between ``start`` and ``end``, both inclusive.
    The install value is cast to DATE first, so an install at 10:00 on the
    last day is inside the window."""
    d = F.col("install_date").cast("date")
    return ua.where(d.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).select(
        "user_id", "source", "cpi", "install_date"
    )


def ua_roas(ev: DataFrame, ua: DataFrame, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """Per source installs, spend, revenue, mean CPI, ARPU and ROAS %.

    Revenue is aggregated per user before the join (one row per user on
    each side, so no fan-out and no key skew); the join is a shuffle join
    on user_id that AQE turns into a broadcast when one side is measured
    small. A source with zero spend has ROAS NULL and sorts last.
    """
    return ua_roas_of(user_ltv(ev), ua, start, end)


def ua_roas_of(ltv: DataFrame, ua: DataFrame, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """K12 from each user's ``total_ltv`` (one row a user)."""
    joined = installs(ua, start, end).join(ltv, "user_id", "left").select(
        "source", "user_id", F.col("cpi"), F.coalesce(F.col("total_ltv"), F.lit(0)).cast("decimal(28,2)").alias("_ltv")
    )
    agg = joined.groupBy("source").agg(
        F.count_distinct("user_id").alias("installs"),
        F.sum("cpi").alias("_spend"),
        F.sum("_ltv").alias("_rev"),
        F.count("cpi").alias("_n_cpi"),
        F.count(F.lit(1)).alias("_n"),
    )
    return agg.select(
        "source",
        "installs",
        round_money("_spend").alias("total_spend"),
        round_money("_rev").alias("total_revenue"),
        ratio("_spend", "_n_cpi", 2, num_scale=2).alias("avg_cpi"),
        ratio("_rev", "_n", 2, num_scale=2).alias("arpu"),
        ratio(F.col("_rev") * 100, "_spend", 2, num_scale=2, den_scale=2).alias("roas_percentage"),
    ).orderBy(F.col("roas_percentage").desc_nulls_last(), F.col("source"))
