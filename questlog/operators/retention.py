"""Cohort retention.

Shape of the plan: ``distinct(user, date)`` (map-side combine, shuffle on
both keys) -> cohort date as ``min(date)`` over the user's rows (shuffle on
user; after the distinct a user has at most one row per calendar day, so
even the hottest user's window is bounded by the number of days) ->
conditional counts per cohort (partial aggregation, then a tiny shuffle).

This replaces the direct form ``cohort LEFT JOIN activity`` with four
``COUNT(DISTINCT ...)``, which Spark plans as an ``Expand`` (rows x 4),
a join and two scans. The rewrite is exact: each user has one row per
date, so a conditional count over those rows counts each user once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_between
from ..functions.numeric import ratio


def cohorts(ev: DataFrame, user: str = "user_pseudo_id", date: str = "event_date") -> DataFrame:
    """First active date per user (NULL user forms its own group, as
    SQL ``GROUP BY`` does)."""
    return ev.groupBy(user).agg(F.min(date).alias("cohort_date"))


def activity(ev: DataFrame, user: str = "user_pseudo_id", date: str = "event_date") -> DataFrame:
    """Distinct user-day pairs."""
    return ev.select(user, date).distinct()


def activity_with_cohort(ev: DataFrame, user: str = "user_pseudo_id", date: str = "event_date") -> DataFrame:
    """Distinct (user, date) rows tagged with the user's cohort date and
    day number."""
    by_user = Window.partitionBy(user)
    return (
        activity(ev, user, date)
        .withColumn("cohort_date", F.min(date).over(by_user))
        .withColumn("day_n", days_between(F.col(date), F.col("cohort_date")))
    )


def _cohort_counts(act: DataFrame, user: str, date: str, days: Sequence[int], extra=()) -> DataFrame:
    known = F.col(user).isNotNull()
    aggs = [F.count_if(known & F.col(date).eqNullSafe(F.col("cohort_date"))).alias("cohort_size")]
    aggs += [F.count_if(known & (F.col("day_n") == n)).alias(f"d{n}_retention") for n in days]
    return act.groupBy("cohort_date").agg(*aggs, *extra)


def retention(
    ev: DataFrame,
    days: Sequence[int] = (1, 3, 7),
    user: str = "user_pseudo_id",
    date: str = "event_date",
) -> DataFrame:
    """Cohort size and users active exactly ``n`` days after their
    first day, as counts; newest cohort first."""
    act = activity_with_cohort(ev, user, date)
    return _cohort_counts(act, user, date, days).orderBy(F.col("cohort_date").desc())


def retention_rates(
    ev: DataFrame,
    days: Sequence[int] = (1, 7, 30),
    digits: int = 4,
    user: str = "user_pseudo_id",
    date: str = "event_date",
) -> DataFrame:
    """Retention as a fraction of cohort size. ``dN`` is NULL while the
    cohort is younger than N days (the last observed date minus the cohort
    date is below N).

    The last observed date is the max over cohorts of each cohort's own
    last date: a window over the per-cohort rows (one per cohort date),
    so no join and no driver round trip.
    """
    act = activity_with_cohort(ev, user, date)
    per_cohort = _cohort_counts(act, user, date, days, extra=[F.max(date).alias("_last_date")])
    last_date = F.max("_last_date").over(Window.partitionBy())
    cols = [F.col("cohort_date"), F.col("cohort_size")]
    for n in days:
        old_enough = days_between(last_date, F.col("cohort_date")) >= n
        cols.append(
            F.when(old_enough, ratio(F.col(f"d{n}_retention"), F.col("cohort_size"), digits)).alias(
                f"d{n}_retention_rate"
            )
        )
    return per_cohort.select(*cols).orderBy(F.col("cohort_date").desc())


def retention_matrix(
    ev: DataFrame,
    digits: int = 4,
    user: str = "user_pseudo_id",
    date: str = "event_date",
) -> DataFrame:
    """Long-form matrix (cohort_date, day_n, users, rate); rate is the
    share of the cohort active on day n. Cohorts and days with no known
    user are left out."""
    act = activity_with_cohort(ev, user, date).where(
        F.col(user).isNotNull() & F.col("day_n").isNotNull()
    )
    cells = act.groupBy("cohort_date", "day_n").agg(F.count(F.lit(1)).alias("users"))
    size = F.max(F.when(F.col("day_n") == 0, F.col("users"))).over(Window.partitionBy("cohort_date"))
    return cells.select(
        "cohort_date", "day_n", "users", ratio(F.col("users"), size, digits).alias("rate")
    ).orderBy("cohort_date", "day_n")
