"""Daily / monthly active users and stickiness.

Stickiness derives DAU and MAU from one ``distinct(user, day)`` set with
windows instead of joining two separately de-duplicated aggregates (the
source query scans the log twice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start, parse_yyyymmdd
from ..functions.numeric import ratio
from ..schemas import SESSION_START


def _date(raw: DataFrame, date_col: str) -> Column:
    """The event day as DATE: parsed when the log stores ``yyyyMMdd``."""
    dtype = raw.schema[date_col].dataType.typeName()
    return F.col(date_col) if dtype == "date" else parse_yyyymmdd(date_col)


def session_days(
    raw: DataFrame, user: str = "user_pseudo_id", date_col: str = "event_date", event: str = SESSION_START
) -> DataFrame:
    """Distinct (user, date) of session starts."""
    return raw.where(F.col("event_name") == event).select(F.col(user).alias("user"), _date(raw, date_col).alias("date")).distinct()


def dau(raw: DataFrame, user: str = "user_pseudo_id", date_col: str = "event_date") -> DataFrame:
    """Distinct users with a session start, per day."""
    days = session_days(raw, user, date_col)
    # one row per (user, date): counting non-NULL users is the distinct count
    return days.groupBy("date").agg(F.count("user").alias("dau")).orderBy(F.col("date").desc())


def mau(raw: DataFrame, user: str = "user_pseudo_id", date_col: str = "event_date") -> DataFrame:
    """Distinct users with a session start, per calendar month (one
    distinct aggregate on (month, user), combined map-side)."""
    starts = raw.where(F.col("event_name") == SESSION_START)
    return (
        starts.groupBy(month_start(_date(raw, date_col)).alias("month_start"))
        .agg(F.count_distinct(user).alias("mau"))
        .orderBy(F.col("month_start").desc())
    )


def engagement(raw: DataFrame, user: str = "user_pseudo_id", date_col: str = "event_date") -> DataFrame:
    """DAU, the MAU of the day's month and stickiness = DAU / MAU x 100
    (2 decimals).

    No join of a daily and a monthly aggregate (which would dedupe the log
    twice): from the distinct (user, day) rows, a user's first active day
    in each month is flagged by a window over (user, month) (at most 31
    rows), the days are counted once, and the month's MAU is the sum of its
    days' first-in-month users (a window over at most 31 day rows).
    """
    days = session_days(raw, user, date_col)
    month = month_start("date")
    first = (F.col("date") == F.min("date").over(Window.partitionBy("user", month))) & F.col("user").isNotNull()
    per_day = days.withColumn("_first", first).groupBy("date").agg(
        F.count("user").alias("dau"), F.count_if("_first").alias("_new")
    )
    month_total = F.when(F.col("date").isNotNull(), F.sum("_new").over(Window.partitionBy(month_start("date"))))
    return (
        per_day.select("date", "dau", month_total.alias("mau"))
        .select("date", "dau", "mau", ratio(F.col("dau") * 100, F.col("mau"), 2).alias("stickiness_percent"))
        .orderBy(F.col("date").desc())
    )


def daily_users(ev: DataFrame, user: str = "user_id", date_col: str = "event_date") -> DataFrame:
    """Distinct users with any event per day, unordered (NULL days dropped,
    as a pandas group-by does)."""
    return ev.where(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.count_distinct(user).alias("dau"))


def dau_any_event(ev: DataFrame, user: str = "user_id", date_col: str = "event_date") -> DataFrame:
    """The DAU trend, by day."""
    return daily_users(ev, user, date_col).orderBy(date_col)
