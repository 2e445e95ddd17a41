"""Marts that are kept up to date instead of computed anew: one stored state
per day (or 32 days) that merges with others, and the measures read from it.

* activity bitmaps: the day's users as bits, by id bucket. Counts of any span of
  days are the bits of the OR of its days, exact, without reading an event.
* activity sketches: the day's users as a HyperLogLog sketch, for ids that are no
  numbers or too sparse for bitmaps; any span within the stated error.
* activity words: per user and 32 days, the days as bits of one number. Retention
  reads first days and day offsets from them; a new day touches one word of each
  of its users.
* day states: sums, counts and user-day flags from which difficulty, monetization
  and the gold flow are derived on read.

Every state is a partial aggregate (combined in each task before its shuffle),
every merge is associative, and :func:`refresh_days` computes and replaces the given
days only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_between, month_start
from ..functions.numeric import ratio
from ..schemas import AD_REWARD_CLAIM, IAP_PURCHASE, SESSION_START
from ..sources.sinks import write_mart
from . import audience, difficulty, economy, monetization, revenue

# Users of a day below a relative error of three standard errors, 1.04 / sqrt(2 ** SKETCH_LOG) each.
SKETCH_LOG = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LOG / 2)
# Days in one word: positive numbers of 64 bits, so the lowest bit is found by arithmetic that can't overflow.
WORD_DAYS = 32
EPOCH = "1970-01-01"


def refresh_days(path: str, state: Callable[[DataFrame], DataFrame], ev: DataFrame, days: Sequence[dt.date] | None = None, date: str = "event_date") -> None:
    """Compute ``state`` for ``days`` of ``ev`` (all days if None) and replace their partitions of the mart at
    ``path``; no other day is read or written. A day without rows keeps what the mart has of it."""
    if days is not None:
        ev = ev.where(F.col(date).isin(list(days)))
    write_mart(state(ev), path, (date,))


# ---- K05, K06, K07, D06: activity bitmaps ---------------------------------------------


def activity_bitmaps(ev: DataFrame, user: str = "user_pseudo_id", date: str = "event_date", event: str | None = SESSION_START) -> DataFrame:
    """(date, bucket, users): the users (whole numbers) with ``event`` (any, if None) on a day, 32,768 to a bitmap.
    Users that are NULL have no bit; their day is kept."""
    rows = ev.where(F.col("event_name") == event) if event else ev
    return rows.groupBy(date, F.bitmap_bucket_number(user).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))


def bitmap_dau(bitmaps: DataFrame, date: str = "event_date") -> DataFrame:
    """Users per day."""
    return bitmaps.groupBy(F.col(date).alias("date")).agg(F.sum(F.bitmap_count("users")).alias("dau"))


def bitmap_users(bitmaps: DataFrame, by: Column | str, name: str) -> DataFrame:
    """Distinct users of each group of days ``by`` (a date expression, or a column of ``bitmaps``): (by, name)."""
    by = F.col(by) if isinstance(by, str) else by
    merged = bitmaps.groupBy(by.alias("period"), "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy("period").agg(F.sum(F.bitmap_count("users")).alias(name))


def bitmap_mau(bitmaps: DataFrame, date: str = "event_date") -> DataFrame:
    """Users per calendar month."""
    return bitmap_users(bitmaps, month_start(date), "mau").withColumnRenamed("period", "month_start")


def bitmap_engagement(bitmaps: DataFrame, date: str = "event_date") -> DataFrame:
    """DAU, the MAU of the day's month, and stickiness; both sides hold one row a day or month."""
    daily, monthly = bitmap_dau(bitmaps, date), bitmap_mau(bitmaps, date)
    return daily.join(monthly, month_start("date") == F.col("month_start"), "left").select(
        "date", "dau", "mau", ratio(F.col("dau") * 100, F.col("mau"), 2).alias("stickiness_percent")
    )


def bitmap_rolling(bitmaps: DataFrame, span: int = 7, date: str = "event_date") -> DataFrame:
    """Distinct users of the ``span`` days that end on each day from the first to the last one (date, users): every day's
    bitmaps are merged into the spans they belong to, 4 KB a bucket whatever the number of events."""
    ends = F.transform(F.sequence(F.lit(0), F.lit(span - 1)), lambda i: F.struct((i == 0).alias("own"), F.date_add(F.col(date), i).alias("end")))
    spread = bitmaps.where(F.col(date).isNotNull()).select(F.explode(ends).alias("to"), "bucket", "users").select("to.own", "to.end", "bucket", "users")
    merged = spread.groupBy("end", "bucket").agg(F.bitmap_or_agg("users").alias("users"), F.max("own").alias("own"))
    counts = merged.groupBy("end").agg(F.sum(F.bitmap_count("users")).alias("users"), F.max("own").alias("own"))
    last = F.max(F.when(F.col("own"), F.col("end"))).over(Window.partitionBy())  # over one row a day
    return counts.select(F.col("end").alias("date"), "users", last.alias("_last")).where("date <= _last").drop("_last")


# ---- T03, K05, K06: sketches -----------------------------------------------------------


def activity_sketches(ev: DataFrame, user: str = "user_pseudo_id", date: str = "event_date", event: str | None = SESSION_START, log: int = SKETCH_LOG) -> DataFrame:
    """(date, sketch): a day's users as a HyperLogLog sketch of 2 ** ``log`` registers."""
    rows = ev.where(F.col("event_name") == event) if event else ev
    return rows.groupBy(date).agg(F.hll_sketch_agg(F.col(user), F.lit(log)).alias("sketch"))


def sketch_users(sketches: DataFrame, by: Column | str) -> DataFrame:
    """(period, users): estimated distinct users of each group of days, from the days' sketches."""
    by = F.col(by) if isinstance(by, str) else by
    return sketches.groupBy(by.alias("period")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))


# ---- K01, K02, K03, C01, C02: activity words --------------------------------------------


def activity_words(ev: DataFrame, user: str = "user_pseudo_id", date: str = "event_date") -> DataFrame:
    """(user, word, days): a user's active days, bit i of ``days`` being day 32 * word + i since 1970. A NULL day is not
    activity; the NULL user is kept as a user."""
    number = days_between(F.col(date), F.lit(EPOCH).cast("date"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(WORD_DAYS)))
    rows = ev.where(F.col(date).isNotNull()).select(F.col(user).alias("user"), F.floor(number / WORD_DAYS).cast("int").alias("word"), bit.alias("days"))
    return rows.groupBy("user", "word").agg(F.bit_or("days").alias("days"))


def merge_words(path: str, new: DataFrame) -> None:
    """Merge the words of new days into the mart at ``path``: only the 32-day spans that they touch are read and
    replaced. Merging the same days again changes nothing."""
    spark = new.sparkSession
    spans = [r["word"] for r in new.select("word").distinct().collect()]  # one number for 32 days
    old = spark.read.schema("user {}, word int, days long".format(new.schema["user"].dataType.simpleString())).parquet(path)
    both = old.where(F.col("word").isin(spans)).unionByName(new).groupBy("user", "word").agg(F.bit_or("days").alias("days"))
    write_mart(both.select("user", "days", "word").checkpoint(), path, ("word",))


def _first_day(days: Column, word: Column) -> Column:
    """The lowest day of a word: trailing zeros are the bits below the lowest set one."""
    lowest = days.bitwiseAND(F.negate(days))
    return F.date_add(F.lit(EPOCH).cast("date"), (word * WORD_DAYS + F.bit_count(lowest - 1)).cast("int"))


def user_activity(words: DataFrame) -> DataFrame:
    """One row a user: (user, cohort_date, words), K01's cohort and K02's days as a list of at most one word for 32 days."""
    per_user = words.groupBy("user").agg(F.array_sort(F.collect_list(F.struct("word", "days"))).alias("words"))
    first = F.element_at("words", 1)
    return per_user.select("user", _first_day(first["days"], first["word"]).alias("cohort_date"), "words")


def _active_after(n: int) -> Column:
    """Whether a user was active ``n`` days after the first one."""
    day = days_between(F.col("cohort_date"), F.lit(EPOCH).cast("date")) + n
    word, bit = F.floor(day / WORD_DAYS).cast("int"), F.pmod(day, F.lit(WORD_DAYS))
    return F.exists("words", lambda w: (w["word"] == word) & (F.call_function("shiftright", w["days"], bit).bitwiseAND(F.lit(1)) == 1))


def retention_of(words: DataFrame, days: Sequence[int] = (1, 3, 7)) -> DataFrame:
    """K03 from activity words: cohort size and users active exactly ``n`` days after their first day."""
    users = user_activity(words)
    known = F.col("user").isNotNull()
    counts = [F.count_if(known & _active_after(n)).alias(f"d{n}_retention") for n in days]
    return users.groupBy("cohort_date").agg(F.count_if(known).alias("cohort_size"), *counts)


def retention_rates_of(words: DataFrame, days: Sequence[int] = (1, 7, 30), digits: int = 4) -> DataFrame:
    """C01 from activity words; NULL while the cohort is younger than ``n`` days at the last active day."""
    users = user_activity(words)
    last = F.element_at("words", -1)
    top = F.floor(F.log2(last["days"].cast("double"))).cast("int")  # words are below 2 ** 32: exact
    known = F.col("user").isNotNull()
    counts = [F.count_if(known & _active_after(n)).alias(f"_d{n}") for n in days]
    latest = F.max(F.date_add(F.lit(EPOCH).cast("date"), last["word"] * WORD_DAYS + top)).alias("_last")
    cohorts = users.groupBy("cohort_date").agg(F.count_if(known).alias("cohort_size"), latest, *counts)
    end = F.max("_last").over(Window.partitionBy())  # one row a cohort
    rates = [
        F.when(days_between(end, F.col("cohort_date")) >= n, ratio(F.col(f"_d{n}"), F.col("cohort_size"), digits)).alias(f"d{n}_retention_rate")
        for n in days
    ]
    return cohorts.select("cohort_date", "cohort_size", *rates)


def retention_matrix_of(words: DataFrame, digits: int = 4) -> DataFrame:
    """C02 from activity words: (cohort_date, day_n, users, rate)."""
    users = user_activity(words).where(F.col("user").isNotNull())
    each = users.select("cohort_date", F.explode("words").alias("w"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD_DAYS - 1)), lambda i: F.call_function("shiftright", F.col("w.days"), i).bitwiseAND(F.lit(1)) == 1)
    first = days_between(F.col("cohort_date"), F.lit(EPOCH).cast("date"))
    days = each.select("cohort_date", (F.col("w.word") * WORD_DAYS - first).alias("start"), F.explode(bits).alias("bit"))
    cells = days.groupBy("cohort_date", (F.col("start") + F.col("bit")).alias("day_n")).agg(F.count(F.lit(1)).alias("users"))
    size = F.max(F.when(F.col("day_n") == 0, F.col("users"))).over(Window.partitionBy("cohort_date"))
    return cells.select("cohort_date", "day_n", "users", ratio(F.col("users"), size, digits).alias("rate"))


# ---- K08, K09, C04: day states -----------------------------------------------------------


def level_states(ev: DataFrame) -> DataFrame:
    """K08's counts per day and level."""
    return difficulty.outcome_counts(ev, by=("event_date", "level_id"))


def difficulty_of(states: DataFrame) -> DataFrame:
    """K08 from :func:`level_states`."""
    sums = states.groupBy("level_id").agg(*[F.sum(c).alias(c) for c in ("total_attempts", "wins", "fails")])
    return difficulty.rates(sums)


def money_states(ev: DataFrame) -> DataFrame:
    """K09's counts and revenue per day (a user counts once a day, so days are whole states)."""
    return monetization.daily_sums(ev)


def monetization_of(states: DataFrame) -> DataFrame:
    """K09 from :func:`money_states`."""
    return monetization.daily_ratios(states)


def user_day_revenue(ev: DataFrame) -> DataFrame:
    """Purchase and ad revenue per user and day: one row a user and day, so a hot user has as many rows as active days.
    Bucketed by user (``sources.bucketed``), it meets the user table without a shuffle."""
    iap, ads = F.col("event_name") == IAP_PURCHASE, F.col("event_name") == AD_REWARD_CLAIM
    facts = ev.where(iap | ads).select(
        "user_id", F.to_date("event_ts").alias("day"), F.when(iap, F.col("revenue")).alias("iap"), F.when(ads, F.col("ad_revenue")).alias("ads")
    )
    return facts.groupBy("user_id", "day").agg(F.sum("iap").alias("iap"), F.sum("ads").alias("ads"))


def ltv_of(days: DataFrame) -> DataFrame:
    """K10 from :func:`user_day_revenue` (users without a purchase have a NULL)."""
    return days.groupBy("user_id").agg(F.sum("iap").alias("total_ltv"))


def user_revenue_of(days: DataFrame, ua: DataFrame) -> DataFrame:
    """D02 from :func:`user_day_revenue`."""
    per_user = days.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.sum("iap").alias("iap_rev"), F.sum("ads").alias("ads_rev"))
    return audience.with_revenue(ua, per_user)


def tier_day_revenue_of(days: DataFrame, ua: DataFrame) -> DataFrame:
    """D15 and D16 from :func:`user_day_revenue`; installs are dates."""
    zero = F.lit(0).cast("decimal(28,2)")
    rev = F.when(F.col("iap").isNotNull() | F.col("ads").isNotNull(), F.coalesce("iap", zero) + F.coalesce("ads", zero))
    return revenue.tier_day_sums(revenue.with_day_diff(days.select("user_id", "day", rev.alias("rev")), ua, "day"))


def flow_states(ev: DataFrame, sinks: Mapping[str, Column | str | int], sources: Mapping[str, str] | None = None) -> DataFrame:
    """C04's sums per day and level."""
    return economy.flow_sums(ev, sinks, sources, ("event_date", "level_id"))


def flow_of(states: DataFrame, by: Sequence[str] = ("event_date",)) -> DataFrame:
    """C04 from :func:`flow_states`, by any of its keys."""
    sums = states.groupBy(*by).agg(F.sum("gold_source").alias("gold_source"), F.sum("gold_sink").alias("gold_sink"))
    return sums.withColumn("net_flow", F.col("gold_source") - F.col("gold_sink"))
