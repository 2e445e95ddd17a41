"""In-game economy: gold per level (K04), source/sink flow (C04) and the
running wallet balance (C05)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, ratio
from ..schemas import AD_REWARD_CLAIM, LEVEL_COMPLETE
from ..session import scratch_path


def economy_by_level(ev: DataFrame, event: str = LEVEL_COMPLETE) -> DataFrame:
    """Per level, distinct players, gold total, mean gold per
    completion and gold per distinct player (both rounded to units)."""
    done = ev.where((F.col("event_name") == event) & F.col("level_id").isNotNull())
    agg = done.groupBy("level_id").agg(
        F.count_distinct("user_id").alias("players_reached"),
        F.sum("gold_earned").alias("total_gold_source"),
        exact_mean("gold_earned", 0).alias("avg_gold_per_level"),
    )
    return agg.select(
        "level_id",
        "players_reached",
        "total_gold_source",
        "avg_gold_per_level",
        # gold / players is an error in the source dialect when players is 0;
        # a level row always has at least one row but possibly no known user.
        ratio("total_gold_source", "players_reached", 0).alias("gold_per_user"),
    ).orderBy("level_id")


def _amount(a: Column | str | int) -> Column:
    if isinstance(a, Column):
        return a
    return F.col(a) if isinstance(a, str) else F.lit(a)


def _signed_amount(sources: Mapping[str, str], sinks: Mapping[str, Column | str | int]) -> tuple[Column, Column]:
    """(gold in, gold out) of one event row, each 0 when not applicable."""
    src = F.lit(0).cast("long")
    for event, amount in sources.items():
        src = src + F.when(F.col("event_name") == event, F.coalesce(_amount(amount).cast("long"), F.lit(0))).otherwise(0)
    snk = F.lit(0).cast("long")
    for event, amount in sinks.items():
        snk = snk + F.when(F.col("event_name") == event, F.coalesce(_amount(amount).cast("long"), F.lit(0))).otherwise(0)
    return src, snk


DEFAULT_SOURCES = {LEVEL_COMPLETE: "gold_earned", AD_REWARD_CLAIM: "gold_reward"}


def economy_flow(
    ev: DataFrame,
    sinks: Mapping[str, Column | str | int],
    sources: Mapping[str, str] | None = None,
    by: Sequence[str] = ("event_date",),
) -> DataFrame:
    """Gold created (sources), gold removed (sinks) and net flow per
    event date (or any grouping ``by``, e.g. ``("event_date", "level_id")``).
    The data has no sink event, so the caller names them: {event_name:
    amount column or constant}. ``sources`` defaults to level completions
    and ad rewards; pass ``{"level_complete": "gold_earned"}`` to count only
    what the per-level report counts."""
    sums = flow_sums(ev, sinks, sources, by)
    return sums.select(*by, "gold_source", "gold_sink", (F.col("gold_source") - F.col("gold_sink")).alias("net_flow")).orderBy(*by)


def flow_sums(ev: DataFrame, sinks: Mapping[str, Column | str | int], sources: Mapping[str, str] | None, by: Sequence[str]) -> DataFrame:
    """Gold created and removed by ``by``."""
    sources = dict(DEFAULT_SOURCES if sources is None else sources)
    src, snk = _signed_amount(sources, sinks)
    rows = ev.where(F.col("event_name").isin(list(sources) + list(sinks)))
    return rows.groupBy(*by).agg(F.sum(src).alias("gold_source"), F.sum(snk).alias("gold_sink"))


def wallet_balance(
    ev: DataFrame,
    sinks: Mapping[str, Column | str | int],
    sources: Mapping[str, str] | None = None,
    user: str = "user_id",
    ts: str = "event_ts",
    tiebreak: str = "event_id",
    ranges: int | None = None,
) -> DataFrame:
    """Running signed gold per user over time (one row per event).

    A plain ``sum().over(partitionBy(user).orderBy(ts))`` sends all of a
    user's events to one task; a single hot user, one of its hours, or the
    events without a user could hold a third of the data. The running sum is
    split in two exact parts instead:

    1. rows are dealt to ``ranges`` ranges of equal size of the order (user,
       ts, id) and written once, narrow, with their range's number (a number
       that is stored can't differ between the two reads); inside each (user,
       range) a running sum;
    2. before each range: the sum of the user's earlier ranges, computed on one
       row per user and range and joined back on (user, range), the key by which
       the running sums lie already.

    NULL users are a group of their own and NULL times come first, as in the
    one-window form.
    """
    spark = ev.sparkSession
    sources = dict(DEFAULT_SOURCES if sources is None else sources)
    src, snk = _signed_amount(sources, sinks)
    user_type = ev.schema[user].dataType
    rows = ev.select(
        F.col(user),
        F.coalesce(F.col(user), F.lit(0).cast(user_type)).alias("_u"),
        F.col(user).isNull().alias("_un"),
        F.col(tiebreak),
        F.col(ts),
        (src - snk).alias("delta"),
    )
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in ("_un", "_u", ts, tiebreak)]
    dealt = rows.repartitionByRange(ranges, *order).withColumn("_r", F.spark_partition_id())
    path = scratch_path(spark, "wallet", uuid.uuid4().hex)
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)

    keys = ["_u", "_un", "_r"]
    running = Window.partitionBy(*keys).orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.withColumn("_local", F.sum("delta").over(running))
    totals = dealt.groupBy(*keys).agg(F.sum("delta").alias("_total"))
    before = Window.partitionBy("_u", "_un").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return local.join(offsets, keys, "inner").select(
        user, tiebreak, ts, "delta", (F.col("_offset") + F.col("_local")).alias("balance")
    )
