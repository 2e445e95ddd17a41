"""Registered runs of what is kept up to date: marts that grow by a day, late rows, and the live wallet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.numeric import round_money
from ..functions.variants import drifting_params, param_inventory, parsed
from ..operators import audience, engagement, rollups
from ..operators.staging import DEFAULT_PARAM_SPEC
from ..schemas import LEVEL_FAIL
from ..session import scan_filter_session
from ..sources.driver_tables import DriverTables
from ..sources.sinks import write_mart
from ..sources.staged import staged_folder

FLOW_SINKS = {LEVEL_FAIL: 10}
# Days appended one by one to a mart that holds the earlier ones.
APPENDED = 3
ROLLING_DAYS = 7
TIER_SUBSET = ("Tier 1", "Tier 3")


def _last_days(ev: DataFrame) -> list[dt.date]:
    """The last days of the log, one row each."""
    days = ev.select("event_date").where("event_date IS NOT NULL").distinct().orderBy(F.desc("event_date")).limit(APPENDED)
    return sorted(r[0] for r in days.collect())


def _kept(spark: SparkSession, sf_dir: str, name: str, state: Callable[[DataFrame], DataFrame], of: Callable[[DriverTables], DataFrame] = DriverTables.master_events) -> DataFrame:
    """The mart ``name`` of day states: written for the earlier days, then grown by one day after the other, once per
    version of the log; later calls read it."""
    t = DriverTables(spark, sf_dir)
    ev = of(t)

    def write(path: str) -> None:
        last = _last_days(ev)
        rollups.refresh_days(path, state, ev.where(~F.coalesce(F.col("event_date").isin(last), F.lit(False))))
        for day in last:
            rollups.refresh_days(path, state, ev, [day])

    folder, _ = staged_folder(spark, f"mart_{name}", [t._path("events"), t._path("customer")], write, state(ev))  # noqa: SLF001
    return spark.read.schema(state(ev).schema).parquet(folder)


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity words: written for the earlier days, then merged with one day after the other."""
    t = DriverTables(spark, sf_dir)
    ev = t.master_events()

    def write(path: str) -> None:
        last = _last_days(ev)
        write_mart(rollups.activity_words(ev.where(~F.col("event_date").isin(last))), path, ("word",))
        for day in last:
            rollups.merge_words(path, rollups.activity_words(ev.where(F.col("event_date") == day)))

    folder, _ = staged_folder(spark, "mart_activity_words", [t._path("events")], write, rollups.activity_words(ev))  # noqa: SLF001
    return spark.read.schema(rollups.activity_words(ev).schema).parquet(folder)


def _session_bitmaps(spark, sf_dir):
    return _kept(spark, sf_dir, "session_bitmaps", rollups.activity_bitmaps)


def q_bitmap_dau(spark, sf_dir):
    """K05 from the days' bitmaps."""
    return rollups.bitmap_dau(_session_bitmaps(spark, sf_dir))


def q_bitmap_mau(spark, sf_dir):
    """K06 from the days' bitmaps."""
    return rollups.bitmap_mau(_session_bitmaps(spark, sf_dir))


def q_bitmap_stickiness(spark, sf_dir):
    """K07 from the days' bitmaps."""
    return rollups.bitmap_engagement(_session_bitmaps(spark, sf_dir))


def q_bitmap_rolling(spark, sf_dir):
    """Users of the last seven days, for every day, from the days' bitmaps."""
    return rollups.bitmap_rolling(_session_bitmaps(spark, sf_dir), ROLLING_DAYS)


def q_bitmap_dau_any(spark, sf_dir):
    """D06 from the bitmaps of any event of the acquired users."""
    state = lambda ev: rollups.activity_bitmaps(ev, "user_id", event=None)
    bitmaps = _kept(spark, sf_dir, "any_bitmaps", state, lambda t: audience.filter_tagged_by_tier(t.acquired_events()))
    return rollups.bitmap_dau(bitmaps).select(F.col("date").alias("event_date"), "dau")


def q_sketch_users(spark, sf_dir):
    """T03, K05, K06 from the days' sketches: whether each day's and month's estimate lies within the stated error of the
    exact count, and one user."""
    sketches = _kept(spark, sf_dir, "session_sketches", rollups.activity_sketches)
    raw = DriverTables(spark, sf_dir).raw_events()
    exact = engagement.dau(raw).select(F.lit("day").alias("span"), F.col("date").alias("period"), F.col("dau").alias("n")).unionByName(
        engagement.mau(raw).select(F.lit("month").alias("span"), F.col("month_start").alias("period"), F.col("mau").alias("n"))
    )
    found = rollups.sketch_users(sketches, "event_date").withColumn("span", F.lit("day")).unionByName(
        rollups.sketch_users(sketches, month_start("event_date")).withColumn("span", F.lit("month"))
    )
    within = F.abs(F.col("users") - F.col("n")) <= F.lit(rollups.SKETCH_ERROR) * F.col("n") + 1
    return exact.join(found, ["span", "period"], "full").select("span", "period", F.coalesce(within, F.lit(False)).alias("within_bound"))


def q_words_retention(spark, sf_dir):
    """K01 to K03 from activity words."""
    return rollups.retention_of(_words(spark, sf_dir))


def q_words_retention_rates(spark, sf_dir):
    """C01 from activity words."""
    return rollups.retention_rates_of(_words(spark, sf_dir))


def q_words_retention_matrix(spark, sf_dir):
    """C02 from activity words."""
    return rollups.retention_matrix_of(_words(spark, sf_dir))


def q_states_difficulty(spark, sf_dir):
    """K08 from the days' counts."""
    return rollups.difficulty_of(_kept(spark, sf_dir, "level_states", rollups.level_states))


def q_states_monetization(spark, sf_dir):
    """K09 from the days' counts and sums."""
    return rollups.monetization_of(_kept(spark, sf_dir, "money_states", rollups.money_states))


def _flow(spark, sf_dir):
    return _kept(spark, sf_dir, "flow_states", lambda ev: rollups.flow_states(ev, FLOW_SINKS))


def q_states_flow(spark, sf_dir):
    """C04 by day from the days' sums."""
    return rollups.flow_of(_flow(spark, sf_dir))


def q_states_flow_by_level(spark, sf_dir):
    """C04 by day and level from the days' sums."""
    return rollups.flow_of(_flow(spark, sf_dir), ("event_date", "level_id"))


def q_stream_late_rows(spark, sf_dir):
    """T06."""
    from ..streaming.replay import run_stream_late_rows_on_driver_tables

    return run_stream_late_rows_on_driver_tables(spark, sf_dir)


def q_stream_wallet(spark, sf_dir):
    """C05 as a stream with restarts."""
    from ..streaming.replay import run_stream_wallet_on_driver_tables

    return run_stream_wallet_on_driver_tables(spark, sf_dir, FLOW_SINKS)


def q_ingested_events(spark, sf_dir):
    """N05 by file stream."""
    from ..streaming.replay import run_ingest_on_driver_tables

    me = run_ingest_on_driver_tables(spark, sf_dir)
    return me.select(
        "event_id", "user_id", "event_date", "event_name", "level_id", "win_loss_status", "gold_earned",
        round_money("revenue").alias("revenue"), "gold_reward", "placement", "product_id",
    )


def _drifting_lines(spark, sf_dir) -> DataFrame:
    """The log as lines whose parameters drift: every other event writes ``level_id`` as a text, and every third has a key
    that no spec names."""
    raw = DriverTables(spark, sf_dir).raw_events()
    kind = raw.schema["event_params"].dataType.elementType["value"].dataType
    value = lambda field, c: F.struct(*[(c if f.name == field else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])
    as_text = F.col("event_id") % 2 == 0
    drift = F.transform(
        "event_params",
        lambda p: F.when(as_text & (p["key"] == "level_id"), F.struct(p["key"].alias("key"), value("string_value", p["value"]["int_value"]).alias("value"))).otherwise(p),
    )
    clan = F.array(F.struct(F.lit("clan").alias("key"), value("string_value", F.concat(F.lit("c"), F.col("event_id") % 5)).alias("value")))
    params = F.when(F.col("event_id") % 3 == 0, F.concat(drift, clan)).otherwise(drift)
    drifted = raw.withColumn("event_params", params)
    return parsed(drifted.select("event_id", F.to_json(F.struct(*[c for c in raw.columns if c != "event_id"])).alias("value")))


def q_param_inventory(spark, sf_dir):
    """Keys and types of a drifting log, and which the spec doesn't name."""
    known = {key for key, _, _ in DEFAULT_PARAM_SPEC.values()}
    return param_inventory(_drifting_lines(spark, sf_dir), known)


def q_drifting_params(spark, sf_dir):
    """A key whose type changes, and one that the spec doesn't name, read from the drifting log."""
    spec = {"level_id": "bigint", "clan": "string", "gold_earned": "bigint", "status": "string"}
    return drifting_params(_drifting_lines(spark, sf_dir), spec, ["event_id"])


def q_tier_filtered_untagged(spark, sf_dir):
    """D04 on the untagged log: the semi join, with a Bloom filter of the chosen users at the scan."""
    t = DriverTables(scan_filter_session(spark), sf_dir)
    ev = audience.filter_by_tier(t.master_events_live(), t.user_acquisition(), TIER_SUBSET)
    return ev.select("event_id", "user_id", "event_name")


LIVE_QUERIES = {
    "tier_filtered_untagged": q_tier_filtered_untagged,
    "param_inventory": q_param_inventory,
    "drifting_params": q_drifting_params,
    "ingested_events": q_ingested_events,
    "stream_late_rows": q_stream_late_rows,
    "stream_wallet_balance": q_stream_wallet,
    "bitmap_dau": q_bitmap_dau,
    "bitmap_mau": q_bitmap_mau,
    "bitmap_stickiness": q_bitmap_stickiness,
    "bitmap_rolling_users": q_bitmap_rolling,
    "bitmap_dau_any_event": q_bitmap_dau_any,
    "sketch_active_users": q_sketch_users,
    "words_retention": q_words_retention,
    "words_retention_rates": q_words_retention_rates,
    "words_retention_matrix": q_words_retention_matrix,
    "states_difficulty": q_states_difficulty,
    "states_monetization": q_states_monetization,
    "states_economy_flow": q_states_flow,
    "states_economy_flow_by_level": q_states_flow_by_level,
}
