"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
driver tables mapped to the game model (FIXTURES.md section B).

Every query reads the whole ``events`` (and ``customer``) tables; nothing
is sampled, capped or subset. Limits appear only where the report is a
"lowest n levels" list by definition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import round_money
from ..functions.params import explode_params, flatten_params, param
from ..operators import audience, difficulty, economy, engagement, monetization, progression, retention, revenue
from ..operators.staging import build_master_events, events_since
from ..schemas import CORRUPT_COLUMN, LEVEL_FAIL, RAW_EVENTS_WITH_CORRUPT
from ..session import apply_engine_conf, partitions_for_input
from ..sources.driver_tables import (
    INSTALL_WINDOW,
    DriverTables,
    ad_impressions_from_master,
    iap_transactions_from_master,
)
from ..sources.readers import read_flat_events, read_raw_events, read_user_acquisition
from ..sources.sinks import write_csv, write_raw_events
from ..sources.staged import staged_folder
from .files import FILE_QUERIES
from .live import LIVE_QUERIES
from .warehouse import WAREHOUSE_QUERIES

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered runs (fixed values).
PINCH_THRESHOLD = 0.48
# Lengths of the source's reports; without them the operators return every level and day.
FUNNEL_LEVELS, CHURN_LEVELS, OUTCOME_LEVELS, LTV_DAYS = 20, 10, 20, 30
FLOW_SINKS = {LEVEL_FAIL: 10}
TIER_SUBSET = ("Tier 1", "Tier 3")
SINCE_YYYYMMDD = "20240115"


def _t(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested log as NDJSON text lines (what the source writes)."""
    raw = _t(spark, sf_dir).raw_events()
    return raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))


RAW_WITH_ID = T.StructType(RAW_EVENTS_WITH_CORRUPT.fields + [T.StructField("event_id", T.LongType())])


def parsed_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON lines parsed with the explicit schema (PERMISSIVE), the same
    parser ``spark.read.json`` uses."""
    lines = raw_log_lines(spark, sf_dir)
    return lines.select(F.from_json("value", RAW_WITH_ID, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}).alias("e")).select("e.*")


def _dashboard(spark: SparkSession, sf_dir: str):
    """The inputs of a dashboard mart: events, purchases and ad views of the
    users in the acquisition table (all tiers chosen), read from the staged
    tagged events with a pushed-down filter, plus the user table."""
    t = _t(spark, sf_dir)
    ev = audience.filter_tagged_by_tier(t.acquired_events())
    return t, ev, t.user_acquisition()


def _facts(ev: DataFrame):
    """Purchases and ad views among already-filtered events."""
    return iap_transactions_from_master(ev), ad_impressions_from_master(ev)


# ---- KPI queries --------------------------------------------------------------


def q_retention(spark, sf_dir):
    return retention.retention(_t(spark, sf_dir).master_events())


def q_retention_rates(spark, sf_dir):
    return retention.retention_rates(_t(spark, sf_dir).master_events())


def q_retention_matrix(spark, sf_dir):
    return retention.retention_matrix(_t(spark, sf_dir).master_events())


def q_economy_by_level(spark, sf_dir):
    return economy.economy_by_level(_t(spark, sf_dir).master_events())


def q_economy_flow(spark, sf_dir):
    return economy.economy_flow(_t(spark, sf_dir).master_events(), sinks=FLOW_SINKS)


def q_wallet_balance(spark, sf_dir):
    return economy.wallet_balance(_t(spark, sf_dir).master_events(), sinks=FLOW_SINKS).drop("event_ts")


def q_dau_sessions(spark, sf_dir):
    return engagement.dau(_t(spark, sf_dir).raw_events())


def q_mau_sessions(spark, sf_dir):
    return engagement.mau(_t(spark, sf_dir).raw_events())


def q_engagement(spark, sf_dir):
    return engagement.engagement(_t(spark, sf_dir).raw_events())


def q_difficulty(spark, sf_dir):
    return difficulty.difficulty(_t(spark, sf_dir).master_events())


def q_pinch_points(spark, sf_dir):
    return difficulty.pinch_points(_t(spark, sf_dir).master_events(), threshold=PINCH_THRESHOLD)


def q_monetization_daily(spark, sf_dir):
    return monetization.monetization_daily(_t(spark, sf_dir).master_events())


def q_user_ltv(spark, sf_dir):
    ltv = monetization.user_ltv(_t(spark, sf_dir).master_events())
    return ltv.select("user_id", round_money("total_ltv").alias("total_ltv"))


def q_installs(spark, sf_dir):
    ua = _t(spark, sf_dir).user_acquisition()
    m = monetization.installs(ua, *INSTALL_WINDOW)
    return m.select("user_id", "source", round_money("cpi").alias("cpi"), "install_date")


def q_ua_roas(spark, sf_dir):
    t = _t(spark, sf_dir)
    return monetization.ua_roas(t.master_events(), t.user_acquisition(), *INSTALL_WINDOW)


# ---- dashboard marts -------------------------------------------------------


def _users(t: DriverTables) -> DataFrame:
    return audience.user_revenue_from_events(t.user_acquisition(), t.master_events())


def q_user_revenue(spark, sf_dir):
    return audience.user_revenue_report(_users(_t(spark, sf_dir)))


def q_tiers(spark, sf_dir):
    return audience.tiers(_t(spark, sf_dir).user_acquisition())


def q_tier_filtered_events(spark, sf_dir):
    ev = audience.filter_tagged_by_tier(_t(spark, sf_dir).acquired_events(), TIER_SUBSET)
    return ev.select("event_id", "user_id", "event_name")


def q_reporting_period(spark, sf_dir):
    return audience.reporting_period(_t(spark, sf_dir).user_acquisition())


def q_dau_any_event(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return engagement.dau_any_event(ev)


def q_headline_kpis(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return audience.headline_kpis_from_events(ev, ua)


def q_tier_distribution(spark, sf_dir):
    return audience.tier_distribution(_users(_t(spark, sf_dir)))


def q_user_max_level(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return progression.user_max_level(ev)


def q_level_funnel(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return progression.level_funnel(ev, FUNNEL_LEVELS)


def q_churn_levels(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return progression.churn_levels(ev, CHURN_LEVELS)


def q_level_outcomes(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return progression.level_outcomes(ev, OUTCOME_LEVELS)


def q_payer_kpis(spark, sf_dir):
    return revenue.payer_kpis(_users(_t(spark, sf_dir)))


# D15-D17 read purchases and ad views from the tagged events, which carry
# the user's tier and install date: no fact-to-user join.
TAGS = ("tier", "install_date")


def q_iap_day_diff(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    d = revenue.with_day_diff(iap_transactions_from_master(ev, TAGS))
    return d.select("user_id", "tier", "day_diff", round_money("price").alias("price"))


def q_revenue_by_tier_day(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    r = revenue.tier_day_sums(revenue.with_day_diff(revenue.revenue_facts(ev)))
    return r.select("tier", "day_diff", round_money("rev").alias("rev"))


def q_ltv_curve(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    sums = revenue.tier_day_sums(revenue.with_day_diff(revenue.revenue_facts(ev)))
    return revenue.ltv_curve_of(sums, ua, LTV_DAYS)


def q_ltv_curve_all_days(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return revenue.ltv_curve_of(revenue.tier_day_sums(revenue.with_day_diff(revenue.revenue_facts(ev))), ua)


def q_ltv_revenue_outside(spark, sf_dir):
    """What the report's curve of days 0 to 30 leaves out."""
    t, ev, ua = _dashboard(spark, sf_dir)
    sums = revenue.tier_day_sums(revenue.with_day_diff(revenue.revenue_facts(ev)))
    return revenue.revenue_outside_days(sums, LTV_DAYS)


def q_level_funnel_all(spark, sf_dir):
    return progression.level_funnel(_dashboard(spark, sf_dir)[1])


def q_churn_levels_all(spark, sf_dir):
    return progression.churn_levels(_dashboard(spark, sf_dir)[1])


def q_level_outcomes_all(spark, sf_dir):
    return progression.level_outcomes(_dashboard(spark, sf_dir)[1])


def q_economy_flow_by_level(spark, sf_dir):
    """C04 by date and level."""
    ev = _t(spark, sf_dir).master_events()
    return economy.economy_flow(ev, sinks=FLOW_SINKS, by=("event_date", "level_id"))


def q_revenue_by_user(spark, sf_dir):
    """Purchases per user."""
    spent = audience.revenue_by_user(_t(spark, sf_dir).iap(), "price", "revenue")
    return spent.select("user_id", round_money("revenue").alias("revenue"))


def q_revenue_by_pack(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return revenue.revenue_by_pack(_facts(ev)[0])


def q_revenue_by_placement(spark, sf_dir):
    t, ev, ua = _dashboard(spark, sf_dir)
    return revenue.revenue_by_placement(_facts(ev)[1])


# ---- nested log: parse, flatten, explode ------------------------------------


def q_raw_events_flatten(spark, sf_dir):
    me = build_master_events(parsed_raw_events(spark, sf_dir), keep=("event_id",))
    return me.select(
        "event_id",
        "user_id",
        "event_date",
        "event_name",
        "level_id",
        "win_loss_status",
        "gold_earned",
        round_money("revenue").alias("revenue"),
        "gold_reward",
        "placement",
        "product_id",
    )


def q_param_lookup(spark, sf_dir):
    """Typed lookups in the packed log, including a key no event has
    (NULL, not an error)."""
    raw = _t(spark, sf_dir).raw_events()
    return raw.select(
        "event_id",
        param("level_id", "int").alias("level_id"),
        param("price", "double").alias("price"),
        param("status", "string").alias("status"),
        param("no_such_key", "string").alias("missing"),
    )


# master_events column -> (packed key, typed field, type) for the round trip
ROUNDTRIP_SPEC = {
    "level_id": ("level_id", "int", "int"),
    "win_loss_status": ("status", "string", "string"),
    "gold_earned": ("gold_earned", "int", "bigint"),
    "gold_reward": ("gold_reward", "int", "bigint"),
    "revenue": ("price", "double", "decimal(18,2)"),
    "ad_revenue": ("ad_revenue", "double", "decimal(18,2)"),
    "pack": ("product_id", "string", "string"),
    "placement": ("placement", "string", "string"),
    "duration": ("duration", "double", "double"),
}


def q_params_roundtrip(spark, sf_dir):
    """N02 then N03: typed columns packed into key/value params and
    flattened back give the original columns."""
    raw = _t(spark, sf_dir).raw_events()
    spec = {c: (k, kind) for c, (k, kind, _) in ROUNDTRIP_SPEC.items()}
    flat = flatten_params(raw.select("event_id", "event_params"), spec, cast={c: t for c, (_, _, t) in ROUNDTRIP_SPEC.items()})
    return flat.select(
        "event_id",
        *[round_money(c).alias(c) if ROUNDTRIP_SPEC[c][2].startswith("decimal") else F.col(c) for c in ROUNDTRIP_SPEC],
    )


def q_params_exploded(spark, sf_dir):
    raw = _t(spark, sf_dir).raw_events()
    return explode_params(raw, keep=("event_id",))


def q_events_since(spark, sf_dir):
    raw = _t(spark, sf_dir).raw_events()
    return events_since(raw, SINCE_YYYYMMDD).select("event_id", "event_date")


# ---- CSV sources: written once per source version, read back ----------------

FLAT_CSV_COLUMNS = [
    "event_date", "event_timestamp", "event_name", "user_id", "country", "os",
    "level_id", "status", "weapon_used", "gold_earned", "price", "product_id",
]


def _flat_csv(spark, sf_dir) -> str:
    """The flat events CSV. Integer columns with gaps are written as
    doubles (``1.0``), as a dataframe writer with missing values does."""
    t = _t(spark, sf_dir)
    me = t.master_events()
    flat = me.select(
        F.date_format("event_date", "yyyyMMdd").alias("event_date"),
        F.unix_micros("event_ts").alias("event_timestamp"),
        "event_name",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("level_id").cast("double").alias("level_id"),
        F.col("win_loss_status").alias("status"),
        F.col("gold_earned").cast("double").alias("gold_earned"),
        F.col("revenue").cast("double").alias("price"),
        F.col("pack").alias("product_id"),
    )
    folder, _ = staged_folder(spark, "flat_events_csv", [t._path("events")], lambda p: write_csv(flat, p, FLAT_CSV_COLUMNS), flat)
    return folder


def q_flat_events_csv(spark, sf_dir):
    df = read_flat_events(spark, _flat_csv(spark, sf_dir))
    return df.select(
        "event_date", "event_name", "user_id", "level_id", "win_loss_status", "gold_earned",
        round_money("revenue").alias("revenue"), "product_id",
    )


def q_acquisition_csv(spark, sf_dir):
    t = _t(spark, sf_dir)
    ua = t.user_acquisition().select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("install_date").cast("string").alias("install_date"),
        "source", "campaign_id", F.col("cpi").cast("double").alias("cpi"), "tier",
    )
    folder, _ = staged_folder(
        spark, "user_acquisition_csv", [t._path("events"), t._path("customer")],
        lambda p: write_csv(ua, p, ua.columns), ua,
    )
    back = read_user_acquisition(spark, folder)
    return back.select("user_id", "install_date", "source", "campaign_id", round_money("cpi").alias("cpi"), "tier")


def q_raw_log_files(spark, sf_dir):
    """S07 then S01: the nested log written as NDJSON files (once per
    source version), read back with the explicit schema and staged."""
    t = _t(spark, sf_dir)
    raw = t.raw_events().drop("event_id")
    folder, _ = staged_folder(spark, "raw_log_json", [t._path("events")], lambda p: write_raw_events(raw, p), raw)
    me = build_master_events(read_raw_events(spark, folder))
    return me.select(
        "user_id", "event_date", "event_name", "level_id", "win_loss_status", "gold_earned",
        round_money("revenue").alias("revenue"), "gold_reward", "placement", "product_id",
    )


def q_stream_dau_exact(spark, sf_dir):
    from ..streaming.jobs import run_stream_dau_on_driver_tables

    return run_stream_dau_on_driver_tables(spark, sf_dir)


def q_stream_economy_daily(spark, sf_dir):
    from ..streaming.jobs import run_stream_economy_on_driver_tables

    return run_stream_economy_on_driver_tables(spark, sf_dir, FLOW_SINKS)


def _engine(fn: Query) -> Query:
    """Run a query with the engine's session settings applied."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_engine_conf(spark)
        partitions_for_input(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("events", "customer")])
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def q_stream_level_outcomes_daily(spark, sf_dir):
    from ..streaming.jobs import run_stream_level_outcomes_on_driver_tables

    return run_stream_level_outcomes_on_driver_tables(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "retention_d1_d3_d7": _engine(q_retention),
    "retention_rate_d1_d7_d30": _engine(q_retention_rates),
    "retention_matrix": _engine(q_retention_matrix),
    "economy_by_level": _engine(q_economy_by_level),
    "economy_flow": _engine(q_economy_flow),
    "wallet_balance": _engine(q_wallet_balance),
    "dau_sessions": _engine(q_dau_sessions),
    "mau_sessions": _engine(q_mau_sessions),
    "engagement_stickiness": _engine(q_engagement),
    "difficulty_curve": _engine(q_difficulty),
    "pinch_points": _engine(q_pinch_points),
    "monetization_daily": _engine(q_monetization_daily),
    "user_ltv": _engine(q_user_ltv),
    "installs_window": _engine(q_installs),
    "ua_roas": _engine(q_ua_roas),
    "user_revenue": _engine(q_user_revenue),
    "tiers": _engine(q_tiers),
    "tier_filtered_events": _engine(q_tier_filtered_events),
    "reporting_period": _engine(q_reporting_period),
    "dau_any_event": _engine(q_dau_any_event),
    "headline_kpis": _engine(q_headline_kpis),
    "tier_distribution": _engine(q_tier_distribution),
    "user_max_level": _engine(q_user_max_level),
    "level_funnel": _engine(q_level_funnel),
    "churn_levels": _engine(q_churn_levels),
    "level_outcomes": _engine(q_level_outcomes),
    "payer_kpis": _engine(q_payer_kpis),
    "iap_day_diff": _engine(q_iap_day_diff),
    "revenue_by_tier_day": _engine(q_revenue_by_tier_day),
    "ltv_curve": _engine(q_ltv_curve),
    "ltv_curve_all_days": _engine(q_ltv_curve_all_days),
    "ltv_revenue_outside": _engine(q_ltv_revenue_outside),
    "level_funnel_all": _engine(q_level_funnel_all),
    "churn_levels_all": _engine(q_churn_levels_all),
    "level_outcomes_all": _engine(q_level_outcomes_all),
    "economy_flow_by_level": _engine(q_economy_flow_by_level),
    "revenue_by_user": _engine(q_revenue_by_user),
    "revenue_by_pack": _engine(q_revenue_by_pack),
    "revenue_by_placement": _engine(q_revenue_by_placement),
    "raw_events_flatten": _engine(q_raw_events_flatten),
    "param_lookup": _engine(q_param_lookup),
    "params_roundtrip": _engine(q_params_roundtrip),
    "params_exploded": _engine(q_params_exploded),
    "events_since": _engine(q_events_since),
    "raw_log_files": _engine(q_raw_log_files),
    "flat_events_csv": _engine(q_flat_events_csv),
    "acquisition_csv": _engine(q_acquisition_csv),
    "stream_dau_exact": _engine(q_stream_dau_exact),
    "stream_economy_daily": _engine(q_stream_economy_daily),
    "stream_level_outcomes_daily": _engine(q_stream_level_outcomes_daily),
    **{name: _engine(fn) for name, fn in {**FILE_QUERIES, **LIVE_QUERIES, **WAREHOUSE_QUERIES}.items()},
}
