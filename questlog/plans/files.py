"""Registered runs that start from files: the source's CSVs and NDJSON log
written from the driver tables, read back and taken through the marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_money
from ..operators import audience, economy, engagement, revenue
from ..operators.staging import build_master_events, quarantine
from ..schemas import LEVEL_FAIL
from ..session import scratch_path
from ..sources.driver_tables import DriverTables, ad_impressions_from_master, iap_transactions_from_master
from ..sources.readers import load_dashboard_sources, read_raw_events, register_views
from ..sources.sinks import write_csv, write_mart, write_raw_events
from ..sources.staged import staged_folder

FLOW_SINKS = {LEVEL_FAIL: 10}
# Lines that no reader should take for events.
BAD_LINES = ("{", "{}", "[1, 2]", '{"event_date": "2024-01-05", "event_name": "session_start"}', '{"event_date": "20240105"}')


def _dashboard_folder(spark: SparkSession, sf_dir: str) -> str:
    """The four CSV inputs of the dashboard in one folder."""
    t = DriverTables(spark, sf_dir)
    user = F.col("user_id").cast("string").alias("user_id")
    time = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")
    tables = {
        "user_acquisition": t.user_acquisition().select(
            user, F.col("install_date").cast("string").alias("install_date"), "source", "campaign_id", F.col("cpi").cast("double").alias("cpi"), "tier"
        ),
        "iap_transactions": t.iap().select(user, time, F.col("price").cast("double").alias("price"), "pack"),
        "ad_impressions": t.ads().select(user, time, F.col("revenue").cast("double").alias("revenue"), "placement"),
        "user_events_flat": t.master_events().select(
            F.date_format("event_date", "yyyyMMdd").alias("event_date"), F.unix_micros("event_ts").alias("event_timestamp"), "event_name", user,
            F.col("level_id").cast("double").alias("level_id"), F.col("win_loss_status").alias("status"),
            F.col("gold_earned").cast("double").alias("gold_earned"), F.col("revenue").cast("double").alias("price"), F.col("pack").alias("product_id"),
        ),
    }

    def write(path: str) -> None:
        for name, df in tables.items():
            write_csv(df, f"{path}/{name}.csv", df.columns)

    one = tables["user_acquisition"]
    folder, _ = staged_folder(spark, "dashboard_csv", [t._path("events"), t._path("customer")], write, one)  # noqa: SLF001
    return folder


def _sources(spark, sf_dir) -> dict[str, DataFrame]:
    folder = _dashboard_folder(spark, sf_dir)
    return load_dashboard_sources(spark, [f"{folder}/not-here", folder])


def q_iap_csv(spark, sf_dir):
    """Purchases written as CSV and read back."""
    return _sources(spark, sf_dir)["iap_transactions"].select("user_id", "timestamp", round_money("price").alias("price"), "pack")


def q_ads_csv(spark, sf_dir):
    """Ad views written as CSV and read back."""
    return _sources(spark, sf_dir)["ad_impressions"].select("user_id", "timestamp", round_money("revenue").alias("revenue"), "placement")


def q_files_user_revenue(spark, sf_dir):
    """S03 to S06 into D02."""
    s = _sources(spark, sf_dir)
    return audience.user_revenue_report(audience.user_revenue(s["user_acquisition"], s["iap_transactions"], s["ad_impressions"]))


def q_files_revenue_by_tier_day(spark, sf_dir):
    """S03 to S06 into D16: summed per user and day before the join."""
    s = _sources(spark, sf_dir)
    r = revenue.revenue_by_tier_day(s["iap_transactions"], s["ad_impressions"], s["user_acquisition"])
    return r.select("tier", "day_diff", round_money("rev").alias("rev"))


def _log(spark: SparkSession, sf_dir: str, bad: bool = False) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    raw = t.raw_events().drop("event_id")

    def write(path: str) -> None:
        write_raw_events(raw, path)
        if bad:
            lines = t.master_events().where("event_id % 100 = 0").select(F.explode(F.array(*map(F.lit, BAD_LINES))).alias("value"))
            lines.write.mode("append").text(path)

    folder, _ = staged_folder(spark, "raw_log_bad" if bad else "raw_log_json", [t._path("events")], write, raw)  # noqa: SLF001
    return read_raw_events(spark, folder)


def q_log_wallet_balance(spark, sf_dir):
    """The NDJSON log into C05: hashed event ids break ties."""
    wallet = economy.wallet_balance(build_master_events(_log(spark, sf_dir)), sinks=FLOW_SINKS)
    return wallet.select("user_id", "event_ts", "delta", "balance")


def q_log_user_revenue(spark, sf_dir):
    """The NDJSON log into D02."""
    ua = DriverTables(spark, sf_dir).user_acquisition().withColumn("user_id", F.col("user_id").cast("string"))
    return audience.user_revenue_report(audience.user_revenue_from_events(ua, build_master_events(_log(spark, sf_dir))))


def q_log_headline_kpis(spark, sf_dir):
    """The NDJSON log into D07."""
    ua = DriverTables(spark, sf_dir).user_acquisition().withColumn("user_id", F.col("user_id").cast("string"))
    ev = audience.filter_by_tier(build_master_events(_log(spark, sf_dir)), ua)
    return audience.headline_kpis_from_events(ev, ua)


def q_log_ltv_curve(spark, sf_dir):
    """The NDJSON log into D17."""
    ua = DriverTables(spark, sf_dir).user_acquisition().withColumn("user_id", F.col("user_id").cast("string"))
    ev = build_master_events(_log(spark, sf_dir))
    return revenue.ltv_curve(iap_transactions_from_master(ev), ad_impressions_from_master(ev), ua, 30)


def q_log_quarantine(spark, sf_dir):
    """A log with bad lines: how many rows are events, and how many are put aside."""
    raw = _log(spark, sf_dir, bad=True)
    kept = build_master_events(raw).select(F.lit("events").alias("side"))
    aside = quarantine(raw.select("event_date", "event_name", "_corrupt_record")).select(F.lit("quarantine").alias("side"))
    return kept.unionByName(aside).groupBy("side").agg(F.count("*").alias("n"))


def q_nested_structs(spark, sf_dir):
    """Struct fields of the log, filled from the customers' columns."""
    t = DriverTables(spark, sf_dir)
    people = t.customer().select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.struct(F.col("c_nationkey").cast("string").alias("country"), F.col("c_name").alias("city")).alias("geo"),
        F.struct(F.lit("mobile").alias("category"), F.col("c_mktsegment").alias("mobile_os")).alias("device"),
    )
    raw = t.raw_events().drop("geo", "device").join(people, "user_id", "left")
    me = build_master_events(raw, keep=("event_id",))
    return me.select("event_id", "country", "city", "os", "device_category")


def q_mart_replaced_day(spark, sf_dir):
    """A mart written by day, one day written again, the others untouched."""
    flow = economy.economy_flow(DriverTables(spark, sf_dir).master_events(), sinks=FLOW_SINKS)
    path = scratch_path(spark, "marts", uuid.uuid4().hex)
    day = F.col("event_date") == F.lit("2024-01-10").cast("date")
    wrong = F.when(day, F.lit(-1).cast("long")).otherwise(F.col("net_flow"))
    write_mart(flow.withColumn("net_flow", wrong), path)
    write_mart(flow.where(day), path)
    return spark.read.schema(flow.schema).parquet(path)


def q_views_sql(spark, sf_dir):
    """SQL over DataFrames registered by name."""
    t = DriverTables(spark, sf_dir)
    register_views(spark, {"questlog_events": t.master_events(), "questlog_users": t.user_acquisition()})
    return spark.sql(
        """SELECT u.source, e.event_name, count(*) AS events, count(DISTINCT e.user_id) AS users
        FROM questlog_events e JOIN questlog_users u ON e.user_id = u.user_id GROUP BY u.source, e.event_name"""
    )


def q_stream_pinch_alert(spark, sf_dir):
    """T05."""
    from ..streaming.jobs import run_stream_pinch_alert_on_driver_tables

    return run_stream_pinch_alert_on_driver_tables(spark, sf_dir, 0.48)


def q_stream_dau_approx(spark, sf_dir):
    """Whether each day's approximate DAU is within its bound (three
    standard errors of 5 %, and one user) of the exact one."""
    from ..streaming.jobs import run_stream_dau_approx_on_driver_tables

    approx = run_stream_dau_approx_on_driver_tables(spark, sf_dir)
    exact = engagement.dau(DriverTables(spark, sf_dir).raw_events())
    within = F.abs(F.col("dau_approx") - F.col("dau")) <= 0.15 * F.col("dau") + 1
    return exact.join(approx, "date", "left").select("date", F.coalesce(within, F.lit(False)).alias("within_bound"))


FILE_QUERIES = {
    "iap_csv": q_iap_csv,
    "ads_csv": q_ads_csv,
    "files_user_revenue": q_files_user_revenue,
    "files_revenue_by_tier_day": q_files_revenue_by_tier_day,
    "log_wallet_balance": q_log_wallet_balance,
    "log_user_revenue": q_log_user_revenue,
    "log_headline_kpis": q_log_headline_kpis,
    "log_ltv_curve": q_log_ltv_curve,
    "log_quarantine": q_log_quarantine,
    "nested_structs": q_nested_structs,
    "mart_replaced_day": q_mart_replaced_day,
    "views_sql": q_views_sql,
    "stream_pinch_alert": q_stream_pinch_alert,
    "stream_dau_approx": q_stream_dau_approx,
}
