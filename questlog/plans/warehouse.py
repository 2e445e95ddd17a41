"""The tables by name, in the catalog with partitions and column statistics, and the six KPI reports as
SQL functions of their parameters: ``SELECT * FROM ua_roas_kpi(DATE'2024-01-01', DATE'2024-01-30')``."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..functions.numeric import round_money
from ..operators import audience, monetization, rollups
from ..schemas import IAP_PURCHASE, LEVEL_COMPLETE, RAW_EVENTS, SESSION_START
from ..session import scratch_path
from ..sources.bucketed import append_bucketed, buckets_for, read_bucketed
from ..sources.driver_tables import ACQUIRED_EVENTS_DDL, INSTALL_WINDOW, USER_ACQUISITION_DDL, DriverTables
from ..sources.sinks import write_raw_events
from ..sources.staged import staged_folder

# Columns the reports filter, join or group by: their statistics are kept.
STATISTICS = {"master_events": "user_id, event_name, level_id", "user_acquisition": "user_id, source, install_date"}


def catalog_tables(spark: SparkSession, database: str, places: dict[str, tuple[str, str, str, str]]) -> None:
    """Register external tables: name -> (columns DDL, format, partition column or '', folder). Files stay where they are; a
    table that is registered already is left as it is."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{scratch_path(spark, 'catalog', database)}'")
    for name, (columns, kind, partition, folder) in places.items():
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table):
            continue
        by = f"PARTITIONED BY ({partition})" if partition else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {kind} {by} LOCATION '{folder}'")
        if partition:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        if name in STATISTICS:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {STATISTICS[name]}")


def _ratio(n: str, d: str, digits: int, n_scale: int = 0, d_scale: int = 0) -> str:
    """SQL: exact quotient, rounded; NULL where the divisor is 0 or NULL."""
    return f"CAST(round(try_divide(CAST({n} AS DECIMAL(24,{n_scale})), CAST({d} AS DECIMAL(24,{d_scale}))), {digits}) AS DOUBLE)"


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,2)) AS DOUBLE)"


def report_functions(database: str) -> dict[str, str]:
    """Name -> definition of each report over the tables of ``database``."""
    ev, raw, ua = (f"{database}.{t}" for t in ("master_events", "raw_events", "user_acquisition"))
    return {
        "retention_kpi(first INT, second INT, third INT) RETURNS TABLE (cohort_date DATE, cohort_size BIGINT, first_back BIGINT, second_back BIGINT, third_back BIGINT)": f"""
            SELECT began, count_if(u IS NOT NULL AND day <=> began), count_if(u IS NOT NULL AND b1), count_if(u IS NOT NULL AND b2), count_if(u IS NOT NULL AND b3)
            FROM (SELECT u, day, began, date_diff(day, began) = first AS b1, date_diff(day, began) = second AS b2, date_diff(day, began) = third AS b3
              FROM (SELECT u, day, min(day) OVER (PARTITION BY u) AS began
                FROM (SELECT user_pseudo_id AS u, event_date AS day FROM {ev} GROUP BY ALL)))
            GROUP BY began""",
        "economy_balance(event STRING) RETURNS TABLE (level_id BIGINT, players_reached BIGINT, total_gold_source BIGINT, avg_gold_per_level DOUBLE, gold_per_user DOUBLE)": f"""
            SELECT level, players, gold, {_ratio("gold", "paid", 0)}, {_ratio("gold", "players", 0)}
            FROM (SELECT level_id AS level, count(DISTINCT user_id) AS players, sum(gold_earned) AS gold, count(gold_earned) AS paid
              FROM {ev} WHERE event_name = event AND level_id IS NOT NULL GROUP BY level_id)""",
        "engagement_kpi(event STRING) RETURNS TABLE (date DATE, dau BIGINT, mau BIGINT, stickiness_percent DOUBLE)": f"""
            WITH days AS (SELECT try_to_date(event_date, 'yyyyMMdd') AS day, user_pseudo_id AS u FROM {raw} WHERE event_name = event GROUP BY ALL),
              daily AS (SELECT day, count(u) AS users FROM days GROUP BY day),
              monthly AS (SELECT trunc(day, 'MM') AS month, count(DISTINCT u) AS users FROM days GROUP BY ALL)
            SELECT day, daily.users, monthly.users, {_ratio("daily.users * 100", "monthly.users", 2)}
            FROM daily LEFT JOIN monthly ON trunc(day, 'MM') = month""",
        "difficulty_kpi() RETURNS TABLE (level_id BIGINT, total_attempts BIGINT, wins BIGINT, fails BIGINT, win_rate DOUBLE, fail_rate DOUBLE)": f"""
            SELECT level, tries, won, lost, {_ratio("won", "tries", 2)}, {_ratio("lost", "tries", 2)}
            FROM (SELECT level_id AS level, count(*) AS tries, count_if(win_loss_status = 'Win') AS won, count_if(win_loss_status = 'Fail') AS lost
              FROM {ev} WHERE event_name IN ('level_complete', 'level_fail') AND level_id IS NOT NULL GROUP BY level_id)""",
        "monetization_kpi(purchase STRING) RETURNS TABLE (event_date DATE, dau BIGINT, paying_users BIGINT, total_revenue DOUBLE, arpu DOUBLE, arppu DOUBLE, conversion_rate DOUBLE)": f"""
            SELECT day, users, payers, {_money("coalesce(spent, 0)")}, {_ratio("spent", "users", 3, 2)}, {_ratio("spent", "payers", 3, 2)}, {_ratio("payers", "users", 4)}
            FROM (SELECT day, count(u) AS users, count_if(u IS NOT NULL AND paid) AS payers, sum(spent) AS spent
              FROM (SELECT day, u, max(bought) AS paid, sum(revenue) AS spent
                FROM (SELECT event_date AS day, user_id AS u, event_name = purchase AS bought, revenue FROM {ev}) GROUP BY day, u)
              GROUP BY day)""",
        "ua_roas_kpi(from_day DATE, to_day DATE, purchase STRING) RETURNS TABLE (source STRING, installs BIGINT, total_spend DOUBLE, total_revenue DOUBLE, avg_cpi DOUBLE, arpu DOUBLE, roas_percentage DOUBLE)": f"""
            WITH ltv AS (SELECT user_id AS u, sum(revenue) AS spent FROM {ev} WHERE event_name = purchase GROUP BY user_id),
              sums AS (SELECT source AS via, count(DISTINCT user_id) AS users, sum(cpi) AS cost, sum(coalesce(spent, 0)) AS back, count(cpi) AS priced, count(*) AS n
                FROM {ua} LEFT JOIN ltv ON user_id = u WHERE CAST(install_date AS DATE) BETWEEN from_day AND to_day GROUP BY source)
            SELECT via, users, {_money("cost")}, {_money("back")}, {_ratio("cost", "priced", 2, 2)}, {_ratio("back", "n", 2, 2)}, {_ratio("back * 100", "cost", 2, 2, 2)}
            FROM sums""",
    }


def register_reports(spark: SparkSession, database: str) -> None:
    """The reports as functions of this session, over the tables of ``database``."""
    for head, body in report_functions(database).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def driver_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """The driver's tables and the reports over them; returns the database, one for each version of the tables."""
    t = DriverTables(spark, sf_dir)
    raw = t.raw_events().drop("event_id")
    log, _ = staged_folder(spark, "raw_log_json", [t._path("events")], lambda p: write_raw_events(raw, p), raw)  # noqa: SLF001
    facts, users = t.acquired_events_place(), t.user_acquisition_place()
    database = "questlog_" + hashlib.sha1(f"{facts} {users} {log}".encode()).hexdigest()[:12]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_EVENTS.fields)
    catalog_tables(
        spark,
        database,
        {
            "master_events": (ACQUIRED_EVENTS_DDL, "parquet", "event_date", facts),
            "user_acquisition": (USER_ACQUISITION_DDL, "parquet", "", users),
            "raw_events": (columns, "json", "", log),
        },
    )
    register_reports(spark, database)
    return database


def _report(call: str, names: dict[str, str] | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        driver_warehouse(spark, sf_dir)
        return spark.sql(f"SELECT * FROM {call}").withColumnsRenamed(names or {})

    run.__doc__ = f"S10: {call}."
    return run


def user_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Section 2.8: the user-day revenue and the acquisition table, both bucketed by user into the same number of buckets."""
    t = DriverTables(spark, sf_dir)
    sources = [t._path("events"), t._path("customer")]  # noqa: SLF001
    n = buckets_for(spark, sources)

    def kept(name: str, df: DataFrame) -> DataFrame:
        folder, _ = staged_folder(spark, f"bucketed_{name}_{n}", sources, lambda p: append_bucketed(spark, df, p, "user_id", n), df)
        return read_bucketed(spark, df, folder, "user_id", n)

    return kept("user_days", rollups.user_day_revenue(t.master_events())), kept("users", t.user_acquisition())


def q_bucketed_ua_roas(spark, sf_dir):
    days, ua = user_tables(spark, sf_dir)
    return monetization.ua_roas_of(rollups.ltv_of(days), ua, *INSTALL_WINDOW)


def q_bucketed_user_revenue(spark, sf_dir):
    days, ua = user_tables(spark, sf_dir)
    return audience.user_revenue_report(rollups.user_revenue_of(days, ua))


def q_bucketed_revenue_by_tier_day(spark, sf_dir):
    days, ua = user_tables(spark, sf_dir)
    r = rollups.tier_day_revenue_of(days, ua)
    return r.select("tier", "day_diff", round_money("rev").alias("rev"))


WAREHOUSE_QUERIES = {
    "bucketed_ua_roas": q_bucketed_ua_roas,
    "bucketed_user_revenue": q_bucketed_user_revenue,
    "bucketed_revenue_by_tier_day": q_bucketed_revenue_by_tier_day,
    "sql_retention": _report("retention_kpi(1, 3, 7)", {"first_back": "d1_retention", "second_back": "d3_retention", "third_back": "d7_retention"}),
    "sql_economy": _report(f"economy_balance('{LEVEL_COMPLETE}')"),
    "sql_engagement": _report(f"engagement_kpi('{SESSION_START}')"),
    "sql_difficulty": _report("difficulty_kpi()"),
    "sql_monetization": _report(f"monetization_kpi('{IAP_PURCHASE}')"),
    "sql_ua_roas": _report("ua_roas_kpi(DATE'{}', DATE'{}', '{}')".format(*INSTALL_WINDOW, IAP_PURCHASE)),
}
