"""Every registered query against its DuckDB oracle (sf0.001), and plan
checks (no all-pairs joins, no Python UDFs, no Expand; scans pruned)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E  # noqa: E402
from questlog.plans.catalog import QUERIES  # noqa: E402
from questlog.plans.oracle import ORACLE  # noqa: E402
from conftest import SF_SMALL
from questlog.plans.explain import inspect, pushed_filters, read_schema_of_scans

SKIP_PLAN = {"stream_dau_exact", "stream_economy_daily", "stream_level_outcomes_daily"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def sort_key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["cohort_date", "cohort_size", "d1_retention", "d3_retention", "d7_retention"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=sort_key)
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [x[0] for x in rel.description]
    assert sorted(ocols) == cols
    idx = {c: i for i, c in enumerate(ocols)}
    want = sorted((tuple(norm(r[idx[c]]) for c in cols) for r in rel.fetchall()), key=sort_key)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP_PLAN))
def test_plan_has_no_forbidden_nodes(spark, name):
    rep = inspect(E.queries()[name](spark, SF_SMALL))
    assert rep.ok, rep.forbidden


def test_scan_is_pruned_and_filter_pushed(spark):
    df = E.queries()["difficulty_curve"](spark, SF_SMALL)
    assert read_schema_of_scans(df) == ["struct<event_name:string,level_id:bigint,win_loss_status:string>"]
    assert any("event_name" in f for f in pushed_filters(df))
    df = E.queries()["revenue_by_pack"](spark, SF_SMALL)
    filters = " ".join(pushed_filters(df))
    assert "EqualTo(in_ua,true)" in filters and "EqualTo(event_name,iap_purchase)" in filters
    assert "Join" not in inspect(df).text  # the dashboard tier filter is a scan filter, not a join


def test_configure_for_input_sizes_partitions(spark):
    from questlog.session import configure_for_input, input_bytes

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        path = os.path.join(SF_SMALL, "events.parquet")
        assert input_bytes(spark, [path]) > 0
        n = configure_for_input(spark, [path], bytes_per_partition=1024)
        assert n == max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, [path]) // 1024))
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
