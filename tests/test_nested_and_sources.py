"""Nested parameters (N01-N07) and file sources/sinks."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import d
from questlog.functions.params import explode_params, flatten_params, param, to_event_params
from questlog.operators.staging import build_master_events, events_since, quarantine
from questlog.sources import readers, sinks


def _line(event_date, name, params, user="u1", ts=1761955200000000):
    return json.dumps(
        {
            "event_date": event_date,
            "event_timestamp": ts,
            "user_id": user,
            "user_pseudo_id": "d-" + user,
            "geo": {"country": "USA", "city": "X"},
            "device": {"category": "mobile", "mobile_os": "iOS"},
            "event_name": name,
            "event_params": [{"key": k, "value": v} for k, v in params],
        }
    )


@pytest.fixture()
def log_dir(tmp_dir):
    lines = [
        _line("20251101", "level_complete", [("level_id", {"int_value": 3}), ("gold_earned", {"int_value": 120}), ("status", {"string_value": "Win"})]),
        _line("20251101", "iap_purchase", [("price", {"float_value": 4.99}), ("product_id", {"string_value": "pack_gem_4"})]),
        _line("20251101", "iap_purchase", [("price", {"double_value": 0.99})]),  # README-style double_value
        _line("20251102", "level_fail", [("level_id", {"int_value": 4}), ("level_id", {"int_value": 9})]),  # repeated key
        _line("20251102", "session_start", []),  # no params at all
        '{"event_date": "20251102", "event_name": ',  # corrupt line
        _line("2025-11-03", "session_start", []),  # date not in yyyyMMdd
    ]
    path = os.path.join(tmp_dir, "events.json")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_read_flatten_and_quarantine(spark, log_dir):
    raw = readers.read_raw_events(spark, log_dir)
    me = build_master_events(raw)
    got = [
        (r["event_date"], r["event_name"], r["level_id"], r["gold_earned"], r["win_loss_status"], r["revenue"], r["product_id"], r["os"], r["country"])
        for r in me.orderBy("event_date", "event_name", "revenue").collect()
    ]
    from decimal import Decimal

    assert got == [
        (d("2025-11-01"), "iap_purchase", None, None, None, Decimal("0.99"), None, "iOS", "USA"),
        (d("2025-11-01"), "iap_purchase", None, None, None, Decimal("4.99"), "pack_gem_4", "iOS", "USA"),
        (d("2025-11-01"), "level_complete", 3, 120, "Win", None, None, "iOS", "USA"),
        (d("2025-11-02"), "level_fail", 4, None, None, None, None, "iOS", "USA"),  # first of a repeated key
        (d("2025-11-02"), "session_start", None, None, None, None, None, "iOS", "USA"),
    ]
    bad = quarantine(raw).collect()
    assert len(bad) == 2
    assert events_since(raw, "20251102").where(F.col("_corrupt_record").isNull()).count() == 2


def test_session_past_midnight_keeps_session_date(spark, tmp_dir):
    # the session starts 2025-11-01 23:55 UTC; its level event lands at 00:07 the next day
    path = os.path.join(tmp_dir, "late.json")
    with open(path, "w") as f:
        f.write(_line("20251101", "session_start", [], ts=1762041300000000) + "\n")
        f.write(_line("20251101", "level_complete", [("level_id", {"int_value": 1})], ts=1762042020000000) + "\n")
    me = build_master_events(readers.read_raw_events(spark, path))
    got = sorted((r["event_name"], str(r["event_date"]), str(r["event_ts"].date())) for r in me.collect())
    assert got == [("level_complete", "2025-11-01", "2025-11-02"), ("session_start", "2025-11-01", "2025-11-01")]


def test_param_lookup_missing_key_is_null(spark):
    df = spark.createDataFrame([(1,)], "x int").select(
        F.array(
            F.struct(F.lit("a").alias("key"), F.struct(F.lit(5).cast("long").alias("int_value"), F.lit(None).cast("double").alias("float_value"), F.lit(None).cast("double").alias("double_value"), F.lit(None).cast("string").alias("string_value")).alias("value"))
        ).alias("event_params")
    )
    r = df.select(param("a", "int").alias("a"), param("zz", "int").alias("zz"), param("a", "string").alias("s")).first()
    assert (r["a"], r["zz"], r["s"]) == (5, None, None)


def test_pack_then_flatten_is_identity(spark):
    src = spark.createDataFrame(
        [(1, 3, "Win", 4.99, None), (2, None, None, None, "x"), (3, 7, "Fail", 0.5, "y")],
        "id long, level_id int, status string, price double, weapon string",
    )
    packed = src.select("id", to_event_params(src, ["level_id", "status", "price", "weapon"]).alias("event_params"))
    spec = {"level_id": ("level_id", "int"), "status": ("status", "string"), "price": ("price", "double"), "weapon": ("weapon", "string")}
    back = flatten_params(packed, spec, cast={"level_id": "int"}).select("id", "level_id", "status", "price", "weapon")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))
    # NULL columns produce no entry
    sizes = {r["id"]: r["n"] for r in packed.select("id", F.size("event_params").alias("n")).collect()}
    assert sizes == {1: 3, 2: 1, 3: 4}
    exploded = explode_params(packed, keep=("id",))
    assert exploded.count() == 8
    assert exploded.where("key = 'level_id'").select("int_value").orderBy("int_value").collect()[0][0] == 3


def test_flat_csv_float_integers_and_dates(spark, tmp_dir):
    path = os.path.join(tmp_dir, "user_events_flat.csv")
    with open(path, "w") as f:
        f.write("event_date,event_timestamp,event_name,user_id,country,os,level_id,status,weapon_used,gold_earned,price,product_id\n")
        f.write("20251101,1761955200000000,level_complete,u1,USA,iOS,1.0,Win,AK-47,120.0,,\n")
        f.write("20251101,1761955200000000,iap_purchase,u1,USA,iOS,,,,,4.99,pack_gem_4\n")
    df = readers.read_flat_events(spark, path).orderBy("event_name")
    r = df.collect()
    assert r[1]["level_id"] == 1 and r[1]["gold_earned"] == 120  # "1.0" is not lost
    assert r[0]["event_date"] == d("2025-11-01") and str(r[0]["revenue"]) == "4.99"


def test_csv_columns_matched_by_header_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "flat_reordered.csv")
    with open(path, "w") as f:
        f.write("event_name,user_id,gold_earned,event_date,level_id,not_ours\n")
        f.write("level_complete,u9,75.0,20251103,2.0,x\n")
        f.write("level_complete,u9,oops,20251103,,x\n")  # unparsable number: NULL, not a failure
    rows = readers.read_flat_events(spark, path).orderBy(F.col("gold_earned").desc_nulls_last()).collect()
    assert (rows[0]["user_id"], rows[0]["gold_earned"], rows[0]["level_id"], rows[0]["event_date"]) == ("u9", 75, 2, d("2025-11-03"))
    assert rows[0]["country"] is None and rows[0]["revenue"] is None  # absent columns are NULL
    assert rows[1]["gold_earned"] is None


def test_acquisition_iap_ads_readers_and_resolve(spark, tmp_dir):
    base = os.path.join(tmp_dir, "data")
    os.makedirs(base)
    with open(os.path.join(base, "user_acquisition.csv"), "w") as f:
        f.write("user_id,install_date,source,campaign_id,cpi,tier\nu1,2025-11-05,Organic,,0.0,Tier 1\nu2,2025-11-06 00:00:00,Google Ads,CMP_101,1.25,Tier 2\n")
    with open(os.path.join(base, "user_events_flat.csv"), "w") as f:
        f.write("event_date,event_timestamp,event_name,user_id\n20251105,1,session_start,u1\n")
    with open(os.path.join(base, "iap_transactions.csv"), "w") as f:
        f.write("user_id,timestamp,price,pack\nu1,2025-11-05 10:00:00,4.99,starter\n")
    with open(os.path.join(base, "ad_impressions.csv"), "w") as f:
        f.write("user_id,timestamp,revenue,placement\nu1,2025-11-05 11:00:00,0.02,End Game\n")
    with pytest.raises(FileNotFoundError):
        readers.resolve_source(spark, [os.path.join(tmp_dir, "nope")])
    found = readers.resolve_source(spark, [os.path.join(tmp_dir, "nope"), base])
    assert found == base
    tables = readers.load_dashboard_sources(spark, [base])
    ua = {r["user_id"]: r for r in tables["user_acquisition"].collect()}
    assert ua["u2"]["install_date"] == d("2025-11-06") and str(ua["u2"]["cpi"]) == "1.25"
    assert ua["u1"]["campaign_id"] is None
    assert str(tables["iap_transactions"].first()["price"]) == "4.99"
    assert tables["ad_impressions"].first()["placement"] == "End Game"
    readers.register_views(spark, tables)
    assert spark.sql("SELECT count(*) FROM user_acquisition").first()[0] == 2


def test_writers_roundtrip(spark, tmp_dir, log_dir):
    raw = readers.read_raw_events(spark, log_dir).where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    out = os.path.join(tmp_dir, "raw_out")
    sinks.write_raw_events(raw, out)
    back = readers.read_raw_events(spark, out)
    assert back.select("event_name", "event_date").count() == 6
    text = spark.read.text(out).first()[0]
    assert "null" not in text  # NULL fields are omitted
    csv_out = os.path.join(tmp_dir, "flat_out")
    me = build_master_events(raw)
    sinks.write_csv(me, csv_out, ["event_date", "event_name", "user_id", "not_a_column"])
    header = spark.read.option("header", True).csv(csv_out).columns
    assert header == ["event_date", "event_name", "user_id"]
    mart = os.path.join(tmp_dir, "mart")
    sinks.write_mart(me.select("event_date", "event_name"), mart)
    assert spark.read.parquet(mart).count() == me.count()
    # re-writing one day replaces only that day
    one_day = me.where(F.col("event_date") == "2025-11-02").select("event_date", "event_name")
    sinks.write_mart(one_day, mart)
    assert spark.read.parquet(mart).count() == me.count()
