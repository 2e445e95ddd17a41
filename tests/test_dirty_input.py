"""Readers and staging on input that the driver's tables don't have."""

from __future__ import annotations

import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from questlog.functions.params import flatten_params, param
from questlog.operators.staging import build_master_events, quarantine
from questlog.plans.explain import inspect
from questlog.schemas import MASTER_EVENTS_COLUMNS
from questlog.sources import readers


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_files_of_different_headers(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "flat")
    write(f"{folder}/a.csv", "event_date,event_timestamp,event_name,user_id,level_id", "20251101,1761955200000000,level_fail,u1,2.0")
    write(f"{folder}/b.csv", "level_id,user_id,event_name,event_date", "3.0,u2,level_fail,20251102")
    write(f"{folder}/c.csv", "event_date,event_timestamp,event_name,user_id,level_id", "20251103,1761955200000000,level_fail,u3,4.0")
    got = readers.read_flat_events(spark, folder).orderBy("user_id").collect()
    assert [(r.user_id, str(r.event_date), r.event_name, r.level_id) for r in got] == [
        ("u1", "2025-11-01", "level_fail", 2), ("u2", "2025-11-02", "level_fail", 3), ("u3", "2025-11-03", "level_fail", 4)
    ]
    assert got[1].event_ts is None and got[1].revenue is None


def test_csv_values_out_of_range_are_null(spark, tmp_dir):
    path = os.path.join(tmp_dir, "flat", "a.csv")
    write(path, "event_date,event_name,user_id,level_id,gold_earned,price", "20251101,x,u1,NaN,NaN,1e17", "20251101,x,u2,3000000000,1e300,5", "bad,x,u3,x,y,z")
    got = {r.user_id: r for r in readers.read_flat_events(spark, path).collect()}
    assert got["u1"].level_id is None and got["u1"].gold_earned is None and got["u1"].revenue is None
    assert got["u2"].level_id == 3_000_000_000 and got["u2"].gold_earned is None and got["u2"].revenue == Decimal("5.00")
    assert got["u3"].event_date is None and got["u3"].revenue is None
    for name, read, column in (("ua", readers.read_user_acquisition, "cpi"), ("iap", readers.read_iap, "price"), ("ads", readers.read_ads, "revenue")):
        file = os.path.join(tmp_dir, name, "a.csv")
        write(file, f"user_id,{column}", "u,1e17")
        assert read(spark, file).first()[column] is None


def event(name="iap_purchase", date="20251101", **params):
    entries = [{"key": k, "value": v} for k, v in params.items()]
    row = {"event_date": date, "event_timestamp": 1761955200000000, "user_id": "u", "user_pseudo_id": "u", "event_params": entries}
    return json.dumps(row | ({"event_name": name} if name else {}))


def test_log_lines_that_are_no_events(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log", "a.json")
    write(path, event(price={"int_value": 5}), "{}", "{", event(name=None), event(date="2025-11-01"), event(level_id={"int_value": 3_000_000_000}, price={"float_value": 1e17}))
    raw = readers.read_raw_events(spark, path)
    me = build_master_events(raw)
    got = sorted((r.revenue, r.level_id) for r in me.where("revenue is not null").collect())
    assert got == [(Decimal("5.00"), None)]  # a whole price is logged as an int
    assert me.count() == 2 and me.where("level_id = 3000000000 and revenue is null").count() == 1
    assert quarantine(raw.select("event_date", "event_name", "_corrupt_record")).count() == 4
    assert set(MASTER_EVENTS_COLUMNS) <= set(me.columns)
    assert me.select("event_id").distinct().count() == 2 and me.where("event_id is null").count() == 0


def test_params_are_found_by_position(spark):
    df = spark.range(1).select(
        F.expr("array(named_struct('key', 'a', 'value', named_struct('int_value', 1L, 'float_value', null, 'double_value', null, 'string_value', 'x')))").cast(
            "array<struct<key:string,value:struct<int_value:bigint,float_value:double,double_value:double,string_value:string>>>"
        ).alias("event_params")
    )
    assert tuple(df.select(param("a", "int"), param("a", "double"), param("a"), param("b")).first()) == (1, 1.0, "x", None)
    assert df.select(F.lit(None).cast(df.schema[0].dataType).alias("event_params")).select(param("a")).first()[0] is None
    plan = inspect(flatten_params(df, {c: (c, "double") for c in "abcdef"})).text
    assert "filter(" not in plan.lower().replace("filter (", "")
