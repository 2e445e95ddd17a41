"""Stream = batch: the streamed KPIs end equal to the batch ones."""

from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from questlog.operators import engagement
from questlog.sources.driver_tables import DriverTables
from questlog.streaming import jobs


def test_stream_dau_equals_batch(spark):
    streamed = {r["date"]: r["dau"] for r in jobs.run_stream_dau_on_driver_tables(spark, SF_SMALL).collect()}
    batch = {r["date"]: r["dau"] for r in engagement.dau(DriverTables(spark, SF_SMALL).raw_events()).collect()}
    assert streamed == batch and len(batch) > 0


def test_economy_and_pinch_streams(spark, tmp_dir):
    raw = DriverTables(spark, SF_SMALL).raw_events().drop("event_id")
    jobs.write_log_in_arrival_order(raw, os.path.join(tmp_dir, "in"))
    ev = jobs.flatten_stream(jobs.raw_event_stream(spark, os.path.join(tmp_dir, "in"), max_files_per_trigger=1))
    q = jobs.start(
        jobs.economy_window_stream(ev, delay="30 days", sink_events={"level_fail": 10}),
        jobs.batch_writer(os.path.join(tmp_dir, "eco")),
        os.path.join(tmp_dir, "ck_eco"),
    )
    q.awaitTermination()
    eco = jobs.latest_per_key(os.path.join(tmp_dir, "eco"), spark, ["window_start"], ["revenue", "gold_source", "gold_sink"])
    me = DriverTables(spark, SF_SMALL).master_events()
    want = me.agg(F.sum("revenue"), F.count_if(F.col("event_name") == "level_fail") * 10).first()
    got = eco.agg(F.sum("revenue"), F.sum("gold_sink")).first()
    assert got[0] == want[0] and got[1] == want[1]

    q = jobs.start(
        jobs.level_outcome_stream(ev, delay="30 days", window="30 days"),
        jobs.pinch_alert_writer(os.path.join(tmp_dir, "alerts"), threshold=0.9),
        os.path.join(tmp_dir, "ck_alert"),
    )
    q.awaitTermination()
    alerts = spark.read.parquet(os.path.join(tmp_dir, "alerts"))
    assert alerts.count() > 0 and alerts.where("wins >= 0.9 * attempts").count() == 0


def test_idempotent_batch_sink_replay(spark, tmp_dir):
    out = os.path.join(tmp_dir, "mart")
    write = jobs.batch_writer(out)
    df = spark.createDataFrame([("2025-11-01", 3)], "date string, dau long")
    write(df, 0)
    write(df, 0)  # a retried batch replaces its first attempt
    write(spark.createDataFrame([("2025-11-01", 5)], "date string, dau long"), 1)
    got = jobs.latest_per_key(out, spark, ["date"], ["dau"]).collect()
    assert [tuple(r) for r in got] == [("2025-11-01", 5)]
    assert spark.read.parquet(out).count() == 2


def _session_line(date, user):
    import json

    return json.dumps(
        {"event_date": date, "event_timestamp": 1761955200000000, "user_id": user, "user_pseudo_id": user,
         "event_name": "session_start", "event_params": []}
    )


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join([_session_line("20251101", "u1"), _session_line("20251110", "u1")]) + "\n")

    def run():
        ev = jobs.flatten_stream(jobs.raw_event_stream(spark, src))
        jobs.start(jobs.dau_exact_stream(ev, delay="2 days"), jobs.batch_writer(out), ck).awaitTermination()
        return {str(r["date"]): r["dau"] for r in jobs.latest_per_key(out, spark, ["date"], ["dau"]).collect()}

    assert run() == {"2025-11-01": 1, "2025-11-10": 1}
    # second arrival: 11-01 is older than the watermark (11-10 minus 2 days), 11-10 is not
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write("\n".join([_session_line("20251101", "u2"), _session_line("20251110", "u2"), _session_line("20251110", "u1")]) + "\n")
    assert run() == {"2025-11-01": 1, "2025-11-10": 2}


def test_corrupt_side_output_and_approx_dau(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join([_session_line("20251101", "u1"), _session_line("20251101", "u2"), '{"event_date": ']) + "\n")
    raw = jobs.raw_event_stream(spark, src)
    bad_out, dau_out = os.path.join(tmp_dir, "bad"), os.path.join(tmp_dir, "dau")
    jobs.start(jobs.corrupt_stream(raw), jobs.batch_writer(bad_out), os.path.join(tmp_dir, "ck1"), output_mode="append").awaitTermination()
    assert spark.read.parquet(bad_out).count() == 1
    approx = jobs.dau_approx_stream(jobs.flatten_stream(raw))
    jobs.start(approx, jobs.batch_writer(dau_out), os.path.join(tmp_dir, "ck2")).awaitTermination()
    got = jobs.latest_per_key(dau_out, spark, ["date"], ["dau_approx"]).collect()
    assert [(str(r["date"]), r["dau_approx"]) for r in got] == [("2025-11-01", 2)]


def test_checkpoint_folder_fallback_when_unset():
    from questlog import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "local[2]"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class FakeSpark:
        conf = Conf()
        sparkContext = Ctx()

    fake = FakeSpark()
    root = session.ensure_checkpoint_dir(fake)
    assert os.path.isdir(root) and fake.sparkContext.dir == root
    assert session.ensure_checkpoint_dir(fake) == root  # one folder per process
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):  # executors have disks of their own
        fake.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake)


def test_session_past_midnight_counts_on_its_day_in_stream_and_batch(spark, tmp_dir):
    import json

    from questlog.operators import economy
    from questlog.operators.staging import build_master_events
    from questlog.sources.readers import read_raw_events

    line = lambda ts: json.dumps(
        {"event_date": "20251101", "event_timestamp": ts, "user_id": "u", "user_pseudo_id": "u", "event_name": "level_complete",
         "event_params": [{"key": "gold_earned", "value": {"int_value": 7}}, {"key": "level_id", "value": {"int_value": 1}}]}
    )
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:  # 23:55 and 00:07 of the next day
        f.write(line(1762041300000000) + "\n" + line(1762042020000000) + "\n")
    batch = economy.economy_flow(build_master_events(read_raw_events(spark, src)), sinks={}).collect()
    ev = jobs.flatten_stream(jobs.raw_event_stream(spark, src))
    q = jobs.start(
        jobs.economy_window_stream(ev, by_session_day=True), jobs.batch_writer(os.path.join(tmp_dir, "m")), os.path.join(tmp_dir, "c")
    )
    q.awaitTermination()
    rows = spark.read.parquet(os.path.join(tmp_dir, "m")).collect()
    assert [(r["window_start"].date(), r["gold_source"]) for r in rows] == [(r["event_date"], r["gold_source"]) for r in batch]
    assert len(rows) == 1 and rows[0]["gold_source"] == 14


def test_upsert_replaces_keys_and_keeps_the_others(spark, tmp_dir):
    import datetime as dt

    from questlog.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    out = os.path.join(tmp_dir, "mart")
    write = jobs.upsert_writer(out, ["date", "level_id"])
    d1, d2 = dt.date(2025, 11, 1), dt.date(2025, 11, 2)
    make = lambda *rows: spark.createDataFrame(rows, "date date, level_id long, wins long")
    write(make((d1, 1, 5), (d1, 2, 6), (d2, 1, 7)), 0)
    for _ in range(2):  # the second is a retried batch
        write(make((d1, 2, 9), (d1, 3, 1)), 1)
    got = spark.read.schema("date date, level_id long, wins long").parquet(out).select("date", "level_id", "wins").collect()
    assert sorted(map(tuple, got)) == [(d1, 1, 5), (d1, 2, 9), (d1, 3, 1), (d2, 1, 7)]


def test_a_second_run_goes_on_from_its_checkpoint(spark):
    import glob

    first = sorted(map(tuple, jobs.run_stream_dau_on_driver_tables(spark, SF_SMALL).collect()))
    log = jobs._driver_log_stream(spark, SF_SMALL)[0]
    batches = lambda: sorted(glob.glob(f"{log}-streams/*/checkpoint/commits/[0-9]*"))
    before = batches()
    assert sorted(map(tuple, jobs.run_stream_dau_on_driver_tables(spark, SF_SMALL).collect())) == first
    assert before and batches() == before  # nothing was read again
