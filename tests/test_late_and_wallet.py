"""Rows behind the watermark, append mode, and the stateful wallet."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL, d
from questlog.operators import economy
from questlog.operators.staging import build_master_events
from questlog.sources.driver_tables import DriverTables
from questlog.sources.readers import read_raw_events
from questlog.streaming import jobs, late, replay, wallet

DAY = 86_400_000_000


def micros(day, seconds=0):
    return int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000 + seconds * 1_000_000


def line(day, user="u", seconds=0, name="level_complete", gold=7, ts=None):
    return json.dumps(
        {"event_date": day.replace("-", ""), "event_timestamp": micros(day, seconds) if ts is None else ts, "user_id": user, "user_pseudo_id": user,
         "event_name": name, "event_params": [{"key": "gold_earned", "value": {"int_value": gold}}, {"key": "level_id", "value": {"int_value": 1}}]}
    )


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_late_rows_are_split_off_and_counted(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    ev = lambda: jobs.session_day_time(jobs.flatten_stream(jobs.raw_event_stream(spark, src)))
    batches = [
        ["2025-11-01", "2025-11-05"],
        # the watermark is 11-03: a day is late from the moment it has ended by then
        ["2025-11-01", "2025-11-02", "2025-11-03", "2025-11-04", "2025-11-06"],
        ["2025-11-03", "2025-11-04", "2025-11-06"],
    ]
    for i, days in enumerate(batches):
        put(src, f"{i}.json", [line(x, f"{i}{x}") for x in days] + (["{"] if i == 1 else []))
        for sink, name in ((late.split_writer(out, "day_time", "2 days"), "a"), (jobs.batch_writer(os.path.join(tmp_dir, "closed")), "b")):
            df = ev() if name == "a" else late.closed_days(ev(), "2 days")
            jobs.start(df, sink, os.path.join(tmp_dir, name), "append").awaitTermination()
    rows = late.split_rows(spark, out, ev())
    got = {(r.batch_id, str(r.event_date)) for r in rows.where("late").collect()}
    assert got == {(1, "2025-11-01"), (1, "2025-11-02"), (2, "2025-11-03")}
    assert rows.count() == sum(map(len, batches))  # kept and late rows are the log
    closed = {str(r["date"]): r.emitted for r in spark.read.parquet(os.path.join(tmp_dir, "closed")).collect()}
    assert closed == {"2025-11-01": 1, "2025-11-03": 1}  # 11-04 ends when the watermark of 11-04 is not past it


def test_a_retried_split_writes_the_same_rows(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    write = late.split_writer(out, "t", "1 day")
    make = lambda *days: spark.createDataFrame([(i, dt.datetime.fromisoformat(x)) for i, x in enumerate(days)], "id long, t timestamp")
    first, second = make("2025-11-01", "2025-11-09"), make("2025-11-02", "2025-11-08", "2025-11-20")
    write(first, 0)
    for _ in range(2):
        write(second, 1)
    write(make("2025-11-18", "2025-11-19"), 2)
    write(make(), 3)
    got = late.split_rows(spark, out, first).select("batch_id", "t", "late").collect()
    assert sorted((r[0], str(r[1])[:10], r[2]) for r in got) == [
        (0, "2025-11-01", False), (0, "2025-11-09", False), (1, "2025-11-02", True), (1, "2025-11-08", False), (1, "2025-11-20", False),
        (2, "2025-11-18", True), (2, "2025-11-19", False),
    ]


def run_wallet(spark, tmp_dir, feeds, delay):
    src = os.path.join(tmp_dir, "in")
    for i, lines in enumerate(feeds):
        put(src, f"{i}.json", lines)
        ev = jobs.flatten_stream(jobs.raw_event_stream(spark, src))
        q = jobs.start(wallet.wallet_stream(ev, {"level_fail": 10}, delay=delay), jobs.batch_writer(os.path.join(tmp_dir, "m")), os.path.join(tmp_dir, "c"), "append")
        q.awaitTermination()
    out = spark.read.parquet(os.path.join(tmp_dir, "m"))
    return sorted(((r.user_id, r.event_ts, r.event_id, r.delta, r.balance) for r in out.collect()), key=str)


def test_wallet_settles_out_of_order_events_across_restarts(spark, tmp_dir):
    r = random.Random(2)
    events = []
    for i in range(120):
        name, user = r.choice(["level_complete", "level_fail", "session_start"]), r.choice(["a", "b", "c", None])
        events.append((i, line(f"2025-11-{1 + i // 12:02d}", user, r.randrange(80_000), name, gold=i)))
    ordered = [x for _, x in sorted(events, key=lambda e: e[0] + r.randrange(30))]
    beat = line("2025-12-20", None, 0, wallet.HEARTBEAT)
    feeds = [ordered[:40], ordered[40:80], [*ordered[80:], *ordered[70:80]], [beat]]  # the third holds a replayed part
    got = run_wallet(spark, tmp_dir, feeds, "6 days")
    whole = os.path.join(tmp_dir, "whole")
    put(whole, "all.json", ordered)
    full = economy.wallet_balance(build_master_events(read_raw_events(spark, whole)), {"level_fail": 10})
    assert got == sorted(((x.user_id, x.event_ts, x.event_id, x.delta, x.balance) for x in full.collect()), key=str)


def test_wallet_holds_events_until_the_watermark(spark, tmp_dir):
    # the day's first event comes last and still enters first; what is behind the watermark is dropped
    feeds = [
        [line("2025-11-03", seconds=10, gold=1)],
        [line("2025-11-03", seconds=5, gold=2), line("2025-11-06", gold=100)],
        [line("2025-11-01", gold=1000), line("2025-11-09", gold=5)],
    ]
    got = sorted((str(x[1]), x[3], x[4]) for x in run_wallet(spark, tmp_dir, feeds, "1 day"))
    assert got == [("2025-11-03 00:00:05", 2, 2), ("2025-11-03 00:00:10", 1, 3), ("2025-11-06 00:00:00", 100, 103)]


def test_wallet_calls_the_state_store_by_slot_and_not_by_user(spark, tmp_dir):
    """Many users in one slot: one group of rows, the balances of each user's own events, ids of any kind."""
    src = os.path.join(tmp_dir, "in")
    r = random.Random(8)
    users = [None, "", "=", "é", *[f"u{i}" for i in range(60)]]
    lines = [line(f"2025-11-{1 + r.randrange(5):02d}", r.choice(users), r.randrange(80_000), gold=r.randrange(2**40)) for _ in range(300)]
    feeds = [lines[:150], lines[150:], [line("2025-12-20", None, 0, wallet.HEARTBEAT)]]
    for i, feed in enumerate(feeds):
        put(src, f"{i}.json", feed)
        ev = jobs.flatten_stream(jobs.raw_event_stream(spark, src))
        q = jobs.start(wallet.wallet_stream(ev, {"level_fail": 10}, delay="6 days", slots=1), jobs.batch_writer(os.path.join(tmp_dir, "m")), os.path.join(tmp_dir, "c"), "append")
        q.awaitTermination()
        if i == 0:
            assert q.lastProgress is None or max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) < 10
    put(os.path.join(tmp_dir, "whole"), "all.json", lines)
    full = economy.wallet_balance(build_master_events(read_raw_events(spark, os.path.join(tmp_dir, "whole"))), {"level_fail": 10})
    rows = lambda df: sorted(((x.user_id, x.event_ts, x.event_id, x.delta, x.balance) for x in df.collect()), key=str)
    assert rows(spark.read.parquet(os.path.join(tmp_dir, "m"))) == rows(full)


def test_replayed_arrivals_hold_the_whole_log(spark):
    raw = DriverTables(spark, SF_SMALL).raw_events()
    parts, span = replay.arrivals(raw)
    assert sum(p.count() for p in parts) == raw.count() and len(parts) == replay.ARRIVALS
    days = [p.select(F.min("event_date"), F.max("event_date")).first() for p in parts]
    assert days[1][0] < days[0][1]  # some rows of the second are days behind
    assert replay.arrivals(raw.limit(0))[1] == 1 and span > 1 and d("2024-01-01")


def test_an_arrival_reads_only_the_days_that_it_may_hold(spark):
    for keep in (True, False):
        parts, _ = replay.arrivals(DriverTables(spark, SF_SMALL).raw_events(), keep_id=keep)
        for part in parts:
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_ingest_loses_and_doubles_nothing(spark, tmp_dir):
    """Replayed lines in a batch, in a later batch and in a crashed one; bad lines; an old day that comes late."""
    import pytest

    from pyspark.errors import StreamingQueryException
    from questlog.streaming import ingest as ing

    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    day = lambda i, n: [line(f"2025-11-{i:02d}", f"u{k}", seconds=k) for k in range(n)]
    feeds = [[*day(1, 5), *day(2, 5), *day(1, 3)], [*day(3, 4), "{", *day(1, 7)], [*day(2, 6), *day(3, 4)], ["{}"]]
    write = ing.day_writer(f"{out}/events")
    for i, lines in enumerate(feeds):
        put(src, f"{i}.json", lines)
        if i == 1:

            def broken(batch, batch_id):
                write(batch, batch_id)
                raise RuntimeError("written, not committed")

            events, aside = ing.ingest(spark, src, out, sink=broken)
            with pytest.raises(StreamingQueryException):
                events.awaitTermination()
            aside.awaitTermination()
        for q in ing.ingest(spark, src, out):
            q.awaitTermination()
    like = jobs.flatten_stream(jobs.raw_event_stream(spark, src))
    got = ing.ingested(spark, out, like)
    whole = sorted({(f"2025-11-{i:02d}", f"u{k}") for i, n in ((1, 7), (2, 6), (3, 4)) for k in range(n)})
    assert sorted((str(r.event_date), r.user_id) for r in got.collect()) == whole
    assert spark.read.parquet(f"{out}/quarantine").count() == 2
    batches = {r.batch_id for r in spark.read.parquet(f"{out}/events").where("event_date = '2025-11-01'").select("batch_id").collect()}
    assert batches == {0, 1}  # only what is new of a replayed day is written
    ing.compact_days(spark, out, like, [d("2025-11-01")], f"{out}/days")
    assert spark.read.parquet(f"{out}/days").count() == 7
