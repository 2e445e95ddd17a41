"""Marts that are kept up to date equal the full run, and touch only what changed."""

from __future__ import annotations

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import d, ev_row
from questlog.operators import difficulty, economy, engagement, monetization, retention, rollups
from questlog.plans.explain import physical_plan
from questlog.sources.sinks import write_mart

EVENTS = ["session_start", "level_complete", "level_fail", "iap_purchase", "ad_reward_claim"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def log(master_df):
    r = random.Random(7)
    out = []
    for i in range(1500):
        user = r.choice([None, *(str(u) for u in (*range(40), 32767, 32768, 32769, 70000, 10**12))])
        day = (dt.date(2024, 1, 20) + dt.timedelta(days=int(r.triangular(0, 70, 10)))).isoformat()
        name = r.choice(EVENTS)
        level = r.choice([None, 1, 2, 3]) if name.startswith("level") else None
        status = {"level_complete": "Win", "level_fail": "Fail"}.get(name)
        money = round(r.random() * 9, 2) if name == "iap_purchase" else None
        out.append(ev_row(i, user, day, name, level, status, gold=5 if status == "Win" else None, revenue=money, gold_reward=50 if name == EVENTS[4] else None))
    df = master_df(out)
    return df.withColumn("user_pseudo_id", F.col("user_id").cast("long")).withColumn("user_id", F.col("user_id").cast("long"))


def test_bitmaps_equal_distinct_counts(log):
    maps = rollups.activity_bitmaps(log)
    assert rows(rollups.bitmap_dau(maps)) == rows(engagement.dau(log))
    assert rows(rollups.bitmap_mau(maps)) == rows(engagement.mau(log))
    assert rows(rollups.bitmap_engagement(maps)) == rows(engagement.engagement(log))
    any_event = rollups.activity_bitmaps(log, "user_id", event=None)
    assert rows(rollups.bitmap_dau(any_event)) == rows(engagement.dau_any_event(log))


def test_rolling_users_of_any_span(log):
    starts = [(r.event_date, r.user_id) for r in log.where("event_name = 'session_start'").collect()]
    last = max(x for x, _ in starts)
    for span in (1, 7, 30):
        got = {r.date: r.users for r in rollups.bitmap_rolling(rollups.activity_bitmaps(log), span).collect()}
        for day, n in got.items():
            assert n == len({u for x, u in starts if u is not None and 0 <= (day - x).days < span})
        assert max(got) == last


def test_sketches_stay_within_their_error(spark):
    ev = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("user_pseudo_id"), F.expr("date_add(DATE'2024-01-01', CAST(id / 10000 AS INT))").alias("event_date"), F.lit("session_start").alias("event_name"))
    sketches = rollups.activity_sketches(ev)
    for by, exact in (("event_date", 10_000), (F.lit(1), 20_000)):
        for r in rollups.sketch_users(sketches, by).collect():
            assert abs(r.users - exact) <= rollups.SKETCH_ERROR * exact


def test_words_equal_the_full_run(log):
    words = rollups.activity_words(log)
    key = F.col("cohort_date")
    for days in ((1, 3, 7), (0, 31, 32, 33, 64)):
        assert rows(rollups.retention_of(words, days).orderBy(key)) == rows(retention.retention(log, days))
    assert rows(rollups.retention_rates_of(words)) == rows(retention.retention_rates(log))
    assert rows(rollups.retention_matrix_of(words)) == rows(retention.retention_matrix(log))


def test_words_around_their_ends(master_df):
    days = ["1969-11-29", "1969-11-30", "1969-12-31", "1970-01-01", "1970-02-01", "1970-02-02", "2024-03-10"]
    for first in range(len(days)):
        ev = master_df([ev_row(i, "u", x, "session_start") for i, x in enumerate(days[first:])])
        assert [r.cohort_date for r in rollups.user_activity(rollups.activity_words(ev)).collect()] == [d(days[first])]
        assert rows(rollups.retention_matrix_of(rollups.activity_words(ev))) == rows(retention.retention_matrix(ev))


def files(path):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_appended_days_merge_into_the_words(spark, log, tmp_dir):
    path = os.path.join(tmp_dir, "words")
    cut = log.agg(F.max("event_date")).first()[0] - dt.timedelta(days=2)
    write_mart(rollups.activity_words(log.where(F.col("event_date") < cut)), path, ("word",))
    before = files(path)
    for i in (0, 1, 1, 2):  # one day comes twice
        rollups.merge_words(path, rollups.activity_words(log.where(F.col("event_date") == cut + dt.timedelta(days=i))))
    touched = {f"word={(cut + dt.timedelta(days=i) - dt.date(1970, 1, 1)).days // 32}" for i in range(3)}
    kept = {f: t for f, t in before.items() if f.split(os.sep)[-2] not in touched}
    assert kept and kept.items() <= files(path).items()
    words = spark.read.schema("user long, word int, days long").parquet(path)
    assert rows(rollups.retention_of(words)) == rows(retention.retention(log))
    # an earlier day that comes late moves a user's cohort, too
    early = log.where("user_id = 3").limit(1).withColumn("event_date", F.lit("2023-12-31").cast("date"))
    rollups.merge_words(path, rollups.activity_words(early))
    words = spark.read.schema("user long, word int, days long").parquet(path)
    assert rows(rollups.retention_of(words)) == rows(retention.retention(log.unionByName(early)))


STATES = {
    "levels": (rollups.level_states, rollups.difficulty_of, difficulty.difficulty),
    "money": (rollups.money_states, rollups.monetization_of, monetization.monetization_daily),
    "flow": (lambda ev: rollups.flow_states(ev, {"level_fail": 10}), rollups.flow_of, lambda ev: economy.economy_flow(ev, {"level_fail": 10})),
    "bitmaps": (rollups.activity_bitmaps, rollups.bitmap_engagement, engagement.engagement),
}


@pytest.mark.parametrize("name", STATES)
def test_a_changed_day_rewrites_its_partition_only(spark, log, tmp_dir, name):
    state, derive, full = STATES[name]
    facts, path = os.path.join(tmp_dir, "facts"), os.path.join(tmp_dir, name)
    write_mart(log, facts)
    stored = lambda: spark.read.schema(log.schema).parquet(facts)
    rollups.refresh_days(path, state, stored())
    before = files(path)
    day = log.where("event_name = 'iap_purchase'").agg(F.min("event_date")).first()[0]
    more = log.where(F.col("event_date") == day).withColumn("user_id", F.col("user_id") + 100).withColumn("user_pseudo_id", F.col("user_id"))
    write_mart(log.where(F.col("event_date") == day).unionByName(more), facts)
    rollups.refresh_days(path, state, stored(), [day])
    after = files(path)
    same = {f for f in before if f"event_date={day}" not in f}
    assert same and all(after[f] == before[f] for f in same) and not {f for f in before if f not in same} & set(after)
    mart = spark.read.schema(state(log).schema).parquet(path)
    assert rows(derive(mart)) == rows(full(stored()))
    plan = physical_plan(state(stored().where(F.col("event_date").isin([day]))))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ = ", plan)  # only that day's files are read


def test_no_events(log):
    none = log.limit(0)
    assert rollups.bitmap_engagement(rollups.activity_bitmaps(none)).count() == 0
    assert rollups.retention_of(rollups.activity_words(none)).count() == 0
    assert rollups.monetization_of(rollups.money_states(none)).count() == 0
