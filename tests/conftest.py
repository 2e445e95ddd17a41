from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from questlog.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        app="questlog-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="questlog-test-")


MASTER_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("level_id", T.IntegerType()),
        T.StructField("win_loss_status", T.StringType()),
        T.StructField("gold_earned", T.LongType()),
        T.StructField("gold_reward", T.LongType()),
        T.StructField("revenue", T.DecimalType(18, 2)),
        T.StructField("ad_revenue", T.DecimalType(18, 2)),
        T.StructField("pack", T.StringType()),
        T.StructField("placement", T.StringType()),
        T.StructField("duration", T.DoubleType()),
    ]
)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def ev_row(
    event_id,
    user,
    date,
    name,
    level=None,
    status=None,
    gold=None,
    revenue=None,
    ts_=None,
    pseudo=None,
    gold_reward=None,
    ad_revenue=None,
    pack=None,
    placement=None,
    duration=None,
):
    return (
        event_id,
        user,
        pseudo if pseudo is not None else user,
        d(date) if date else None,
        ts(ts_) if ts_ else (dt.datetime.fromisoformat(date + "T12:00:00") if date else None),
        name,
        level,
        status,
        gold,
        gold_reward,
        Decimal(str(revenue)) if revenue is not None else None,
        Decimal(str(ad_revenue)) if ad_revenue is not None else None,
        pack,
        placement,
        duration,
    )


@pytest.fixture()
def master_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, MASTER_SCHEMA)

    return make
