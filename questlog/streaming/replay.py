"""A log replayed as a live feed: arrivals written one after the other, every stream stopped after each and
started again from its checkpoint for the next. Rows come late on purpose: some an arrival later than their day's, some two."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..schemas import RAW_EVENTS_WITH_CORRUPT
from ..session import apply_engine_conf, input_bytes
from ..sources.driver_tables import DriverTables
from ..sources.sinks import write_raw_events
from ..sources.staged import staged_folder
from .ingest import ingest, ingested
from .jobs import batch_writer, flatten_stream, raw_event_stream, session_day_time, start
from .late import closed_days, split_rows, split_writer
from .wallet import HEARTBEAT, SLOTS, wallet_stream

ARRIVALS = 4
# Every so many events by id come one (or two) arrivals late; days that the live days tolerate.
ONE_LATE, TWO_LATE = 10, 50
DELAY_DAYS = 2
# Bytes of the events' files, which are compressed, for one slot of the wallet's users.
SLOT_BYTES = 64 * 1024


def arrivals(raw: DataFrame, n: int = ARRIVALS, keep_id: bool = False) -> tuple[list[DataFrame], int]:
    """The nested log (with ``event_id``) in ``n`` arrivals by session day, some rows behind their time, and the days of
    an arrival. Rows without a day come with the first. An arrival reads only the days that it may hold: a log partitioned by
    day is not read whole for each."""
    gone = () if keep_id else ("event_id",)
    day = F.date_diff(F.try_to_date(F.col("event_date"), "yyyyMMdd"), F.lit("1970-01-01").cast("date"))
    lo, hi = raw.agg(F.min(day), F.max(day)).first()
    if lo is None:
        return [raw.drop(*gone)], 1
    span = max(1, -(-(hi - lo + 1) // n))
    late = F.when(F.col("event_id") % TWO_LATE == 0, 2).when(F.col("event_id") % ONE_LATE == 0, 1).otherwise(0)
    at = F.coalesce(F.least(F.floor((day - lo) / span) + late, F.lit(n - 1)), F.lit(0))
    own = F.floor((day - lo) / span)
    # the days of an arrival and of the two before it (rows come at most so late), in a filter of its own that prunes
    days = [F.coalesce(own, F.lit(0)) <= i if i < n - 1 else F.lit(True) for i in range(n)]
    days = [d & (F.coalesce(own, F.lit(0)) >= i - 2) for i, d in enumerate(days)]
    return [raw.where(days[i]).where(at == i).drop(*gone) for i in range(n)], span


def replay(parts: Sequence[DataFrame], folder: str, streams: Sequence[Callable[[], StreamingQuery]]) -> None:
    """Write each arrival to ``folder`` and run every stream to its end on it; the streams run side by side."""
    for part in parts:
        write_raw_events(part, folder, "append")
        for q in [begin() for begin in streams]:
            q.awaitTermination()


def _kept_run(spark: SparkSession, sf_dir: str, name: str, parameters: str, work: Callable[[str, SparkSession], None]) -> str:
    """The folder of the run ``name`` over this version of the log: ``work(folder, session)`` replays it once, with streams
    in a session of their own; later calls find everything read and take its results."""
    t = DriverTables(spark, sf_dir)
    of = t.raw_events().withColumn("_run", F.lit(parameters))
    session = apply_engine_conf(spark.newSession())
    folder, _ = staged_folder(spark, name, [t._path("events")], lambda run: work(run, session), of)  # noqa: SLF001
    return folder


def _feed(session: SparkSession, run: str) -> DataFrame:
    """A run's log as a stream; everything that is there is one micro-batch."""
    return flatten_stream(raw_event_stream(session, f"{run}/log"))


def run_stream_late_rows_on_driver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T06 end to end: (date, on_time, late, emitted): the day's events before and behind the watermark, and the count that
    append mode emitted when the day closed (NULL while it is open)."""
    delay = f"{DELAY_DAYS} days"

    def work(run: str, session: SparkSession) -> None:
        parts, _ = arrivals(DriverTables(spark, sf_dir).raw_events())
        ev = lambda: session_day_time(_feed(session, run))
        split = lambda: start(ev(), split_writer(f"{run}/split", "day_time", delay), f"{run}/split-checkpoint", "append")
        close = lambda: start(closed_days(ev(), delay), batch_writer(f"{run}/closed"), f"{run}/closed-checkpoint", "append")
        replay(parts, f"{run}/log", [split, close])

    run = _kept_run(spark, sf_dir, "stream_late", f"{ARRIVALS} arrivals, {delay}, {ONE_LATE} {TWO_LATE}", work)
    rows = split_rows(spark, f"{run}/split", session_day_time(_feed(spark, run)))
    counts = rows.groupBy(F.col("event_date").alias("date")).agg(F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"))
    closed = spark.read.schema("date date, emitted long, batch_id long").parquet(f"{run}/closed").drop("batch_id")
    return counts.join(closed, "date", "left")


def run_stream_wallet_on_driver_tables(spark: SparkSession, sf_dir: str, sinks: dict[str, int]) -> DataFrame:
    """C05 live, end to end: the out-of-order log through the stateful wallet, cut by a restart after every arrival; a
    heartbeat behind the last event settles what still waits."""

    def work(run: str, session: SparkSession) -> None:
        t = DriverTables(spark, sf_dir)
        raw = t.raw_events()
        slots = max(SLOTS, -(-input_bytes(spark, [t._path("events")]) // SLOT_BYTES))  # noqa: SLF001
        parts, span = arrivals(raw)
        days = 2 * span + 2  # nothing comes later than two arrivals
        micros = F.max("event_timestamp") + F.lit((days + 1) * 86_400_000_000)
        beat = raw.agg(F.max("event_date").alias("event_date"), micros.alias("event_timestamp")).select("*", F.lit(HEARTBEAT).alias("event_name"))
        live = lambda: start(
            wallet_stream(_feed(session, run), sinks, delay=f"{days} days", slots=slots), batch_writer(f"{run}/settled"), f"{run}/checkpoint", "append"
        )
        replay([*parts, beat], f"{run}/log", [live])

    run = _kept_run(spark, sf_dir, "stream_wallet", f"{ARRIVALS} arrivals, {sinks}, {ONE_LATE} {TWO_LATE}, slots", work)
    schema = "user_id string, event_ts timestamp, event_id long, delta long, balance long, batch_id long"
    return spark.read.schema(schema).parquet(f"{run}/settled").select("user_id", "event_ts", "delta", "balance")


def run_ingest_on_driver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N05 by file stream, end to end: four arrivals, the third of which comes with the first one's events again; every
    call goes on where the last one stopped."""
    schema = StructType([*RAW_EVENTS_WITH_CORRUPT.fields, StructField("event_id", LongType())])

    def work(run: str, session: SparkSession) -> None:
        parts, _ = arrivals(DriverTables(spark, sf_dir).raw_events(), keep_id=True)
        for i, part in enumerate(parts):
            write_raw_events(part if i != 2 else part.unionByName(parts[0]), f"{run}/log", "append")
            for q in ingest(session, f"{run}/log", f"{run}/out", schema):
                q.awaitTermination()

    run = _kept_run(spark, sf_dir, "ingest", f"{ARRIVALS} arrivals, {ONE_LATE} {TWO_LATE}", work)
    return ingested(spark, f"{run}/out", flatten_stream(raw_event_stream(spark, f"{run}/log", schema=schema)))
