"""Structured Streaming versions of the live KPIs.

Sources are ``readStream`` over the nested JSON log with the explicit
schema; every stateful operator runs on event time with a watermark, so
its state is bounded; sinks are ``foreachBatch`` writes that are
idempotent per batch id, with checkpoints under the shared
``spark.checkpoint.dir`` so a restarted query (or a lost executor)
resumes without double counting.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.staging import build_master_events, is_corrupt
from ..schemas import LEVEL_COMPLETE, LEVEL_FAIL, RAW_EVENTS_WITH_CORRUPT, SESSION_START, WIN
from ..session import apply_engine_conf
from ..sources.sinks import write_mart
from ..sources.staged import exists

DAY = "1 day"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Starting a stream sets session settings for a moment; two threads take turns.
_START = threading.Lock()
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def raw_event_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """Stream of the nested log (PERMISSIVE: bad lines land in
    ``_corrupt_record``)."""
    reader = (
        spark.readStream.schema(schema or RAW_EVENTS_WITH_CORRUPT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def flatten_stream(raw: DataFrame) -> DataFrame:
    """The batch staging function applied to the stream (stateless)."""
    return build_master_events(raw)


def corrupt_stream(raw: DataFrame) -> DataFrame:
    """T01 side output: the rows staging leaves out."""
    return raw.where(is_corrupt(raw))


def session_day_time(ev: DataFrame) -> DataFrame:
    """Event time for day-level KPIs: the logged session date at midnight,
    so streamed counts equal the batch ones (the session date, not the
    event's own timestamp, defines the day)."""
    return ev.withColumn("day_time", F.col("event_date").cast("timestamp"))


def dau_exact_stream(
    ev: DataFrame, delay: str = "2 days", user: str = "user_pseudo_id", event: str = SESSION_START
) -> DataFrame:
    """Exact DAU on a stream. Distinct counts are not allowed on
    streams, so users are de-duplicated per day first (the event-time
    column is one of the dedup keys, so the watermark evicts old keys),
    then counted per one-day window. Use update mode; the latest row per
    window is the current count."""
    days = session_day_time(ev.where(F.col("event_name") == event))
    deduped = days.select(user, "day_time").withWatermark("day_time", delay).dropDuplicates([user, "day_time"])
    return deduped.groupBy(F.window("day_time", DAY).alias("w")).agg(F.count(user).alias("dau")).select(
        F.col("w.start").cast("date").alias("date"), "dau"
    )


def dau_approx_stream(ev: DataFrame, delay: str = "2 days", user: str = "user_pseudo_id") -> DataFrame:
    """Approximate DAU (HyperLogLog++), one aggregate, no dedup state."""
    days = session_day_time(ev.where(F.col("event_name") == SESSION_START)).withWatermark("day_time", delay)
    return days.groupBy(F.window("day_time", DAY).alias("w")).agg(
        F.approx_count_distinct(user).alias("dau_approx")
    ).select(F.col("w.start").cast("date").alias("date"), "dau_approx")


def economy_window_stream(
    ev: DataFrame, delay: str = "1 hour", window: str = DAY, sink_events: dict[str, int] | None = None, by_session_day: bool = False
) -> DataFrame:
    """Revenue and gold flow per tumbling event-time window.
    ``by_session_day``: the session's date is the event time, as in the batch
    form, so a session past midnight counts on the day it began."""
    ev = session_day_time(ev) if by_session_day else ev.withColumn("day_time", F.col("event_ts"))
    sink_events = sink_events or {}
    sink = F.lit(0).cast("long")
    for name, amount in sink_events.items():
        sink = sink + F.when(F.col("event_name") == name, F.lit(amount)).otherwise(0)
    src = F.coalesce(F.col("gold_earned"), F.lit(0)) + F.coalesce(F.col("gold_reward"), F.lit(0))
    return (
        ev.withWatermark("day_time", delay)
        .groupBy(F.window("day_time", window).alias("w"))
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum(src).alias("gold_source"),
            F.sum(sink).alias("gold_sink"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "revenue", "gold_source", "gold_sink")
    )


def level_outcome_stream(ev: DataFrame, delay: str = "1 hour", window: str = "1 hour", by_session_day: bool = False) -> DataFrame:
    """T05 input: attempts and wins per (window, level); ``by_session_day`` as in :func:`economy_window_stream`."""
    ev = session_day_time(ev) if by_session_day else ev.withColumn("day_time", F.col("event_ts"))
    rows = ev.where(F.col("event_name").isin(LEVEL_COMPLETE, LEVEL_FAIL) & F.col("level_id").isNotNull())
    return (
        rows.withWatermark("day_time", delay)
        .groupBy(F.window("day_time", window).alias("w"), "level_id")
        .agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("win_loss_status") == WIN).alias("wins"))
        .select(F.col("w.start").alias("window_start"), "level_id", "attempts", "wins")
    )


def batch_writer(out_path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Idempotent ``foreachBatch`` sink. Each micro-batch overwrites
    its own ``batch_id=N`` folder, so a retried batch replaces its earlier
    attempt instead of appending twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    return write


def upsert_writer(out_path: str, keys: list[str], day: str = "date") -> Callable[[DataFrame, int], None]:
    """Idempotent ``foreachBatch`` upsert of a mart partitioned by ``day``.
    A batch replaces the partitions of its days, with their earlier rows of
    other keys kept; a retried batch writes the same rows again.

    Where the day is the key, a partition is replaced as a whole and nothing is
    read. Otherwise the batch, which is read three times, is held while it is merged
    (a micro-batch is an aggregate of what changed), only its days are read from the
    mart, and what is kept of them is checkpointed before they are overwritten."""
    whole_days = list(keys) == [day]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if whole_days or not exists(spark, out_path):
            write_mart(batch, out_path, (day,))
            return
        batch = batch.persist()
        try:
            days = [r[0] for r in batch.select(day).distinct().collect()]
            old = spark.read.schema(batch.schema).parquet(out_path).where(F.col(day).isin(days))
            kept = old.join(batch.select(*keys), keys, "left_anti").select(*batch.columns).checkpoint()
            write_mart(batch.unionByName(kept), out_path, (day,))
        finally:
            batch.unpersist()

    return write


def pinch_alert_writer(
    out_path: str, threshold: float = 0.30, min_attempts: int = 1, upsert_keys: list[str] | None = None, day: str = "date"
):
    """Aggregate first, then keep windows/levels whose win rate is below
    the threshold; written idempotently per batch. With ``upsert_keys``, every
    updated row is upserted with a column ``alert``, so a later batch can take
    an alert back."""
    write = upsert_writer(out_path, upsert_keys, day) if upsert_keys else batch_writer(out_path)

    def alert(batch: DataFrame, batch_id: int) -> None:
        low = (F.col("attempts") >= min_attempts) & (F.col("wins") < F.lit(Decimal(str(threshold))) * F.col("attempts"))
        write(batch.withColumn("alert", low) if upsert_keys else batch.where(low), batch_id)

    return alert


def latest_per_key(out_path: str, spark: SparkSession, keys: list[str], values: list[str]) -> DataFrame:
    """Read an update-mode mart: the value of the latest batch per key."""
    df = spark.read.parquet(out_path)
    return df.groupBy(*keys).agg(*[F.max_by(v, "batch_id").alias(v) for v in values])


def start(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "update",
    available_now: bool = True,
    name: str | None = None,
    state_partitions: int | None = None,
    rocksdb_state: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start a stream with a ``foreachBatch`` sink and a checkpoint.

    For a new query (Spark records both in the checkpoint at the first
    start): ``state_partitions`` state-store partitions, by default the
    cluster's parallelism, so every core holds one slice of the state
    instead of a fixed 200; and the RocksDB state store with changelog
    checkpointing, which keeps large dedup state (users x days) on local
    disk instead of the executor heap."""
    spark = df.sparkSession
    if state_partitions is None:
        state_partitions = spark.sparkContext.defaultParallelism
    w = df.writeStream.outputMode(output_mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    settings = {"spark.sql.shuffle.partitions": str(state_partitions)}
    if rocksdb_state:
        settings[STATE_PROVIDER] = ROCKSDB_PROVIDER
        settings["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    with _START:
        previous = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            return w.start()  # the stream clones the session conf here
        finally:
            for k, v in previous.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def _day_bounds(raw: DataFrame):
    day_num = F.date_diff(F.try_to_date(F.col("event_date"), "yyyyMMdd"), F.lit("1970-01-01").cast("date"))
    bounds = raw.select(F.min(day_num).alias("lo"), F.max(day_num).alias("hi")).first()
    return day_num, bounds["lo"], bounds["hi"]


def write_log_in_arrival_order(raw: DataFrame, path: str, chunks: int = 3) -> int:
    """Write the nested log as NDJSON in ``chunks`` successive appends
    ordered by session date (earlier days arrive first, as in a live feed).
    Returns the span of one chunk in days (the lateness a stream must
    tolerate inside one arrival)."""
    day_num, lo, hi = _day_bounds(raw)
    if lo is None:
        raw.limit(0).write.mode("append").json(path)
        return 1
    span = max(1, (hi - lo + chunks) // chunks)
    for i in range(chunks):
        part = raw.where((day_num >= lo + i * span) & (day_num < lo + (i + 1) * span))
        part.write.mode("append").json(path)
    return span


def count_data_files(spark: SparkSession, path: str) -> int:
    """Number of data files in a folder (metadata only)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return sum(1 for st in fs.listStatus(p) if not st.getPath().getName().startswith(("_", ".")))


def _driver_log_stream(spark: SparkSession, sf_dir: str, chunks: int = 3):
    """The whole driver ``events`` table as a nested log in ``chunks``
    arrivals (written once per source version), and a stream over it
    (about one micro-batch per arrival). Returns (log folder, stream, days per arrival)."""
    from ..sources.driver_tables import DriverTables
    from ..sources.staged import staged_folder

    t = DriverTables(spark, sf_dir)
    raw = t.raw_events().drop("event_id")
    log, span = staged_folder(
        spark,
        f"raw_log_{chunks}",
        [t._path("events")],  # noqa: SLF001
        lambda path: write_log_in_arrival_order(raw, path, chunks=chunks),
        raw,
    )
    # files of a later arrival are newer, so a batch never mixes in older days
    per_batch = max(1, -(-count_data_files(spark, log) // chunks))
    # the stream gets its own session (same cluster, separate SQL settings),
    # so starting it never changes the caller's settings
    stream_session = apply_engine_conf(spark.newSession())
    return log, flatten_stream(raw_event_stream(stream_session, log, max_files_per_trigger=per_batch)), span


def run_stream_dau_on_driver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T02 end to end: the log streamed with ``availableNow`` through
    staging and the exact-DAU operator into an idempotent mart, read back."""
    log, ev, span = _driver_log_stream(spark, sf_dir)
    daily = dau_exact_stream(ev, delay=f"{span + 1} days")
    return _upserted(spark, daily, lambda mart: upsert_writer(mart, ["date"]), log)


def run_stream_economy_on_driver_tables(spark: SparkSession, sf_dir: str, sinks: dict[str, int]) -> DataFrame:
    """T04 end to end: revenue and gold flow per one-day event-time window."""
    log, ev, span = _driver_log_stream(spark, sf_dir)
    flow = economy_window_stream(ev, delay=f"{span + 1} days", window=DAY, sink_events=sinks, by_session_day=True)
    daily = flow.select(F.col("window_start").cast("date").alias("date"), "revenue", "gold_source", "gold_sink")
    mart = _upserted(spark, daily, lambda mart: upsert_writer(mart, ["date"]), log)
    return mart.withColumn("revenue", F.col("revenue").cast("double"))


def run_stream_level_outcomes_on_driver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T05 input end to end: attempts and wins per level and one-day
    event-time window (the alert writer filters these rows)."""
    log, ev, span = _driver_log_stream(spark, sf_dir)
    daily = _daily_outcomes(ev, span)
    return _upserted(spark, daily, lambda mart: upsert_writer(mart, ["date", "level_id"]), log)


def _daily_outcomes(ev: DataFrame, span: int) -> DataFrame:
    outcomes = level_outcome_stream(ev, delay=f"{span + 1} days", window=DAY, by_session_day=True)
    return outcomes.select(F.col("window_start").cast("date").alias("date"), "level_id", "attempts", "wins")


def _upserted(spark: SparkSession, daily: DataFrame, sink: Callable[[str], Callable[[DataFrame, int], None]], log: str, *extra: str, of: str = "") -> DataFrame:
    """Run ``daily`` to the end of the log into a mart, and read the mart. Checkpoint and mart lie beside the log, by the
    stream's definition (and its sink's, ``of``): a second call goes on from the checkpoint, where nothing is left to do."""
    from ..sources.staged import definition

    run = f"{log}-streams/{definition(daily, of)}"
    start(daily, sink(f"{run}/mart"), f"{run}/checkpoint").awaitTermination()
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in daily.schema.fields] + list(extra))
    return spark.read.schema(schema).parquet(f"{run}/mart")


def run_stream_pinch_alert_on_driver_tables(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    """T05 end to end: days and levels whose latest win rate is below ``threshold``."""
    log, ev, span = _driver_log_stream(spark, sf_dir)
    sink = lambda mart: pinch_alert_writer(mart, threshold, upsert_keys=["date", "level_id"])
    return _upserted(spark, _daily_outcomes(ev, span), sink, log, "alert boolean", of=f"alert {threshold}").where("alert").drop("alert")


def run_stream_dau_approx_on_driver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T03 end to end: approximate DAU per day."""
    log, ev, span = _driver_log_stream(spark, sf_dir)
    daily = dau_approx_stream(ev, delay=f"{span + 1} days")
    return _upserted(spark, daily, lambda mart: upsert_writer(mart, ["date"]), log)
