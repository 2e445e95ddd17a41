"""What a stream does with events that arrive behind its watermark.

Spark drops such rows inside its stateful operators, uncounted by day. Here a
stateless stream of the same log splits every micro-batch by the same rule, so
late rows become a table of their own beside the rows in time, and windows are
emitted once (append mode) when the watermark passes their end.

The rule: before a micro-batch the watermark is the latest event time of all earlier
ones minus the delay; a row is late if its window has ended by then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import write_mart
from ..sources.staged import exists

LATE_SCHEMA_COLUMNS = ("late", "batch_id")


def _progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("top timestamp, batch_id long").parquet(path)


def split_writer(out_path: str, time: str, delay: str, window: str = "1 day") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: the rows of a micro-batch under ``{out_path}/rows``, by ``late`` and ``batch_id``, and the
    latest event time so far under ``{out_path}/progress``.

    A retried batch replaces its own partitions: its watermark depends on earlier batches alone. The batch is read
    once; its latest time is taken from the rows just written. A row without an event time is never late.
    """
    rows, progress = f"{out_path.rstrip('/')}/rows", f"{out_path.rstrip('/')}/progress"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        top = None
        if exists(spark, progress):
            top = _progress(spark, progress).where(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
        end = F.window(F.col(time), window)["end"]
        behind = end <= F.lit(top) - F.expr(f"INTERVAL {delay}") if top is not None else F.lit(False)
        late = F.coalesce(behind, F.lit(False))
        marked = batch.withColumn("late", late).withColumn("batch_id", F.lit(batch_id).cast("long"))
        write_mart(marked, rows, LATE_SCHEMA_COLUMNS)
        mine = spark.read.schema(marked.schema).parquet(rows).where(F.col("batch_id") == batch_id)
        latest = mine.agg(F.max(time).cast("timestamp").alias("top")).select(F.greatest("top", F.lit(top).cast("timestamp")).alias("top"))
        write_mart(latest.withColumn("batch_id", F.lit(batch_id).cast("long")), progress, ("batch_id",))

    return write


def split_rows(spark: SparkSession, out_path: str, ev: DataFrame) -> DataFrame:
    """The rows written by :func:`split_writer` for the stream ``ev``, with ``late`` and ``batch_id``."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ev.schema.fields)
    return spark.read.schema(f"{schema}, late boolean, batch_id long").parquet(f"{out_path.rstrip('/')}/rows")


def closed_days(ev: DataFrame, delay: str, time: str = "day_time") -> DataFrame:
    """Events per day, for append mode: a day is emitted once, when the watermark has passed its end, and counts the
    events that came before that."""
    counts = ev.withWatermark(time, delay).groupBy(F.window(time, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("emitted"))
    return counts.select(F.col("w.start").cast("date").alias("date"), "emitted")
