"""N05 as a file stream: new log files into a table of typed events by day.

The file source's checkpoint is the list of what was read; ``availableNow`` takes what has come
since and stops. Each micro-batch is flattened by the batch staging function and written to
partitions of its own, ``event_date=.../batch_id=...``: a batch that is run again, after a crash between its
write and its commit, has the same files and replaces the same partitions, so nothing is lost or doubled.
An event that comes a second time, in the same batch or in a later one, is recognised by its id among the
events of its day. Readers ask for a day and get its batches; :func:`compact_days` makes one of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.staging import quarantine
from ..sources.sinks import write_mart
from ..sources.staged import exists
from .jobs import batch_writer, flatten_stream, raw_event_stream, start

PARTITIONS = ("event_date", "batch_id")


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def day_writer(path: str, key: str = "event_id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: the batch's events that are not stored yet, by day and batch.

    The batch is held while it is written (it is read twice), and of the stored table only the ids of its days
    are read, and only those of earlier batches. Of events with one id in a batch, one is kept."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        if not exists(spark, path):
            write_mart(rows.dropDuplicates([key]), path, PARTITIONS)
            return
        rows = rows.persist()
        try:
            days = [r[0] for r in rows.select("event_date").distinct().collect()]  # one row a day
            before = _stored(spark, path, rows.schema).where(F.col("event_date").isin(days) & (F.col("batch_id") < batch_id))
            new = rows.join(before.select(key), key, "left_anti").select(*rows.columns)
            write_mart(new.dropDuplicates([key]), path, PARTITIONS)
        finally:
            rows.unpersist()

    return write


def ingest(spark: SparkSession, source: str, out: str, schema: StructType | None = None, files_per_batch: int | None = None, sink: Callable[[DataFrame, int], None] | None = None) -> list[StreamingQuery]:
    """Take in what has come to the folder ``source`` since the last call: events to ``{out}/events``, lines that are no
    events to ``{out}/quarantine``. Returns the two queries, which end by themselves."""
    raw = lambda: raw_event_stream(spark, source, files_per_batch, schema)
    events = start(flatten_stream(raw()), sink or day_writer(f"{out}/events"), f"{out}/checkpoints/events", "append")
    aside = start(quarantine(raw()), batch_writer(f"{out}/quarantine"), f"{out}/checkpoints/quarantine", "append")
    return [events, aside]


def ingested(spark: SparkSession, out: str, like: DataFrame) -> DataFrame:
    """The events taken in, with the columns of ``like`` (a flattened log). Partition pruning reaches the days."""
    schema = StructType(like.schema.fields).add("batch_id", "long")
    return _stored(spark, f"{out}/events", schema).drop("batch_id")


def compact_days(spark: SparkSession, out: str, like: DataFrame, days: Sequence[dt.date], target: str) -> None:
    """The given days' batches as one partition a day in the table ``target``: for days that get no more files."""
    write_mart(ingested(spark, out, like).where(F.col("event_date").isin(list(days))), target, ("event_date",))
