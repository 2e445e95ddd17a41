"""Writers (S07-S09)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_raw_events(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested log as NDJSON; NULL fields are omitted from each line,
    as the source writer omits parameters a value does not use."""
    df.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """CSV with a header and the requested columns that exist (the
    source keeps only the columns present, since parameters differ by
    event)."""
    present = [c for c in columns if c in df.columns]
    df.select(*present).write.mode(mode).option("header", True).csv(path)


def write_mart(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("event_date",),
    fmt: str = "parquet",
) -> None:
    """A mart table as Parquet partitioned by day. Dynamic partition
    overwrite replaces only the days present in ``df``, so re-running one
    day is idempotent and leaves other days alone.

    Rows are clustered by the partition columns with a ``rebalance`` hint:
    a hash shuffle on the day (deterministic, so a retried task routes rows
    as the first attempt did) after which AQE splits an oversized day into
    several tasks and merges small ones. Few files per day, and a hot day is
    not written by a single task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
