"""Readers for the source files (S01-S06, S10), each with explicit types:
no inference pass over the data. JSON is read with its schema; CSV columns
are matched by header name and cast to their declared types."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import parse_yyyymmdd
from ..schemas import (
    ADS_CSV,
    CORRUPT_COLUMN,
    FLAT_EVENTS_CSV,
    IAP_CSV,
    MONEY,
    RAW_EVENTS_WITH_CORRUPT,
    USER_ACQUISITION_CSV,
)


def read_raw_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Nested NDJSON log. PERMISSIVE mode: a line that does not parse
    is kept with only ``_corrupt_record`` set (see ``staging.quarantine``)."""
    return (
        spark.read.schema(RAW_EVENTS_WITH_CORRUPT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )


def glob_free(path: str) -> str:
    """``path`` as Spark reads it literally: a path given to a reader is a glob."""
    return re.sub(r"([\\[\]{}*?])", r"\\\1", path)


def header_groups(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Files by their first line: the writer keeps only the columns that exist,
    so column sets and orders differ between files. One job finds them: of a
    file's lines only its first block's are looked at, the first one is kept (one task reads a block, from its start), and the driver
    gets one row for each distinct header, with the files Spark's own listing holds anyway."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    lines = lines.where("_metadata.file_block_start = 0").select(F.col("_metadata.file_path").alias("file"), "value")
    headers = lines.groupBy("file").agg(F.first("value").alias("header"))
    groups: dict[str, list[str]] = {}
    for r in headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
        groups.setdefault(r["header"].lstrip("\ufeff"), []).extend(glob_free(unquote(f)) for f in r["files"])
    return groups


def _csv(spark: SparkSession, schema: StructType, path) -> DataFrame:
    """CSV matched to ``schema`` by header name, not by position: files are
    read by groups of equal headers. Every column is read as text (no inference
    pass) and cast to its declared type by name; a missing column is NULL; a
    value that does not parse is NULL (``try_cast``), never a failed job."""
    parts = []
    for _, files in sorted(header_groups(spark, path).items()):
        df = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(files)
        present = {c.strip().lower(): c for c in reversed(df.columns)}
        cols = []
        for field in schema.fields:
            src = present.get(field.name.lower())
            value = F.col(f"`{src}`").try_cast(field.dataType) if src else F.lit(None).cast(field.dataType)
            cols.append(value.alias(field.name))
        parts.append(df.select(*cols))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_flat_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Flat events CSV. ``level_id`` / ``gold_earned`` are read as
    double (a writer with gaps emits ``1.0``, which an integer schema would
    turn into NULL without an error) and cast afterwards; ``event_date``
    (``yyyyMMdd``) becomes a DATE with an explicit format."""
    df = _csv(spark, FLAT_EVENTS_CSV, path)
    return df.select(
        parse_yyyymmdd("event_date").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "event_name",
        "user_id",
        "country",
        "os",
        F.col("level_id").try_cast("long").alias("level_id"),
        F.col("status").alias("win_loss_status"),
        "weapon_used",
        F.col("gold_earned").try_cast("long").alias("gold_earned"),
        F.col("price").try_cast(MONEY).alias("revenue"),
        "product_id",
        "duration",
    )


def read_user_acquisition(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Acquisition CSV; ``install_date`` (``yyyy-MM-dd`` with or
    without a time) to DATE, CPI to decimal."""
    df = _csv(spark, USER_ACQUISITION_CSV, path)
    return df.select(
        "user_id",
        F.to_date(F.try_to_timestamp(F.col("install_date"))).alias("install_date"),
        "source",
        "campaign_id",
        F.col("cpi").try_cast(MONEY).alias("cpi"),
        "tier",
    )


def read_iap(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """IAP transactions CSV."""
    df = _csv(spark, IAP_CSV, path)
    return df.select(
        "user_id", F.try_to_timestamp(F.col("timestamp")).alias("timestamp"), F.col("price").try_cast(MONEY).alias("price"), "pack"
    )


def read_ads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Ad impressions CSV."""
    df = _csv(spark, ADS_CSV, path)
    return df.select(
        "user_id",
        F.try_to_timestamp(F.col("timestamp")).alias("timestamp"),
        F.col("revenue").try_cast(MONEY).alias("revenue"),
        "placement",
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for
    local, HDFS and object-store paths alike); metadata only."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return bool(fs.exists(hpath))


def resolve_source(spark: SparkSession, candidates: Iterable[str], marker: str = "user_acquisition.csv") -> str:
    """The first folder among ``candidates`` that holds ``marker``.
    Raises ``FileNotFoundError`` naming every folder tried."""
    tried = []
    for base in candidates:
        tried.append(base)
        if path_exists(spark, f"{base.rstrip('/')}/{marker}"):
            return base
    raise FileNotFoundError(f"no folder among {tried} contains {marker}; generate or upload the data first")


def load_dashboard_sources(spark: SparkSession, candidates: Iterable[str]) -> dict[str, DataFrame]:
    """S02-S06 together: the four dashboard inputs of the folder found."""
    base = resolve_source(spark, candidates).rstrip("/")
    return {
        "user_acquisition": read_user_acquisition(spark, f"{base}/user_acquisition.csv"),
        "user_events_flat": read_flat_events(spark, f"{base}/user_events_flat.csv"),
        "iap_transactions": read_iap(spark, f"{base}/iap_transactions.csv"),
        "ad_impressions": read_ads(spark, f"{base}/ad_impressions.csv"),
    }


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make DataFrames addressable by name from SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
