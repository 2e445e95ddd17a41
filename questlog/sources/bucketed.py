"""Section 2.8: tables bucketed and sorted by user, so that sums by user and joins on the user need no shuffle.

What is bucketed has at most one row a user (acquisition) or one a user and day
(revenue states), so the bucket of a hot user, and the one of rows without a user,
stays of bounded size however many events the user has.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..session import input_bytes, scratch_path

BYTES_PER_BUCKET = 256 * 1024 * 1024
DATABASE = "questlog_buckets"


def buckets_for(spark: SparkSession, paths, least: int = 8) -> int:
    """A bucket for each 256 MB of the files that the tables derive from. Tables that are joined take the same number."""
    return max(least, -(-input_bytes(spark, paths) // BYTES_PER_BUCKET))


def bucketed_table(spark: SparkSession, folder: str, columns: str, by: str, buckets: int) -> str:
    """The catalog's name of the table at ``folder`` (columns DDL), bucketed and sorted by ``by``; registered when it isn't
    yet. Files stay where they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{scratch_path(spark, 'catalog', DATABASE)}'")
    name = f"{DATABASE}.t_{hashlib.sha1(f'{folder} {columns} {by} {buckets}'.encode()).hexdigest()[:16]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return name


def append_bucketed(spark: SparkSession, df: DataFrame, folder: str, by: str, buckets: int) -> None:
    """Add the rows of ``df`` to the table at ``folder``: one file a bucket, written by the task that holds the bucket's rows
    (``repartition`` deals rows by the buckets' own hash). A new day is one more call with its rows."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    name = bucketed_table(spark, folder, columns, by, buckets)
    df.repartition(buckets, by).write.insertInto(name)
    spark.sql(f"REFRESH TABLE {name}")


def read_bucketed(spark: SparkSession, df: DataFrame, folder: str, by: str, buckets: int) -> DataFrame:
    """The table at ``folder``, which has the columns of ``df``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return spark.table(bucketed_table(spark, folder, columns, by, buckets))
