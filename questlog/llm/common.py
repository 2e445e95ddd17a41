"""Helpers shared by the operators: shared-folder tables, connected components, ordered blocks."""

from __future__ import annotations

import uuid
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# Rows and bytes of one Arrow batch: bound a Python worker's memory when texts are long.
ARROW_ROWS = 1000
ARROW_BYTES = 64 * 1024 * 1024
# Blocks of an order at most: two keys of each reach the driver.
MOST_BLOCKS = 100_000
# Spark's estimate for what is no file is a number beyond all sizes.
UNKNOWN_BYTES = 2**60


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that Python workers hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts the
    lineage and survives the loss of any executor. Every call has its own folder."""
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(batches, text_field: str = "text"):
    """(batch, list of texts with null as empty) for each non-empty Arrow batch."""
    for b in batches:
        if b.num_rows:
            yield b, [t or "" for t in b.column(b.schema.get_field_index(text_field)).to_pylist()]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (node, root), root the
    smallest node reached; nodes without an edge don't appear.

    Alternating large-star and small-star contraction: each round joins edges
    with one minimum a node, so no neighbourhood is gathered in one task, and
    the number of rounds grows with the logarithm of a component's length.
    Each round is written to the shared folder; the driver sees two numbers.
    """
    spark = edges.sparkSession
    e = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    e = written(e, "edges")
    seen = None
    for _ in range(max_rounds):
        n, check = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, check) == seen:
            break
        seen = (n, check)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def blocks_for(df: DataFrame, bytes_per_block: int = 8 * 1024 * 1024) -> int:
    """How many blocks the rows of ``df`` are dealt to: one for so many bytes of its input files (which are compressed), and
    at least ``spark.sql.shuffle.partitions``, which is taken where Spark can't tell the bytes."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # noqa: SLF001
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return least if size >= UNKNOWN_BYTES else max(least, min(-(-size // bytes_per_block), MOST_BLOCKS))


def ordered_blocks(df: DataFrame, keys: list[str], blocks: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``df`` dealt into ``blocks`` ranges of the order given by the
    columns ``keys`` (nulls first; ``ties`` order rows of equal keys), each range
    sorted in one partition. Only ``keys`` are read to find the ranges. Adds

    * ``_block``: the range the row is read in,
    * ``_role``: 0 for the block's own rows, -1 / 1 for copies of the row just
      before / after the block (the order is a ring: the last block is followed
      by the first row of all), so that a task sees the neighbours of every row.

    Only the first and last key of each block reach the driver (``blocks`` pairs).
    A row is carried by exactly one block as its own, whatever the key's skew is:
    rows of equal keys share a block, so ``keys`` should end in an id.
    """
    spark = df.sparkSession
    key = F.struct(*[F.col(k) for k in keys])
    narrow = df.select(*keys).repartitionByRange(blocks, *[F.col(k).asc_nulls_first() for k in keys])
    ends = (
        narrow.select(F.spark_partition_id().alias("p"), key.alias("k"))
        .groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        .orderBy("p").collect()
    )
    order = lambda row: tuple((x is not None, x) for x in row)  # noqa: E731  nulls first
    los, his = [order(r["lo"]) for r in ends], [order(r["hi"]) for r in ends]
    n = len(ends)
    fields = df.schema.fields
    schema = T.StructType([*fields, T.StructField("_block", T.IntegerType()), T.StructField("_role", T.IntegerType())])

    def deal(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(b.schema.get_field_index(k)).to_pylist() for k in keys]
            take, block, role = [], [], []
            for i, row in enumerate(zip(*cols)):
                k = order(row)
                at = max(0, bisect_right(los, k) - 1)
                take.append(i), block.append(at), role.append(0)
                if k == los[at]:
                    take.append(i), block.append((at - 1) % n), role.append(1)
                if k == his[at]:
                    take.append(i), block.append((at + 1) % n), role.append(-1)
            out = b.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(block, pa.int32()), pa.array(role, pa.int32())], names=[*out.schema.names, "_block", "_role"]
            )

    dealt = df.mapInArrow(deal, schema) if n else spark.createDataFrame([], schema)
    return dealt.repartition(blocks, "_block").sortWithinPartitions(
        "_block", "_role", *[F.col(k).asc_nulls_first() for k in (*keys, *ties)]
    )
