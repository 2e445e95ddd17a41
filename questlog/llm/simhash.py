"""SimHash near-dedup: segment-popcount embedding and a grid range join.

A 64-bit fingerprint is cut into 32 segments of 2 bits; the vector of the
segments' bit counts (0 to 2 each) is its embedding. Flipping one bit moves one
count by one, so the Manhattan distance of two embeddings never exceeds the
fingerprints' Hamming distance: what is far in the embedding is far in bits.
The counts are kept in thermometer code (0, 1, 2 as 00, 01, 11), in which the
Manhattan distance is the bit count of an XOR and a step of one is one bit.

Range join: of two embeddings within distance 3, one of the two halves (16
counts) is within distance 1. Each distinct fingerprint lies in one grid cell
of either half, and probes its own cell and the cells one count above it; the
fingerprint one count below does the probing for the other direction. Partners
are filtered by the embedding's distance, then verified by their bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, prepare, table, text_batches, written

WORDS = 3
MAX_BITS = 3
SEED = 42
# Copies of a component's row on the way to its documents: spreads a fingerprint that many documents share.
SALTS = 8


def fingerprint(text: str, words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of ``text`` (lower-cased A-Z, words separated by
    ASCII white space, shingles hashed by XXH64 with seed 42); 0 without a word."""
    w = text.encode().lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        hashes = [h(joined, SEED)]
    else:
        size = np.fromiter(map(len, w), np.int64, len(w))
        end = np.cumsum(size + 1) - 1
        begin = end - size
        hashes = [h(joined[a:b], SEED) for a, b in zip(begin[: 1 - words].tolist(), end[words - 1 :].tolist())]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        part = np.array(hashes[i : i + 8192], "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every row; null text counts as empty."""

    def run(batches):
        for b, texts in text_batches(batches):
            fps = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def embedding(fp) -> F.Column:
    """The 32 bit counts of ``fp`` in thermometer code, two bits each."""
    odd = F.lit(0x5555555555555555)
    other = F.shiftrightunsigned(fp, 1)
    one_at_least, two = fp.bitwiseOR(other).bitwiseAND(odd), fp.bitwiseAND(other).bitwiseAND(odd)
    return one_at_least.bitwiseOR(F.shiftleft(two, 1))


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column fp) that differ in at most ``max_bits`` <= 3 bits."""
    if max_bits > 3:
        raise ValueError("two halves and one step cover 3 bits")
    e = distinct_fps.select("fp", embedding(F.col("fp")).alias("u"))
    low32 = F.lit(0xFFFFFFFF)
    halves = e.select(
        "fp", "u",
        F.explode(F.array(
            F.struct(F.lit(0).alias("half"), F.col("u").bitwiseAND(low32).alias("code")),
            F.struct(F.lit(1).alias("half"), F.shiftrightunsigned("u", 32).alias("code")),
        )).alias("h"),
    ).select("fp", "u", "h.half", "h.code")
    # One count up: in a two-bit field 00 becomes 01, and 01 becomes 11.
    up = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(15)),
            lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), (i * 2).cast("int"))
            * F.when(F.call_function("shiftrightunsigned", F.col("code"), (i * 2).cast("int")).bitwiseAND(F.lit(1)) == 0, 1)
            .when(F.call_function("shiftrightunsigned", F.col("code"), (i * 2 + 1).cast("int")).bitwiseAND(F.lit(1)) == 0, 2)
            .otherwise(0),
        ),
        lambda step: step > 0,
    )
    cells = F.concat(F.array(F.lit(0).cast("long")), up)
    probes = halves.select(
        F.col("fp").alias("a"), F.col("u").alias("ua"), "half", F.col("code").alias("own"), F.explode(cells).alias("step")
    ).select("a", "ua", "half", F.col("own").bitwiseOR(F.col("step")).alias("code"), (F.col("step") == 0).alias("same"))
    homes = halves.select(F.col("fp").alias("b"), F.col("u").alias("ub"), "half", "code")
    near = (
        (~F.col("same") | (F.col("a") < F.col("b")))
        & (F.bit_count(F.col("ua").bitwiseXOR(F.col("ub"))) <= max_bits)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    return probes.join(homes, ["half", "code"]).where(near).select("a", "b")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, words: int = WORDS) -> DataFrame:
    """One row a document: (doc_id, fp, component_id, root).

    Documents of one fingerprint are one node, so copies are never paired.
    ``component_id`` is the smallest doc_id of the component, ``root`` its
    smallest fingerprint. Null text: empty (fingerprint zero). Repeated rows
    come out repeated. Null doc_ids are kept and don't name a component unless
    it has no other (then null). Empty table: no rows.
    """
    fps = written(fingerprints(docs, words=words), "fingerprints")
    salted = grouped(fps, max_bits).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (
        fps.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        .join(salted, ["fp", "salt"])
        .select("doc_id", "fp", "component_id", "root")
    )


def grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component_id, root) for each distinct fingerprint of (doc_id, fp)."""
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    linked = components(links(nodes, max_bits))
    member = nodes.join(linked, nodes.fp == linked.node).select("fp", "low", "root")
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "root").select("fp", "component_id", "root")
    return nodes.join(named.withColumn("found", F.lit(True)), "fp", "left").select(
        "fp",
        F.when(F.col("found"), F.col("component_id")).otherwise(F.col("low")).alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, words: int = WORDS) -> DataFrame:
    """The row of ``docs`` with each component's smallest doc_id, with all its columns.

    Where several rows have that doc_id in one component (or only nulls do), the
    one with the lowest hash stays; repeated rows become one.
    """
    fps = written(fingerprints(docs, words=words), "fingerprints")
    named = written(grouped(fps, max_bits), "components")
    wanted = named.where("component_id is not null").select(F.col("component_id").alias("doc_id")).distinct()
    times = fps.groupBy("doc_id").agg(F.count("*").alias("n"))
    wanted = written(wanted.join(times, "doc_id"), "wanted")
    key = docs["doc_id"].cast("long")
    once, often = (wanted.where(c).select(F.col("doc_id").alias("_wanted")) for c in ("n = 1", "n > 1"))
    # one join strategy at every size: the ids grow with the documents, so they are never a broadcast
    single = docs.join(once.hint("merge"), key == once["_wanted"], "left_semi")
    # rows of one doc_id: told apart by their own fingerprints
    rows = docs.join(often, key == often["_wanted"], "left_semi").unionByName(docs.where(docs["doc_id"].isNull()))
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("doc_id"), "text")

    def run(batches):
        for b, texts in text_batches(batches):
            fp = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["row", "doc_id", "fp"])

    rows = rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], T.StructField("fp", T.LongType())]))
    several = (
        rows.join(named, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    )
    return single.unionByName(several)


def op1_simhash(spark, sf_dir) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
