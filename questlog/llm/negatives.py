"""Hard-negative mining with spanning-tree bounds.

Vectors are whole numbers, floor(256 x); a score is an integer inner product. The
anchors are dealt to blocks, and each block's anchors are joined by a minimum spanning
tree of their Euclidean distances. A candidate c is scored exactly at the root. At a
child anchor a of a parent p, Cauchy and Schwarz bound its score by the parent's:

    score(a, c) lies in score(p, c) -+ |a - p| * |c|,

where the parent's score is itself exact or an interval. Every anchor has a window
of scores it is looking for, and only candidates whose interval overlaps it are
rescored; the others pass their interval on to the anchor's children.

Two searches use the same walk. Positives: rows of the anchor's label, the window
open above; its lower end is the fifth best of the chunks the block's anchors
live in, searched first. Negatives: rows of other labels, one window [0.8 s, s] for each
positive's score s.

The table is cut into chunks of about ``CHUNK`` rows by ranges of (label, nearest
routing object, id), so equal and near vectors share chunks and no chunk grows with a
hot label or vector. A page of summaries (ball, largest norm, labels) rules out chunks
for a block before their rows are read. Anchors, a hundredth of the rows, are what is
copied to the chunks, never the chunks to the anchors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, table, written

SCALE, EVERY, K = 256, 100, 5
# Anchors of a block, rows of a chunk, chunk summaries of a page, routing objects at most, rows (blobs) of an Arrow batch.
BLOCK, CHUNK, PAGE, ROUTES, BLOBS = 512, 4096, 4096, 256, 4
EXACT = 2.0**53  # below it, float64 sums of whole numbers are exact


def nodes_of(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v, copies): usable rows, equal ones counted together, labels shifted where 7 divides vec_id."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("e"))
    whole = F.transform("e", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    unusable = F.exists("e", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull()).where(~unusable)
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", shifted.alias("label"), whole.alias("v"))
    # zeros at the end are padding: without them equal vectors are equal arrays
    used = F.coalesce(F.array_max(F.transform("v", lambda x, i: F.when(x != 0, i + 1).otherwise(0))), F.lit(0))
    return rows.withColumn("v", F.slice("v", 1, used)).groupBy("vec_id", "label", "v").agg(F.count("*").alias("copies"))


def packed(rows: list, width: int) -> np.ndarray:
    """Whole-number vectors as one matrix, short ones padded with 0."""
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows of x (Prim): for each anchor its parent (-1 at the root), the
    length of the edge, and an order that visits parents first, larger subtrees last."""
    n = len(x)
    f = x.astype(np.float64)
    near, parent, done = np.full(n, np.inf), np.full(n, -1), np.zeros(n, bool)
    near[0], added = 0.0, []
    for _ in range(n):
        at = int(np.where(done, np.inf, near).argmin())
        done[at] = True
        added.append(at)
        gap = np.sqrt(((f - f[at]) ** 2).sum(1))
        closer = ~done & (gap < near)
        near[closer], parent[closer] = gap[closer], at
    below = np.ones(n, np.int64)
    children: list[list[int]] = [[] for _ in range(n)]
    for at in reversed(added):
        if parent[at] >= 0:
            below[parent[at]] += below[at]
            children[parent[at]].append(at)
    order, stack = [], [0]
    while stack:
        at = stack.pop()
        order.append(at)
        stack.extend(sorted(children[at], key=lambda c: -below[c]))  # the smallest is taken next, the largest last
    return parent, near, np.array(order)


def walk(anchors, tree, x, norms, windows, wanted, exact: bool, counted: list | None = None):
    """For each anchor, in the tree's order: (anchor, candidates, their exact scores), the candidates
    being those ``wanted(anchor)`` marks whose interval overlaps ``windows[anchor]`` (low, high).
    ``counted`` gathers how many candidates each anchor rescored."""
    parent, edge, order = tree
    left = np.bincount(parent[parent >= 0], minlength=len(parent))
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    xf = x.astype(np.float64) if exact else x
    for at in order:
        at = int(at)
        mine = wanted(at)
        if parent[at] < 0:
            take = np.arange(len(x))
            low, high = np.full(len(x), -np.inf), np.full(len(x), np.inf)
        else:
            low, high = held[parent[at]]
            reach = norms * (edge[at] * (1 + 1e-9)) + 1e-3
            low, high = low - reach, high + reach
            slack = 1e-9 * np.maximum(np.abs(low), np.abs(high))
            low, high = low - slack, high + slack
            left[parent[at]] -= 1
            if not left[parent[at]]:
                del held[parent[at]]
            a, b = windows[at]
            take = np.flatnonzero(mine & (high >= a) & (low <= b))
        if counted is not None:
            counted.append(len(take))
        if len(take):
            a = anchors[at].astype(np.float64) if exact else anchors[at]
            got = xf @ a if 2 * len(take) > len(x) else xf[take] @ a
            got = got[take] if len(got) > len(take) else got
            low[take] = high[take] = got
            keep = mine[take]
            yield at, take[keep], np.rint(got[keep]).astype(np.int64) if exact else got[keep]
        if left[at]:
            held[at] = (low, high)


def best(ids: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(found) > 4 * k:
        at_least = np.partition(found, len(found) - k)[len(found) - k]
        keep = np.flatnonzero(found >= at_least)
        return keep[np.lexsort((ids[keep], -found[keep]))[:k]]
    return np.lexsort((ids, -found))[:k]


CHUNKS = "chunk long, rows int, ids binary, labels binary, copies binary, v binary"
BLOCKS = "block long, rows int, ids binary, labels binary, copies binary, v binary, homes binary, parent binary, edge binary, visit binary"


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _pieces(batches, rows: int, width: int):
    """(number, columns, vectors) for each ``rows`` rows of a sorted partition; numbers differ between partitions."""
    held, n, made = [], 0, 0
    part = TaskContext.get().partitionId() << 32

    def out():
        t = pa.Table.from_batches(held)
        return part + made, {c: t.column(c).to_numpy().astype(np.int64) for c in t.column_names if c != "v"}, packed(t.column("v").to_pylist(), width)

    for b in batches:
        while b.num_rows:
            take = b.slice(0, rows - n)
            b = b.slice(take.num_rows)
            held.append(take)
            n += take.num_rows
            if n == rows:
                yield out()
                held, n, made = [], 0, made + 1
    if n:
        yield out()


def _one_row(number: int, blobs: list[np.ndarray], ddl: str, rows: int) -> pa.RecordBatch:
    columns = [pa.array([number], pa.int64()), pa.array([rows], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in blobs)]
    return pa.RecordBatch.from_arrays(columns, names=_names(ddl))


def ranges(df: DataFrame, keys: list[str], rows: int, n: int) -> DataFrame:
    """``df`` in sorted ranges of ``keys``, about half of ``rows`` rows each."""
    return df.repartitionByRange(max(1, -(-2 * n // rows)), *keys).sortWithinPartitions(*keys)


def chunked(nodes: DataFrame, width: int, n: int) -> DataFrame:
    """The nodes in ranges of (label, route, id), one row for each chunk of at most ``CHUNK``."""

    def run(batches):
        for number, c, v in _pieces(batches, CHUNK, width):
            yield _one_row(number, [c["vec_id"], c["label"], c["copies"], v], CHUNKS, len(v))

    return ranges(nodes, ["label", "route", "vec_id", "v"], CHUNK, n).select("vec_id", "label", "copies", "v").mapInArrow(run, CHUNKS)


def blocked(chunks: DataFrame, width: int, n: int, every: int) -> DataFrame:
    """Blocks of at most ``BLOCK`` anchors of neighbouring chunks with their spanning trees, one row each."""

    def anchors(batches):
        for b in batches:
            for r in b.to_pylist():
                c = _read(r, width, "chunk")
                at = np.flatnonzero(c["ids"] % every == 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), r["chunk"])), pa.array(c["ids"][at]), pa.array(c["labels"][at]), pa.array(c["copies"][at]), pa.array(c["v"][at].tolist(), pa.list_(pa.int64()))],
                        names=["chunk", "vec_id", "label", "copies", "v"],
                    )

    def run(batches):
        for number, c, v in _pieces(batches, BLOCK, width):
            parent, edge, order = spanning_tree(v)
            blobs = [c["vec_id"], c["label"], c["copies"], v, np.unique(c["chunk"]), parent.astype(np.int64), edge, order.astype(np.int64)]
            yield _one_row(number, blobs, BLOCKS, len(v))

    rows = chunks.mapInArrow(anchors, "chunk long, vec_id long, label long, copies long, v array<long>")
    return ranges(rows, ["chunk", "vec_id", "v"], BLOCK, n).mapInArrow(run, BLOCKS)


def _read(row, width: int, kind: str) -> dict:
    get = lambda c, t: np.frombuffer(row[c], t)
    out = {"ids": get("ids", "<i8"), "labels": get("labels", "<i8"), "copies": get("copies", "<i8"), "v": get("v", "<i8").reshape(-1, width)}
    if kind == "block":
        out |= {"block": row["block"], "tree": (get("parent", "<i8"), get("edge", "<f8"), get("visit", "<i8")), "homes": get("homes", "<i8")}
    return out


SUMMARY = "page int, chunk long, centre binary, radius double, norm double, low_label long, high_label long"


def summaries(chunks: DataFrame, width: int, pages: int) -> DataFrame:
    """One row for each of ``pages`` pages of chunks: their balls, largest norms and label ranges."""

    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                v, labels = np.frombuffer(r["v"], "<i8").reshape(-1, width).astype(np.float64), np.frombuffer(r["labels"], "<i8")
                centre = v.mean(0)
                rows.append((r["chunk"], centre.tobytes(), float(np.sqrt(((v - centre) ** 2).sum(1)).max()), int(labels.min()), int(labels.max())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=_names(SUMMARY))

    one = chunks.select("chunk", "v", "labels").mapInArrow(run, SUMMARY)
    ball = F.struct("chunk", "centre", "radius", "low_label", "high_label")
    return one.groupBy(F.pmod(F.xxhash64("chunk"), F.lit(pages)).cast("int").alias("page")).agg(F.collect_list(ball).alias("balls"))


SUMMARY = "chunk long, centre binary, radius double, low_label long, high_label long"


def visits(blocks: DataFrame, pages: DataFrame, n_pages: int, width: int, same_label: bool, homes: bool | None = None) -> DataFrame:
    """(block row, chunk) for every chunk whose ball and labels leave a block something to find. ``blocks`` has
    the windows' ends in ``lows`` and ``highs``. ``homes``: only the chunks the anchors live in, or only the others."""

    def run(batches):
        for b in batches:
            at, chunk = [], []
            balls_at = b.schema.get_field_index("balls")
            for i, r in enumerate(b.select([c for c in b.schema.names if c != "balls"]).to_pylist()):
                k = _read(r, width, "block")
                lows, highs = np.frombuffer(r["lows"], "<f8"), np.frombuffer(r["highs"], "<f8")
                balls = b.column(balls_at)[i].as_py()
                centre = np.stack([np.frombuffer(x["centre"]) for x in balls])
                f = k["v"].astype(np.float64)
                mid, spread = f @ centre.T, np.sqrt((f * f).sum(1))[:, None] * np.array([x["radius"] for x in balls]) * (1 + 1e-9) + 1
                spread = spread + 1e-9 * np.abs(mid)
                ok = (mid + spread >= lows[:, None]) & (mid - spread <= highs[:, None])
                first, last = np.array([x["low_label"] for x in balls]), np.array([x["high_label"] for x in balls])
                mine = k["labels"][:, None]
                ok &= (mine >= first) & (mine <= last) if same_label else ~((first == mine) & (last == mine))
                numbers = np.array([x["chunk"] for x in balls])
                ok = ok.any(0)
                if homes is not None:
                    ok &= np.isin(numbers, k["homes"]) == homes
                at += [i] * int(ok.sum())
                chunk += numbers[ok].tolist()
            keep = [c for c in b.schema.names if c not in ("balls", "page")]
            out = b.select(keep).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(chunk, pa.int64())], names=[*keep, "chunk"])

    paged = blocks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1)))).join(pages.hint("merge"), "page")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema.fields)
    return paged.select(*blocks.columns, "page", "balls").mapInArrow(run, f"{ddl}, chunk long")


FOUND = "block long, anchor int, part long, vec_id long, score long, copies long"


def searched(asked: DataFrame, chunks: DataFrame, width: int, exact: bool, same_label: bool, k: int) -> DataFrame:
    """Rows that can be among the first ``k`` of an anchor and window: (block, anchor, part, vec_id, score, copies).
    ``part`` is 0 for positives, the upper end of the window (a positive's score) for negatives."""

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                blk = _read(r, width, "block")
                ch = _read({c: r[f"c_{c}"] for c in ("ids", "labels", "copies", "v")}, width, "chunk")
                lows, highs = np.frombuffer(r["lows"], "<f8"), np.frombuffer(r["highs"], "<f8")
                norms = np.sqrt((ch["v"].astype(np.float64) ** 2).sum(1))
                same = lambda at: (ch["labels"] == blk["labels"][at]) == same_label
                parts = None
                if not same_label:
                    ends, parts = np.frombuffer(r["parts_end"], "<i8"), np.frombuffer(r["parts"], "<i8")
                for at, rows, got in walk(blk["v"], blk["tree"], ch["v"], norms, list(zip(lows, highs)), same, exact):
                    ids, copies = ch["ids"][rows], ch["copies"][rows]
                    if same_label:
                        own = (ids == blk["ids"][at]) & (ch["v"][rows] == blk["v"][at]).all(1)
                        copies = copies - own
                        keep = np.flatnonzero((copies > 0) & (got >= lows[at]))
                        for j in keep[best(ids[keep], got[keep], k)].tolist():
                            out.append((blk["block"], at, 0, int(ids[j]), int(got[j]), int(copies[j])))
                    else:
                        for top in parts[ends[at - 1] if at else 0 : ends[at]].tolist():
                            # whole numbers: 80 top <= 100 score <= 100 top
                            keep = np.flatnonzero((got <= top) & (got >= -(-4 * top // 5)))
                            for j in keep[best(ids[keep], got[keep], k)].tolist():
                                out.append((blk["block"], at, top, int(ids[j]), int(got[j]), int(copies[j])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *[pa.int64()] * 4))], names=_names(FOUND))

    side = chunks.select("chunk", *[F.col(c).alias(f"c_{c}") for c in ("ids", "labels", "copies", "v")])
    return asked.join(side.hint("merge"), "chunk").mapInArrow(run, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each (block, anchor, part), copies one by one: adds ``rank``."""
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    order = Window.partitionBy("block", "anchor", "part").orderBy(F.desc("score"), "vec_id", "copy")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("copy", "copies")


def _windows(blocks: DataFrame, ends: DataFrame) -> DataFrame:
    """``blocks`` with ``lows`` and ``highs`` from ``ends`` (block, anchor, low, high: double); anchors without a row have
    an empty window, and blocks without one are left out."""
    lists = ends.groupBy("block").agg(F.collect_list(F.struct("anchor", "low", "high", "parts")).alias("ends"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            low, high, parts, last = [], [], [], []
            n = b.column(b.schema.get_field_index("rows")).to_pylist()
            for rows, got in zip(n, b.column(b.schema.get_field_index("ends")).to_pylist()):
                a, z, own = np.full(rows, np.inf), np.full(rows, -np.inf), [[] for _ in range(rows)]
                for e in got:
                    a[e["anchor"]], z[e["anchor"]], own[e["anchor"]] = e["low"], e["high"], e["parts"] or []
                low.append(a.tobytes()), high.append(z.tobytes())
                parts.append(np.array([x for p in own for x in p], "<i8").tobytes())
                last.append(np.cumsum([len(p) for p in own]).astype("<i8").tobytes())
            keep = [c for c in b.schema.names if c != "ends"]
            more = [pa.array(x, pa.binary()) for x in (low, high, parts, last)]
            yield pa.RecordBatch.from_arrays([*b.select(keep).columns, *more], names=[*keep, "lows", "highs", "parts", "parts_end"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema.fields)
    return blocks.join(lists.hint("merge"), "block").select(*blocks.columns, "ends").mapInArrow(run, f"{ddl}, lows binary, highs binary, parts binary, parts_end binary")


def hard_negatives(embeddings: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (vec_id divisible by
    ``every``) and each of its first ``k`` other rows of the same label, the first ``k`` rows of other labels whose
    score lies between 80 % and 100 % of the positive's; higher scores first, ties to the smaller vec_id.

    Rows with a null vec_id, label or vector, or with a null or non-finite component take no part. Shorter vectors count as
    padded with 0; empty ones score 0. Repeated rows count as often as they are there: as positives (an anchor's own
    copies too), as negatives and as anchors, whose results come out repeated. Components and scores are whole numbers
    of 64 bits; beyond that they are undefined. No usable row or no anchor: no rows.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    nodes = written(nodes_of(embeddings), "nodes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    n, width, top, anchors = nodes.agg(F.count("*"), F.max(F.size("v")), F.max(norm), F.count_if(F.col("vec_id") % every == 0)).first()
    if not n or not anchors:
        return empty
    width, exact = max(1, width), top * top < EXACT
    wanted = max(1, min(ROUTES, -(-n // CHUNK)))
    heads = packed([r["v"] for r in nodes.orderBy(F.xxhash64("vec_id", "v")).limit(wanted).select("v").collect()], width).astype(np.float64)
    head2 = (heads * heads).sum(1)

    def route(batches):
        for b in batches:
            if b.num_rows:
                x = packed(b.column(b.schema.get_field_index("v")).to_pylist(), width).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array((head2 - 2 * (x @ heads.T)).argmin(1).astype("i4"))], names=[*b.schema.names, "route"])

    routed = nodes.mapInArrow(route, "vec_id long, label long, v array<long>, copies long, route int")
    chunks = written(chunked(routed, width, n), "chunks")
    n_pages = max(1, -(-chunks.count() // PAGE))

    # blobs are large: few to an Arrow batch, in what runs here
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(BLOBS))
    try:
        blocks = written(blocked(chunks, width, anchors, every), "blocks")
        pages = written(summaries(chunks, width, n_pages), "pages")
        open_ends = blocks.select("block", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("anchor"))
        none = F.array().cast("array<long>").alias("parts")
        open_ends = open_ends.select("block", "anchor", F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), none)
        home = visits(_windows(blocks, open_ends), pages, n_pages, width, True, True)
        first = written(searched(home, chunks, width, exact, True, k), "home")
        seeds = ranked(first, k).groupBy("block", "anchor").agg(F.count("*").alias("n"), F.min("score").alias("low"))
        seeds = open_ends.select("block", "anchor").join(seeds, ["block", "anchor"], "left").select(
            "block", "anchor", F.when(F.col("n") >= k, F.col("low").cast("double")).otherwise(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), none
        )
        others = visits(_windows(blocks, seeds), pages, n_pages, width, True, False)
        rest = written(searched(others, chunks, width, exact, True, k), "rest")
        positives = written(ranked(first.union(rest), k).withColumnRenamed("vec_id", "positive_id").withColumnRenamed("score", "positive_score"), "positives")
        low = F.ceil(F.col("positive_score") * 4 / 5).cast("double")
        # a negative score's window is empty: 80 s exceeds 100 s
        ends = positives.where("positive_score >= 0").groupBy("block", "anchor").agg(
            (F.min(low) - 1).alias("low"), F.max(F.col("positive_score").cast("double")).alias("high"), F.collect_set("positive_score").alias("parts")
        )
        asked = visits(_windows(blocks, ends), pages, n_pages, width, False)
        negatives = written(ranked(searched(asked, chunks, width, exact, False, k), k), "negatives")
    finally:
        spark.conf.set(setting, before)

    def named(batches):
        for b in batches:
            if b.num_rows:
                ids, copies = ([np.frombuffer(x, "<i8") for x in b.column(i).to_pylist()] for i in (1, 2))
                sizes = [len(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(b.column(0).to_numpy(), sizes), pa.int64()), pa.array(np.concatenate([np.arange(s) for s in sizes]), pa.int32()),
                        pa.array(np.concatenate(ids)), pa.array(np.concatenate(copies)),
                    ],
                    names=["block", "anchor", "anchor_id", "times"],
                )

    who = blocks.select("block", "ids", "copies").mapInArrow(named, "block long, anchor int, anchor_id long, times long")
    rows = positives.select("block", "anchor", "positive_id", "positive_score").join(
        negatives.select("block", "anchor", F.col("part").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")),
        ["block", "anchor", "positive_score"],
    )
    rows = rows.join(who, ["block", "anchor"]).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return rows.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_negatives(spark, sf_dir) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
