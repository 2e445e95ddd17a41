"""Exact top-k inner-product search by M-trees, best first.

Vectors are made whole numbers, floor(256 x). With M the largest norm of all,
a vector x gets one more component sqrt(M^2 - |x|^2) and a query q gets 0:
then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the largest inner products are the
smallest distances, in a metric.

The table is dealt to routing objects (the nearest one's subtree; a subtree
with many rows is split into chunks of bounded size), and each chunk is built
into an M-tree of pages: a page has entries with a vector, the distance to its
parent's routing object and, above the leaves, a covering radius. Pages are
rows of a table. A query first searches the chunk it would be stored in, which
bounds its k-th score; then only chunks whose covering ball comes nearer than
that bound, best first, skipping entries by the triangle inequality on stored
parent distances before any distance is computed. Scores are whole-number
inner products, so ties and order are exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, table, written

K = 5
SCALE = 256
EVERY = 50
# Rows of one M-tree, queries searched with it in one group, entries of a page, and routing objects at most.
CHUNK = 2048
QUERIES = 2048
PAGE = 128
ROUTES = 256
# Distances are computed in floating point: bounds are loosened by this much before they skip anything.
SLACK = 1e-3


def whole(x: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which lists of an Arrow array are usable, and those as whole numbers."""
    ok, out = [], []
    for v in x:
        v = v.values
        a = v.to_numpy(zero_copy_only=False).astype(np.float64) if v is not None and not v.null_count else None
        good = a is not None and bool(np.isfinite(a).all())
        ok.append(good)
        if good:
            out.append(np.floor(SCALE * a).astype(np.int64))
    return np.array(ok, bool), out


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v, norm2): whole-number vectors; rows with nulls or non-finite components take no part."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                ok, vs = whole(b.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).filter(pa.array(ok)),
                        pa.array([v.astype("<i8").tobytes() for v in vs], pa.binary()),
                        pa.array([int((v * v).sum()) for v in vs], pa.int64()),
                    ],
                    names=["vec_id", "v", "norm2"],
                )

    prepare(embeddings.sparkSession)
    narrow = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return narrow.mapInArrow(run, "vec_id long, v binary, norm2 long")


def matrix(column, width: int) -> np.ndarray:
    """Rows of whole numbers as floats, short vectors padded with 0."""
    out = np.zeros((len(column), width))
    for i, raw in enumerate(column):
        v = np.frombuffer(raw, "<i8")
        out[i, : len(v)] = v
    return out


def lifted(x: np.ndarray, top2: float) -> np.ndarray:
    """Points of the metric space: one more component evens out the norms."""
    return np.hstack([x, np.sqrt(np.maximum(top2 - (x * x).sum(1), 0))[:, None]])


def spread_objects(x: np.ndarray, n: int) -> np.ndarray:
    """Indices of about ``n`` points far from each other: farthest first."""
    chosen = [0]
    near = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(n, len(x)):
        at = int(near.argmax())
        if near[at] <= 0:
            break
        chosen.append(at)
        near = np.minimum(near, np.linalg.norm(x - x[at], axis=1))
    return np.array(chosen)


def build(x: np.ndarray, page: int = PAGE) -> list[dict]:
    """Bulk-load an M-tree: entries are dealt to the nearest of a page's spread
    objects until they fit in a page. Pages have entries (rows of x), the
    distance of each to the page's routing object, the covering radius of what is
    below and the child page (-1 at a leaf). Page 0 is the root; its routing object is row 0."""
    pages: list[dict] = []

    def grow(rows: np.ndarray, parent: int) -> tuple[int, float]:
        number = len(pages)
        pages.append({})
        to_parent = np.linalg.norm(x[rows] - x[parent], axis=1)
        if len(rows) <= page:
            pages[number] = {"rows": rows, "parent": to_parent, "radius": np.zeros(len(rows)), "child": np.full(len(rows), -1)}
            return number, float(to_parent.max(initial=0))
        heads = spread_objects(x[rows], min(page, -(-len(rows) // (page // 2))))
        if len(heads) < 2:  # one point many times over: cut it up as it is
            groups = np.array_split(np.arange(len(rows)), -(-len(rows) // page))
            heads = np.array([g[0] for g in groups])
        else:
            gaps = np.stack([np.linalg.norm(x[rows] - x[rows[h]], axis=1) for h in heads])
            near = gaps.argmin(0)
            groups = [np.flatnonzero(near == i) for i in range(len(heads))]
        keep = [i for i, g in enumerate(groups) if len(g)]
        made = [grow(rows[groups[i]], int(rows[heads[i]])) for i in keep]
        pages[number] = {
            "rows": rows[heads[keep]],
            "parent": to_parent[heads[keep]],
            "radius": np.array([r for _, r in made]),
            "child": np.array([c for c, _ in made]),
        }
        return number, float(to_parent.max())

    if len(x):
        grow(np.arange(len(x)), 0)
    return pages


def search(pages, x, root: int, q: np.ndarray, reach: float, k: int, barred: np.ndarray | None = None, counted: list | None = None):
    """Rows of x (without the ``barred`` ones) that can be among the k nearest of
    q and lie within ``reach``: best-first over the pages. ``root`` is the root
    page's routing object; ``counted`` gathers the numbers of distances computed."""
    queue = [(0.0, 0, float(np.linalg.norm(x[root] - q)))] if pages else []
    found_d, found_rows = np.empty(0), np.empty(0, np.int64)
    bound = reach
    while queue:
        least, number, d_parent = heapq.heappop(queue)
        if least > bound + SLACK:
            break
        p = pages[number]
        # the triangle inequality on stored distances: no distance is computed for what fails here
        open_ = np.abs(d_parent - p["parent"]) - p["radius"] <= bound + SLACK
        rows, child = p["rows"][open_], p["child"][open_]
        if not len(rows):
            continue
        gap = x[rows] - q
        d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        if counted is not None:
            counted.append(len(rows))
        if child[0] < 0:
            near = d <= bound + SLACK
            if barred is not None:
                near &= ~barred[rows]
            found_d, found_rows = np.append(found_d, d[near]), np.append(found_rows, rows[near])
            if len(found_d) >= k:
                bound = min(bound, float(np.partition(found_d, k - 1)[k - 1]))
        else:
            low = np.maximum(d - p["radius"][open_], 0)
            for a, c, dd in zip(low.tolist(), child.tolist(), d.tolist()):
                if a <= bound + SLACK:
                    heapq.heappush(queue, (a, c, dd))
    return found_rows[found_d <= bound + SLACK]


FOUND = "query long, vec_id long, score long"


def _search_group(width: int, top2: float, k: int):
    def run(key, trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(trees) and len(queries):
            trees = trees.sort_values("page")
            ids = np.concatenate([np.frombuffer(r, "<i8") for r in trees["ids"]])
            exact = np.concatenate([np.frombuffer(r, "<i8").reshape(-1, width) for r in trees["exact"]])
            pages, root = _read_pages(trees), int(trees["root"].iloc[0])
            x = lifted(exact.astype(np.float64), top2)
            whole_q = matrix(queries["v"], width)
            q = np.hstack([whole_q, np.zeros((len(whole_q), 1))])
            # |q - x|^2 = |q|^2 + M^2 - 2 q.x: the distance of a row that scores the bound
            reach = np.sqrt(np.maximum((whole_q**2).sum(1) + top2 - 2 * queries["bound"].to_numpy(np.float64), 0))
            reach = np.where(queries["bound"].isna(), np.inf, reach)
            for i, (number, vec_id) in enumerate(zip(queries["query"], queries["vec_id"])):
                own = np.flatnonzero(ids == vec_id)
                own = own[(exact[own] == whole_q[i]).all(1)][:1]  # one row is the query itself, its equals are not
                barred = np.zeros(len(ids), bool)
                barred[own] = True
                rows = search(pages, x, root, q[i], float(reach[i]), k, barred)
                scores = exact[rows] @ whole_q[i].astype(np.int64)
                out.extend((number, ids[rows[j]], scores[j]) for j in np.lexsort((ids[rows], -scores))[:k])
        return pd.DataFrame(out, columns=["query", "vec_id", "score"]).astype("int64")

    return run


PAGES = "route int, chunk int, page int, root long, ids binary, exact binary, own binary, parent binary, radius binary, child binary"


def _build_group(width: int, top2: float):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["vec_id", "v"])
        exact = matrix(rows["v"], width).astype("<i8")
        ids = rows["vec_id"].to_numpy("<i8")
        pages = build(lifted(exact.astype(np.float64), top2))
        out, at, new = [], 0, np.zeros(len(ids), np.int64)
        for p in pages:  # vectors are stored in the order of the leaves
            if p["child"][0] < 0:
                new[p["rows"]] = np.arange(at, at + len(p["rows"]))
                at += len(p["rows"])
        for n, p in enumerate(pages):
            mine = p["rows"] if p["child"][0] < 0 else np.empty(0, np.int64)
            out.append(
                (
                    int(key[0]), int(key[1]), n, int(new[0]), ids[mine].tobytes(), exact[mine].tobytes(), new[p["rows"]].astype("<i8").tobytes(),
                    p["parent"].tobytes(), p["radius"].tobytes(), p["child"].astype("<i8").tobytes(),
                )
            )
        return pd.DataFrame(out, columns=[f.split()[0] for f in PAGES.split(", ")])

    return run


def _read_pages(trees: pd.DataFrame) -> list[dict]:
    return [
        {"rows": np.frombuffer(own, "<i8"), "parent": np.frombuffer(parent), "radius": np.frombuffer(radius), "child": np.frombuffer(child, "<i8")}
        for own, parent, radius, child in zip(trees["own"], trees["parent"], trees["radius"], trees["child"])
    ]


def top_k(embeddings: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by
    ``every``, the ``k`` other rows of the largest whole-number inner product,
    ties to the smaller vec_id; all others, if fewer.

    Vectors that are null or hold a null or a non-finite component take no part;
    shorter vectors count as padded with 0, empty ones score 0. "Other" rows are
    all but the query's own: rows that repeat its vec_id, or the whole row, appear like
    any other, as often as they are there, and each of several query rows of one vec_id is a
    query of its own. A null vec_id takes no part. Empty table: no rows.
    """
    spark = embeddings.sparkSession
    rows = written(vectors(embeddings).where("vec_id is not null"), "vectors")
    n, top2, width = rows.agg(F.count("*"), F.max("norm2"), F.max(F.length("v"))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    top2, width = float(top2), max(1, int(width) // 8)  # vectors may all be empty
    # Routing objects: rows spread over the table by hash, at most ROUTES of them.
    wanted = max(1, min(ROUTES, -(-n // CHUNK)))
    picked = rows.orderBy(F.xxhash64("vec_id")).limit(wanted).select("v").collect()
    heads = lifted(matrix([bytes(r["v"]) for r in picked], width), top2)

    def route(batches):
        for b in batches:
            if b.num_rows:
                x = lifted(matrix(b.column(1).to_pylist(), width), top2)
                gaps = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (heads * heads).sum(1) - 2 * x @ heads.T, 0))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(gaps.argmin(1).astype("i4")), pa.array(gaps.min(1))], names=[*b.schema.names, "route", "gap"])

    routed = rows.select("vec_id", "v").mapInArrow(route, "vec_id long, v binary, route int, gap double")
    routed = written(routed, "routed")
    sizes = routed.groupBy("route").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()  # at most ROUTES rows
    chunks = {r["route"]: -(-r["n"] // CHUNK) for r in sizes}
    radius = {r["route"]: r["radius"] for r in sizes}
    split = F.lit(1)
    for r, c in chunks.items():
        if c > 1:
            split = F.when(F.col("route") == r, c).otherwise(split)
    place = F.pmod(F.xxhash64("vec_id", "v"), split.cast("long")).cast("int")
    trees = routed.withColumn("chunk", place).groupBy("route", "chunk").applyInPandas(_build_group(width, top2), PAGES)
    trees = written(trees, "pages")

    blocks = max(1, -(-(n // every) // QUERIES))
    # queries are numbered once: equal rows ask the same and are one query
    asked = routed.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v", "route").agg(F.count("*").alias("times"))
    asked = written(asked.withColumn("query", F.monotonically_increasing_id()).withColumn("chunk", place), "queries")
    spread = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")
    home = asked.select("vec_id", "v", "route", "chunk", spread, F.lit(None).cast("long").alias("bound"), "query")
    first = written(_searched(trees, home, blocks, width, top2, k), "home")
    bounds = first.groupBy("query").agg(F.count("*").alias("found"), F.min("score").alias("low")).select(
        "query", F.when(F.col("found") >= k, F.col("low")).alias("bound")
    )
    centres, reach_of, counts = heads, radius, chunks

    def visit(batches):
        """The other chunks whose covering ball a query's bound doesn't rule out."""
        for b in batches:
            if not b.num_rows:
                continue
            q = matrix(b.column(1).to_pylist(), width)
            bound = np.array([-np.inf if x is None else x for x in b.column(4).to_pylist()])
            reach = np.sqrt(np.maximum((q * q).sum(1) + top2 - 2 * np.where(np.isinf(bound), 0, bound), 0))
            reach[np.isinf(bound)] = np.inf
            point = np.hstack([q, np.zeros((len(q), 1))])
            gaps = np.sqrt(np.maximum((point * point).sum(1)[:, None] + (centres * centres).sum(1) - 2 * point @ centres.T, 0))
            take, to_route, to_chunk = [], [], []
            own = list(zip(b.column(2).to_pylist(), b.column(3).to_pylist()))
            for r, c in counts.items():
                for i in np.flatnonzero(gaps[:, r] - reach_of[r] <= reach + SLACK):
                    for part in range(c):
                        if own[i] != (r, part):
                            take.append(i), to_route.append(r), to_chunk.append(part)
            got = b.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [got.column(0), got.column(1), pa.array(to_route, pa.int32()), pa.array(to_chunk, pa.int32()), got.column(5), got.column(4), got.column(6)],
                names=["vec_id", "v", "route", "chunk", "block", "bound", "query"],
            )

    bounded = home.drop("bound").join(bounds, "query", "left").select("vec_id", "v", "route", "chunk", "bound", "block", "query")
    onward = bounded.mapInArrow(visit, "vec_id long, v binary, route int, chunk int, block int, bound long, query long")
    rest = _searched(trees, onward, blocks, width, top2, k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = first.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    who = asked.select("query", F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return ranked.join(who, "query").select("query_id", "rank", "vec_id", "score")


def _searched(trees: DataFrame, queries: DataFrame, blocks: int, width: int, top2: float, k: int) -> DataFrame:
    """Each (chunk, block of queries) is one bounded group: CHUNK vectors and about QUERIES queries."""
    copies = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["route", "chunk", "block"]
    return copies.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(_search_group(width, top2, k), FOUND)


def op2_topk(spark, sf_dir) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
