"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document is the set of its distinct four-word shingles. Two sets of sizes n and m that
link share at least T = ceil(0.85 max(n, m)) shingles, so a partner of a document occurs in
at least T of the inverted lists of its n shingles. DivideSkip sets the L = T - t longest
lists aside: a partner must occur at least t times in the n - L short ones, which are merged,
and what is left is probed in the long ones.

* **Order.** Both documents must set aside by one order of all shingles: frequent ones (in
  ``HOT`` documents or more) are the long lists and come last; the hash breaks ties. Frequencies
  are counted over every document's first shingles by hash, somewhat more than its short
  lists; where too many of those are frequent, the document is taken apart in full.
* **Merge.** The short lists are a table sorted by shingle; merging them is Spark's sort-merge
  join of the lists with themselves, and a candidate's occurrences are counted per pair.
* **Bound.** Each set has a mark of ``MARKS`` bits, the parity of its hashes in as many buckets. Two marks differ in at most
  as many bits as the sets have shingles not in common, so most pairs that meet without linking (copies edited
  too much, a passage in common) are ruled out where the lists are merged, by a few XORs.
* **Probe.** A pair with t occurrences is probed with a binary search for each remaining
  shingle in the partner's sorted set, and given up as soon as T is out of reach.

Only the classes are asked for, so no group of copies is paired off. Documents of equal sets
are one node. Of each short list, first only the pairs with a few leading nodes are counted
and probed; a long list is also led by its centre, the node whose mark differs least from those of a few others. What
links two edited copies of a text mostly links each with the least edited one, so this joins a group of near copies
into one component; then the lists are merged again for the pairs of nodes in different components. A pair inside a component needs no proof, and every
other pair with t occurrences is probed: no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, prepare, table, text_batches, written

WORDS = 4
SHARE = (85, 100)
# t grows by one with so many shingles.
PER_OCCURRENCE = 100
# Bits of a set's mark, in words of 64.
MARKS = 512
HOT = 64
LEADERS = 3
# A list with so many nodes of about one size is also led by its centre, found by so many of its marks.
CROWD, SAMPLE = 16, 8
SEED = 0
# Below this number of rows, the ids of the nodes to be probed are broadcast (16 bytes each); above, texts are shuffled.
BROADCAST_ROWS = 1_000_000


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; the whole sequence is one where it has fewer words."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.int64)
    joined, h = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= words:
        hashes = [h(joined, SEED)]
    else:
        size = np.fromiter(map(len, w), np.int64, len(w))
        end = np.cumsum(size + 1) - 1
        begin = end - size
        hashes = [h(joined[a:b], SEED) for a, b in zip(begin[: 1 - words].tolist(), end[words - 1 :].tolist())]
    return np.unique(np.array(hashes, np.uint64).view(np.int64))


def at_least(n: int) -> int:
    """T: the overlap that a set of n shingles has with any partner."""
    return -(-SHARE[0] * n // SHARE[1])


def occurrences(n: int) -> int:
    """t: how often a partner must occur in the short lists."""
    return 1 + n // PER_OCCURRENCE


def short_lists(n: int) -> int:
    """How many lists are short: all but L = T - t."""
    return min(n, n - at_least(n) + occurrences(n))


def first_shingles(n: int) -> int:
    """How many of a set's hashes are read to find its short lists."""
    return min(n, short_lists(n) + n // 20 + 8)


def linked(a: np.ndarray, b: np.ndarray, block: int = 512) -> bool:
    """Whether two sorted sets overlap enough: the smaller one's shingles are probed in the larger one."""
    if len(a) > len(b):
        a, b = b, a
    total = SHARE[0] + SHARE[1]
    need = -(-SHARE[0] * (len(a) + len(b)) // total)
    if len(a) < need:
        return False
    found = 0
    for i in range(0, len(a), block):
        part = a[i : i + block]
        at = np.searchsorted(b, part)
        found += int((b[np.minimum(at, len(b) - 1)] == part).sum())
        if found + len(a) - i - len(part) < need:
            return False
    return found >= need


SETS = "doc_id long, text_hash long, n long, node long, first array<long>, mark array<long>"


def mark(hashes: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes in each of ``MARKS`` buckets, as 64-bit words."""
    odd = np.bincount(hashes & (MARKS - 1), minlength=MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def differing(a: F.Column, b: F.Column) -> F.Column:
    """The number of bits in which two marks differ."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(MARKS // 64)), F.lit(0))


def may_link(a: str, b: str) -> F.Column:
    """Whether sizes (columns n and the side's name) and marks allow two sets to link: they have at most so many
    shingles not in common as the marks differ in bits."""
    both = F.col(f"n{a}") + F.col(f"n{b}")
    total = SHARE[0] + SHARE[1]
    most = both - 2 * F.floor((SHARE[0] * both + (total - 1)) / total)
    return size_fits(f"n{a}", f"n{b}") & (differing(F.col(f"mark{a}"), F.col(f"mark{b}")) <= most)


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n, node, first, mark) of every row: set size, the set's hash, its first shingles by hash, its mark."""

    def run(batches):
        for b, texts in text_batches(batches):
            found = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(1), pa.array([len(s) for s in found], pa.int64()),
                    pa.array(np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in found], np.uint64).view(np.int64)),
                    pa.array([s[: first_shingles(len(s))] for s in found], pa.list_(pa.int64())),
                    pa.array([mark(s) for s in found], pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n", "node", "first", "mark"],
            )

    prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text"))
    return narrow.mapInArrow(run, SETS)


def whole_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, shingles) for ``nodes`` (node, text_hash, low), made again from one of their texts."""
    wanted = written(nodes.select("node", "text_hash", "low"), "wanted")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), F.col("doc_id").cast("long").alias("low"), "text")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted.hint("merge")
    same = texts["text_hash"].eqNullSafe(side["text_hash"]) & texts["low"].eqNullSafe(side["low"])
    rows = texts.join(side, same).select("node", "text")

    def run(batches):
        for b, texts in text_batches(batches):
            found = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "n", "shingles"]
            )

    # a row that is there several times gives its node several times
    return rows.mapInArrow(run, "node long, n long, shingles binary").groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))


def _exploded(wholes: DataFrame) -> DataFrame:
    """Whole sets as (node, n, first) rows."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                lists = pa.array([np.frombuffer(x, np.int64) for x in b.column(2).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["node", "n", "first"])

    return wholes.select("node", "n", "shingles").mapInArrow(run, "node long, n long, first array<long>")


def short_postings(nodes: DataFrame, hot: DataFrame) -> DataFrame:
    """(node, n, short) of ``nodes`` (node, n, first): the shingles of the short lists in the order (frequent, hash);
    null where ``first`` doesn't reach far enough to tell."""
    hits = nodes.select("node", F.posexplode("first").alias("place", "s")).join(hot, "s", "left_semi")
    hits = hits.groupBy("node").agg(F.collect_list("place").alias("hot"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            out = []
            first, frequent = b.column(2), b.column(3)
            for i, n in enumerate(b.column(1).to_pylist()):
                s = first[i].values.to_numpy()
                p, late = short_lists(n), frequent[i].as_py()
                if late:
                    mark = np.zeros(len(s), bool)
                    mark[late] = True
                    out.append(None if (~mark).sum() < p and len(s) < n else np.concatenate([s[~mark], s[mark]])[:p])
                else:
                    out.append(s[:p])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64()))], names=["node", "n", "short"])

    return nodes.join(hits.hint("merge"), "node", "left").select("node", "n", "first", "hot").mapInArrow(run, "node long, n long, short array<long>")


def size_fits(a: str, b: str) -> F.Column:
    """Whether two set sizes allow a link."""
    return F.lit(SHARE[1]) * F.least(a, b) >= F.lit(SHARE[0]) * F.greatest(a, b)


def enough() -> F.Column:
    """Whether two documents met in t short lists (column ``times``), t being the smaller one's."""
    return F.col("times") >= 1 + F.floor(F.least("na", "nb") / PER_OCCURRENCE)


def probed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The links among ``pairs`` (a, b), and the whole sets that were made for them (``known``: those made before)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if known is not None:
        ids = ids.join(known.select("node"), "node", "left_anti")
    made = written(whole_sets(docs, nodes.join(ids, "node", "left_semi")), "sets")
    wholes = made if known is None else known.unionByName(made)

    def run(batches):
        for b in batches:
            if b.num_rows:
                sides = [[np.frombuffer(x, np.int64) for x in b.column(i).to_pylist()] for i in (2, 3)]
                keep = pa.array([linked(x, y) for x, y in zip(*sides)])
                yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    x = wholes.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = wholes.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    links = pairs.select("a", "b").join(x.hint("merge"), "a").join(y.hint("merge"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")
    return written(links, "links"), wholes


def short_list_table(docs: DataFrame, nodes: DataFrame, hot_at: int = HOT) -> DataFrame:
    """The inverted short lists that two nodes or more may share: (s, node, n)."""
    counts = nodes.select(F.explode("first").alias("s")).groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    counts = written(counts, "frequencies")
    hot = written(counts.where(F.col("df") >= hot_at).select("s"), "frequent")
    easy = written(short_postings(nodes.select("node", "n", "first"), hot), "short")
    hard = nodes.join(easy.where("short IS NULL").select("node"), "node", "left_semi")
    whole = written(short_postings(_exploded(whole_sets(docs, hard)), hot), "short-whole")
    keys = counts.select("s").union(whole.select(F.explode("short").alias("s"))).distinct()
    every = easy.where("short IS NOT NULL").union(whole).select(F.explode("short").alias("s"), "node", "n")
    return written(every.join(keys, "s", "left_semi"), "lists")


def centres(sized: DataFrame, nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(s, size, a, m): of each list in ``sized`` (s, node, n, size) with ``crowd`` nodes of a size or more, the node whose mark
    is nearest to a sample of theirs, and its size."""
    crowded = sized.groupBy("s", "size").agg(F.count("*").alias("many")).where(F.col("many") >= crowd)
    held = sized.join(crowded, ["s", "size"], "left_semi").join(nodes.select("node", "mark").hint("merge"), "node")
    held = written(held.select("s", "size", "node", "n", "mark"), "crowded")
    some = held.groupBy("s", "size").agg(F.array(*[F.min_by("mark", F.xxhash64("node", F.lit(i))) for i in range(SAMPLE)]).alias("marks"))
    apart = sum((differing(F.col("mark"), F.col("marks")[i]) for i in range(SAMPLE)), F.lit(0))
    near = held.join(some, ["s", "size"]).groupBy("s", "size").agg(F.min(F.struct(apart.alias("apart"), "node", "n")).alias("head"))
    return near.select("s", "size", F.col("head.node").alias("a"), F.col("head.n").alias("m"))


def classes(docs: DataFrame, hot_at: int = HOT, leaders: int = LEADERS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: its set's size and the smallest doc_id that links reach.

    Null and empty texts and those without words have an empty set and link with nothing, not even with each other.
    Rows of equal sets are in one component. Repeated rows come out repeated. A null doc_id is kept and doesn't name a
    component unless it has no other (then null). Empty table: no rows. Columns other than doc_id and text are not read.
    """
    own = written(sets(docs), "sets")
    some = own.where("n > 0")
    nodes = some.groupBy("node", "n").agg(F.min("doc_id").alias("low"), F.min_by("text_hash", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("text_hash"), F.first("first").alias("first"), F.first("mark").alias("mark"))
    nodes = written(nodes, "nodes")
    lists = short_list_table(docs, nodes, hot_at)
    sides = [nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("mark").alias(f"mark{x}")) for x in "ab"]

    # the few that lead each list, among nodes of about one size: the same few in all the lists of a group of near copies
    size = F.floor(F.log(F.col("n")) / F.log(F.lit(SHARE[1] / SHARE[0]))).alias("size")
    sized = lists.select("s", "node", "n", size)
    heads = sized.groupBy("s", "size").agg(
        F.count("*").alias("many"), F.array_distinct(F.array(*[F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(i))) for i in range(leaders)])).alias("heads")
    ).where("many > 1")
    heads = heads.select("s", "size", F.explode("heads").alias("head")).select("s", "size", F.col("head.node").alias("a"), F.col("head.n").alias("m"))
    heads = heads.union(centres(sized, nodes)).distinct()
    pairs = sized.join(heads, ["s", "size"]).where((F.col("node") != F.col("a")) & size_fits("n", "m"))
    pairs = pairs.groupBy(F.least("node", "a").alias("a"), F.greatest("node", "a").alias("b")).agg(F.count("*").alias("times"))
    for x, side in zip("ab", sides):
        pairs = pairs.join(side.hint("merge"), x)
    first, wholes = probed(written(pairs.where(may_link("a", "b") & enough()).select("a", "b"), "pairs"), docs, nodes)
    found = components(first)

    # the rest: lists that reach into several components, pairs of nodes in different ones
    owned = lists.join(found.select("node", "root"), "node", "left").select("s", "node", "n", F.coalesce("root", "node").alias("c"))
    owned = written(owned, "owned")
    mixed = owned.groupBy("s").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("s")
    left = owned.join(mixed, "s", "left_semi")
    one, other = (left.join(side.hint("merge"), left["node"] == side[x]).select("s", x, F.col("c").alias(f"c{x}"), f"n{x}", f"mark{x}") for x, side in zip("ab", sides))
    met = one.join(other.hint("merge"), "s").where((F.col("ca") < F.col("cb")) & may_link("a", "b"))
    met = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("times"))
    rest, _ = probed(written(met.where(enough()).select("a", "b"), "pairs"), docs, nodes, wholes)
    found = components(first.union(rest))

    named = nodes.join(found.select("node", "root"), "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = written(named.join(lowest, "root").select("node", "component_id"), "named")
    alone = own.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def op13_ngrams(spark, sf_dir) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
