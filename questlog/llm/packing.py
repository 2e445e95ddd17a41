"""Packing by cutting-stock column generation.

Documents are tokenised once; whole windows of 2048 tokens are sequences of
their own, and what is left of each document (its remainder, under 2048
tokens) is packed. Remainders are counted in length classes of 8 tokens. A
linear program over patterns (how many pieces of each class share a sequence)
minimises the number of sequences; its columns come from an unbounded knapsack,
solved by dynamic programming over the dual prices. The rounded patterns are
given out to the documents by their rank in their class. The remainders that
no good pattern holds, and the few that rounding leaves, are laid end to end
and cut at 2048; the end of that stream is cut into powers of two, which need
no padding. What the linear program pays for cutting keeps most documents whole.

The driver sees the histogram (at most 256 counts) and the patterns only.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, table, text_batches, written

LENGTH = 2048
END_ID = 1
CLASS_WIDTH = 8
# What cutting a remainder costs in the linear program, in sequences: a pattern with more waste gives way to cutting.
CUT_COST = 0.005
# Sub-groups of a length class that are ranked apart, so that no class is one task's.
SUBS = 64
TOKENIZER = "word_bpe_49k.json"
CACHED_IDS = 2_000_000


# Signs between a letter and white space are a token group of their own.
SIGNS = re.compile(rb"[.,;:!?%&$*#|](?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[.,;:!?%&$*#|]*(?=[ \n])")


class Numbered(dict):
    """Numbers words as they are first asked for, and lists the new ones."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class WordTokenizer:
    """Token ids of whole texts through a cache of white-space-separated words.

    The vocabulary's normalizer lower-cases, its pre-tokenizer drops white space,
    and no token spans either white space or the end of a run of letters, so a
    text's ids are its words' ids in order. Words of letters are encoded many at
    a time and told apart by the tokens that end a word. The cache is emptied at
    a fixed size.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.index = Numbered()
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, "<u4")

    def _learn(self, words: list[bytes]) -> None:
        text = [w.decode() for w in words]
        begin, size = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        parts, total, other = [self.flat], len(self.flat), []
        plain = [i for i, t in enumerate(text) if t.isalpha()]
        for at in range(0, len(plain), 500):
            part = plain[at : at + 500]
            got = np.array(self._encode([" ".join([text[i] for i in part])])[0], "<u4")
            stops = np.flatnonzero(self.ends[got]) + 1
            if len(stops) == len(part):  # one word each
                size[part] = np.diff(stops, prepend=0)
                begin[part] = total + stops - size[part]
                parts.append(got)
                total += len(got)
            else:
                other += part
        other += [i for i, t in enumerate(text) if not t.isalpha()]
        for i, x in zip(other, self._encode([text[i] for i in other])):
            begin[i], size[i] = total, len(x)
            parts.append(np.array(x, "<u4"))
            total += len(x)
        self.begin, self.size = np.append(self.begin, begin), np.append(self.size, size)
        self.flat = np.concatenate(parts)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.flat) > CACHED_IDS:
            self._clear()
        numbers, number = [], self.index.__getitem__
        for t in texts:
            raw = t.encode()
            if b"<|" not in raw:  # else lower-casing might make a special token
                raw = SIGNS.sub(rb" \g<0>", raw.lower())
            words = raw.split()
            numbers.append(np.fromiter(map(number, words), np.int64, len(words)))
        if self.index.fresh:
            self._learn(self.index.fresh)
            self.index.fresh = []
        out = []
        for at in numbers:
            n = self.size[at]
            first = np.cumsum(n) - n
            out.append(self.flat[np.repeat(self.begin[at] - first, n) + np.arange(n.sum())])
        return out


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


_open: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _open:
        _open[path] = WordTokenizer(path)
    return _open[path]


TOKENISED = (
    "doc_id long, part long, idx long, doc_tokens long, full_before long, full_crcs array<long>, rest int, rest_crc long, rest_ids binary"
)


def tokenised(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """One row a document: its token count, the checksums of its whole windows,
    and the ids of its remainder. (part, idx) names the row once this is written."""

    def run(batches):
        tok = _tokenizer(path)
        part, idx, full = TaskContext.get().partitionId(), 0, 0
        for b, texts in text_batches(batches):
            rows = {k: [] for k in ("n", "before", "crcs", "rest", "crc", "ids")}
            for ids in tok.encode(texts):
                ids = np.append(ids, np.array([END_ID], "<u4"))
                k = len(ids) // length
                rest = ids[k * length :]
                rows["n"].append(len(ids))
                rows["before"].append(full)
                rows["crcs"].append([zlib.crc32(ids[i * length : (i + 1) * length]) for i in range(k)])
                rows["rest"].append(len(rest))
                rows["crc"].append(zlib.crc32(rest))
                rows["ids"].append(rest.tobytes())
                full += k
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(np.full(b.num_rows, part)),
                    pa.array(np.arange(idx, idx + b.num_rows)),
                    pa.array(rows["n"], pa.int64()),
                    pa.array(rows["before"], pa.int64()),
                    pa.array(rows["crcs"], pa.list_(pa.int64())),
                    pa.array(rows["rest"], pa.int32()),
                    pa.array(rows["crc"], pa.int64()),
                    pa.array(rows["ids"], pa.binary()),
                ],
                names=[f.split()[0] for f in TOKENISED.split(", ")],
            )
            idx += b.num_rows

    prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, TOKENISED)


def knapsack(price: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value of an unbounded knapsack and the number of each item in it."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(size, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if upto[c]:
            value = best[c - size[: upto[c]]] + price[: upto[c]]
            i = int(value.argmax())
            if value[i] > best[c] + 1e-12:
                best[c], last[c] = value[i], i
    counts, c = np.zeros(len(size), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= size[last[c]]
    return float(best[capacity]), counts


def cutting_stock(size: np.ndarray, demand: np.ndarray, capacity: int, cut: float = CUT_COST, gap: float = 1e-3, rounds: int = 6000):
    """Patterns and their fractional numbers: the revised simplex method on the
    master program, priced by :func:`knapsack`. ``size`` ascends. A remainder may
    also go to the stream that is cut, at the share of a sequence it fills plus
    ``cut``; these columns start the program, and come back with no items in them.
    Stops when no pattern is worth more than a sequence by ``gap``, or after
    ``rounds`` columns (what they leave goes to the stream)."""
    m = len(size)
    patterns = np.zeros((m, m), np.int64)  # row j: the items of basis column j
    cost = size / capacity + cut
    inverse, x = np.eye(m), demand.astype(np.float64)
    for _ in range(rounds):
        value, counts = knapsack(np.maximum(cost @ inverse, 0), size, capacity)
        if value <= 1 + gap:
            break
        step = inverse @ counts
        ratio = np.full(m, np.inf)
        np.divide(x, step, out=ratio, where=step > 1e-9)
        out = int(ratio.argmin())
        by = ratio[out]
        if not np.isfinite(by):
            break
        x = np.maximum(x - by * step, 0)
        x[out] = by
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        patterns[out], cost[out] = counts, 1
    return patterns, x


def rounded(patterns: np.ndarray, x: np.ndarray, demand: np.ndarray) -> np.ndarray:
    """Whole numbers of each pattern that never ask for more than there is:
    rounded down, then one more of a pattern, by falling fraction, while it fits."""
    times = np.where(patterns.any(1), np.floor(x + 1e-7), 0).astype(np.int64)
    left = demand - times @ patterns
    while (left < 0).any():  # the tolerance rounded a pattern up
        j = int(np.flatnonzero((patterns[:, left < 0].sum(1) > 0) & (times > 0))[0])
        times[j] -= 1
        left += patterns[j]
    for j in np.argsort(-(x - times), kind="stable"):
        if patterns[j].any() and x[j] > times[j] and (patterns[j] <= left).all():
            times[j] += 1
            left -= patterns[j]
    return times


def plan(histogram: dict[int, int], width: int = CLASS_WIDTH, length: int = LENGTH):
    """Rows (cls, lo, hi, first_sequence, each, place): the documents of class
    ``cls`` with ranks lo to hi - 1 go, ``each`` to a sequence, to the sequences
    from ``first_sequence`` on. Also the number of sequences."""
    if not histogram:
        return [], 0
    classes = np.array(sorted(histogram))
    demand = np.array([histogram[c] for c in classes.tolist()], np.int64)
    patterns, x = cutting_stock(classes, demand, length // width)
    times = rounded(patterns, x, demand)
    rows, used, first = [], np.zeros(len(classes), np.int64), 0
    for j in np.flatnonzero(times):
        for i in np.flatnonzero(patterns[j]):
            each = int(patterns[j, i])
            n = each * int(times[j])
            rows.append((int(classes[i]), int(used[i]), int(used[i]) + n, first, each))
            used[i] += n
        first += int(times[j])
    return rows, first


def stream_cuts(total: int, length: int = LENGTH) -> list[int]:
    """Where the last, short sequence of a stream of ``total`` tokens is cut:
    at falling powers of two."""
    at, cuts = total - total % length, []
    for bit in range(length.bit_length() - 1, -1, -1):
        if total % length & 1 << bit:
            at += 1 << bit
            cuts.append(at)
    return cuts


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text: empty, a document of the one closing id. Repeated rows and null
    doc_ids are packed like any other. Empty table: no rows. Other columns are
    not read, whatever their names.
    """
    spark = docs.sparkSession
    tok = written(tokenised(docs, path or tokenizer_path()), "tokenised")
    whole = tok.where(F.size("full_crcs") > 0).select(
        "doc_id", "doc_tokens", "part", "full_before", F.posexplode("full_crcs").alias("k", "ids_crc32")
    ).select(
        "doc_id",
        (F.col("k") * LENGTH).cast("long").alias("start"),
        F.lit(LENGTH).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        # odd numbers: part and the window's number in it; packed sequences are even
        ((F.shiftleft("part", 38) + F.col("full_before") + F.col("k")) * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    cls = F.ceil(F.col("rest") / CLASS_WIDTH).cast("int")
    rest = tok.where("rest > 0").select(
        "doc_id", "doc_tokens", "part", "idx", "rest", F.col("rest_crc").alias("ids_crc32"), cls.alias("cls"),
        F.pmod(F.xxhash64("part", "idx"), F.lit(SUBS)).cast("int").alias("sub"),
    )
    counts = rest.groupBy("cls", "sub").agg(F.count("*").alias("n")).collect()  # at most 256 x SUBS rows
    histogram: dict[int, int] = {}
    offsets = []
    for r in sorted(counts, key=lambda r: (r["cls"], r["sub"])):
        offsets.append((r["cls"], r["sub"], histogram.get(r["cls"], 0)))
        histogram[r["cls"]] = histogram.get(r["cls"], 0) + r["n"]
    rows, sequences = plan(histogram)

    places = spark.createDataFrame(
        [(c, lo, hi, first, each, i) for i, (c, lo, hi, first, each) in enumerate(rows)],
        "p_cls int, lo long, hi long, first long, each long, place int",
    )
    in_sub = Window.partitionBy("cls", "sub").orderBy("part", "idx")
    ranked = (
        rest.withColumn("in_sub", F.row_number().over(in_sub))
        .join(F.broadcast(_offsets(spark, offsets)), ["cls", "sub"])  # at most 256 x SUBS rows
        .withColumn("rank", F.col("before") + F.col("in_sub") - 1)
        .drop("in_sub", "before")
    )
    mine = (F.col("cls") == F.col("p_cls")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    # at most 256 patterns: the plan's rows don't grow with the data
    placed = written(ranked.join(F.broadcast(places), mine, "left").drop("p_cls"), "placed")
    in_sequence = Window.partitionBy("sequence_id").orderBy("place", "rank").rowsBetween(Window.unboundedPreceding, -1)
    packed = placed.where("place is not null").withColumn(
        "sequence_id", (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("each"))) * 2
    ).select(
        "doc_id",
        (F.col("doc_tokens") - F.col("rest")).alias("start"),
        F.col("rest").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("rest").over(in_sequence), F.lit(0)).cast("long").alias("offset"),
    )

    # The stream: running sums within (cls, sub), on top of the sums of the groups before.
    stream = placed.where("place is null").select("part", "idx", "cls", "sub", "rest")
    sums = stream.groupBy("cls", "sub").agg(F.sum("rest").alias("n")).collect()  # at most 256 x SUBS rows
    offsets, total = [], 0
    for r in sorted(sums, key=lambda r: (r["cls"], r["sub"])):
        offsets.append((r["cls"], r["sub"], total))
        total += r["n"]
    ends = in_sub.rowsBetween(Window.unboundedPreceding, 0)
    stream = (
        stream.withColumn("until", F.sum("rest").over(ends))
        .join(F.broadcast(_offsets(spark, offsets)), ["cls", "sub"])
        .select("part", "idx", (F.col("until") + F.col("before")).alias("until"))
    )
    cut = (
        tok.select("part", "idx", "doc_id", "doc_tokens", "rest", "rest_ids").where("rest > 0").join(stream, ["part", "idx"])
        .select("doc_id", "doc_tokens", "rest", "rest_ids", "until")
        .mapInArrow(lambda batches: _cut(batches, sequences, total), PIECES)
    )
    return whole.unionByName(packed).unionByName(cut)


def _offsets(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "cls int, sub int, before long")


def _cut(batches, first_sequence: int, total: int):
    """Pieces of the remainders in the stream, cut where its sequences end."""
    tail, whole_until = stream_cuts(total), total - total % LENGTH
    for b in batches:
        out = []
        for r in b.to_pylist():
            begin, until = r["until"] - r["rest"], r["until"]
            at = begin
            while at < until:
                if at < whole_until:
                    opens = at - at % LENGTH
                    closes, number = opens + LENGTH, opens // LENGTH
                else:
                    k = next(i for i, c in enumerate(tail) if at < c)
                    opens = tail[k - 1] if k else whole_until
                    closes, number = tail[k], whole_until // LENGTH + k
                stop = min(until, closes)
                ids = r["rest_ids"][4 * (at - begin) : 4 * (stop - begin)]
                start = r["doc_tokens"] - r["rest"] + at - begin
                out.append((r["doc_id"], start, stop - at, zlib.crc32(ids), r["doc_tokens"], 2 * (first_sequence + number), at - opens))
                at = stop
        names = [f.split()[0] for f in PIECES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(7)], names=names)


def op6_packing(spark, sf_dir) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
