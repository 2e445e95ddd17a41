"""Spelling variant grouping by PartEnum signatures.

A word is the multiset of its letters, read as a binary vector with one
dimension for each (letter, how often so far): "letter" has l1 e1 t1 t2 e2 r1. One
inserted or deleted letter changes one dimension, one replaced letter two, so
words that differ by one letter lie within Hamming distance two.

PartEnum finds all pairs within distance K = 2 exactly. The dimensions are
partitioned twice: into N1 parts, at least one of which holds at most
K2 = ceil((K + 1) / N1) - 1 of the differences, and each of those into N2
subparts, of which all but at most K2 agree. A word's signatures enumerate, for
each part, the N2 - K2 subparts that may agree, with the hash of the vector's
projection on them: near words share one at least. Near words' lengths differ by
one at most, so a signature carries a length; each word is stored under its own
and asks for its own and the next. The equi-join of signatures is verified by the
edit distance, which also drops anagrams.

A signature that more than ``BUCKET`` words share is not paired off as it is: its
words are joined on (signature, word without one letter) instead, which near words
of one signature share as well; so no bucket's pairs grow with its square.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table, text_batches, written

LEAST_LETTERS, LEAST_COUNT, RATIO, EVERY = 6, 5, 5, 199
K, N1, N2 = 2, 1, 7
BUCKET = 256
# Distinct words a task counts before it passes them on.
HELD = 200_000
# UTF-8 of A-Z in lower case and of U+00C0 to U+00FF
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % LEAST_LETTERS)
PLAIN = re.compile(rb"[a-z]{%d,}" % LEAST_LETTERS)
MASK = 2**64 - 1


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters that can give a word (shorter ones give none) as UTF-8, only A-Z lower-cased."""
    return (PLAIN if text.isascii() else RUN).findall(text.encode("utf-8", "surrogatepass").lower())


def words_of(doc_id, text: str, every: int = EVERY) -> list[bytes]:
    """Words of one document; every ``every``-th run by hash loses a letter."""
    out = runs(text)
    prefix = crc32(f"{doc_id}:".encode())
    hit = [i for i, run in enumerate(out) if not crc32(run, prefix) % every]
    for i in hit:
        run = out[i].decode()
        at = crc32(out[i], prefix) % len(run)
        out[i] = (run[:at] + run[at + 1 :]).encode() if len(run) > LEAST_LETTERS else b""
    return [w for w in out if w] if hit else out


def counted(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """(word, n) over all documents: counted in each task, then summed."""

    def batch(c: Counter):
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in c], pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for b, texts in text_batches(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), texts):
                if len(text) >= LEAST_LETTERS:
                    held.update(words_of("" if doc_id is None else doc_id, text, every))
                if len(held) >= HELD:
                    yield batch(held)
                    held = Counter()
        if held:
            yield batch(held)

    prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return narrow.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def mixed(x: int) -> int:
    """A 64-bit hash of a whole number (splitmix64)."""
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


@lru_cache(100_000)
def dimension(letter: str, times: int, parts: int) -> tuple[int, int]:
    """The subpart and the hash of a dimension: a letter's ``times``-th occurrence."""
    return (ord(letter) * 3 + times * 5) % parts, mixed((ord(letter) << 32) | times)


@lru_cache(16)
def left_out(n1: int, n2: int, k2: int) -> list[list[tuple[tuple[int, ...], int]]]:
    """For each part, the subparts that a signature leaves out, with its number hashed."""
    return [[(out, mixed(part << 32 | i)) for i, out in enumerate(combinations(range(part * n2, part * n2 + n2), k2))] for part in range(n1)]


def signatures(word: str, n1: int = N1, n2: int = N2, k: int = K) -> list[int]:
    """PartEnum signatures of a word's letter multiset, as signed 64-bit numbers."""
    sums = [0] * (n1 * n2)
    seen: dict[str, int] = {}
    for letter in word:
        seen[letter] = times = seen.get(letter, -1) + 1
        at, h = dimension(letter, times, n1 * n2)
        sums[at] += h
    each = [mixed((x & MASK) ^ (i << 56)) for i, x in enumerate(sums)]
    out = []
    for part, choices in enumerate(left_out(n1, n2, -(-(k + 1) // n1) - 1)):
        total = sum(each[part * n2 : part * n2 + n2])
        for gone, salt in choices:
            h = ((total - sum([each[i] for i in gone])) ^ salt) * 0xBF58476D1CE4E5B9 & MASK
            out.append(h - (h >> 63 << 64))
    return out


def shortened(word: str) -> list[str]:
    """The word and what is left of it without one letter: near words share one of these."""
    return list(dict.fromkeys([word, *(word[:i] + word[i + 1 :] for i in range(len(word)))]))


def _spread(words: DataFrame, make, column: str, kind: str) -> DataFrame:
    """One row of ``words`` (its columns, ``column`` added) for each value of ``make(word)``."""
    at = words.columns.index("word")

    def run(batches):
        for b in batches:
            if b.num_rows:
                each = [make(w) for w in b.column(at).to_pylist()]
                out = b.take(pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each])))
                flat = pa.array([y for x in each for y in x], pa.int64() if kind == "long" else pa.string())
                yield pa.RecordBatch.from_arrays([*out.columns, flat], names=[*out.schema.names, column])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema.fields)
    return words.mapInArrow(run, f"{ddl}, {column} {kind}")


def one_letter_apart(a: str, b: str) -> F.Column:
    """Whether the words of two rows (``b`` of the same length or one longer) differ by one inserted, deleted or replaced
    code point. One edit leaves the first or the last half of the shorter one's letters alone, which is seen before the
    distance is computed."""
    same = F.col("own") == F.col("size")
    first = F.col(f"{a}_first") == F.when(same, F.col(f"{b}_first")).otherwise(F.col(f"{b}_first_less"))
    last = F.col(f"{a}_last") == F.when(same, F.col(f"{b}_last")).otherwise(F.col(f"{b}_last_less"))
    return (first | last) & (F.levenshtein(a, b, 1) == 1)


def _side(rows: DataFrame, name: str, *more, ends: tuple[str, ...] = ("first", "last")) -> DataFrame:
    return rows.select("sig", *more, F.col("word").alias(name), *[F.col(e).alias(f"{name}_{e}") for e in ends])


def near_words(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct words of ``words`` (column word, two letters at least) one letter apart, each pair once,
    the shorter (or else the smaller) word first."""
    words = words.select("word", F.length("word").alias("size"))
    ends = {f"{end}{less}": (end, F.expr(f"CAST((size - {int(bool(less))}) / 2 AS INT)")) for end in ("first", "last") for less in ("", "_less")}
    cut_out = {"first": lambda n: F.substring("word", F.lit(1), n), "last": lambda n: F.right("word", n)}
    words = words.select("word", "size", *[F.hash(cut_out[end](n)).alias(name) for name, (end, n) in ends.items()])
    signed = written(_spread(words, signatures, "sig", "long"), "signatures")
    # how many words are stored under a signature and length or ask for it: from counts alone
    own = signed.groupBy("sig", "size").agg(F.count("*").alias("n"))
    asking = own.select("sig", F.explode(F.array("size", F.col("size") + 1)).alias("size"), "n")
    hot = written(asking.groupBy("sig", "size").agg(F.sum("n").alias("n")).where(F.col("n") > bucket).select("sig", "size"), "hot-signatures")
    homes = _side(signed, "b", "size", ends=tuple(ends))
    asks = _side(signed, "a", F.col("size").alias("own"), F.explode(F.array("size", F.col("size") + 1)).alias("size"))
    once = ((F.col("own") < F.col("size")) | (F.col("a") < F.col("b"))) & one_letter_apart("a", "b")
    few = asks.join(hot, ["sig", "size"], "left_anti").join(homes, ["sig", "size"]).where(once).select("a", "b")

    def cut(x, name):
        return _spread(x.join(hot, ["sig", "size"], "left_semi").withColumnRenamed(name, "word"), shortened, "left", "string").withColumnRenamed("word", name)

    many = cut(asks, "a").join(cut(homes, "b"), ["sig", "size", "left"]).where(once).select("a", "b")
    return few.union(many).distinct()


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for each row (word, form) of a forest, the root found by doubling the steps: a form is
    ``RATIO`` times as frequent as its word, so five rounds reach any end of a 64-bit count."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(6):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return at


def variants(docs: DataFrame, every: int = EVERY, least: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row for each word of at least six code points that occurs
    at least ``least`` times in the texts.

    ``form`` is the near word of the largest count (ties: the smallest in code-point order) if that is at least
    ``ratio`` times the word's own; ``root`` follows forms to the end. Null and empty texts have no words, repeated
    rows count as often as they are there, a null doc_id enters the hash as an empty string, an empty table gives
    no rows; columns other than doc_id and text are not read.
    """
    words = written(counted(docs, every).where(F.col("n") >= least), "words")
    near = written(near_words(words), "near")
    both = near.union(near.select("b", "a")).toDF("word", "other")
    best = (
        both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.max("other_n").alias("form_n"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
        .select("word", "n_near", "form_n", F.col("best.other").alias("form"))
    )
    own = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    rows = words.join(best, "word", "left").select(
        "word", F.when(own, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(own, F.col("form_n")).alias("form_n")
    )
    rows = written(rows, "forms")
    roots = rooted(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
