"""Quality classifier from weak labels.

Overlapping heuristic labellers vote clean, junk or nothing on every document.
Expectation maximisation over the counts of vote patterns (all documents; at
most 3 to the power of the labellers) estimates each labeller's accuracy, with
no gold label. The posterior of a document's pattern then labels a bounded
sample, on which a linear scorer over hashed features is trained; the scorer
rates every document.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table, text_batches, written

# Documents whose features train the scorer: the lowest hashes, about this many (all, if fewer).
SAMPLE = 4000
THRESHOLD = 0.5
CLASSES = 8  # kinds of bytes
SHAPES = CLASSES**4
BINS = 512
DIM = SHAPES + BINS
CHUNK = 1 << 16

_KIND = np.full(256, 0, np.uint8)  # letters in lower case, and bytes above ASCII
for _chars, _kind in (
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t\r", 3), ("\n\x0b\x0c", 4), (".,;:?'\"()-", 5), ("!", 6),
):
    _KIND[np.frombuffer(_chars.encode(), np.uint8)] = _kind
_KIND[np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)] = 7
_KIND[:9], _KIND[14:32], _KIND[127] = 7, 7, 7


def shapes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Counts of byte kinds and of four-grams of kinds."""
    kinds, grams = np.zeros(CLASSES, np.int64), np.zeros(SHAPES, np.int64)
    for i in range(0, len(raw), CHUNK):
        k = _KIND[np.frombuffer(raw[i : i + CHUNK + 3], np.uint8)].astype(np.int64)
        kinds += np.bincount(k[:CHUNK], minlength=CLASSES)
        if len(k) > 3:
            grams += np.bincount(((k[:-3] * CLASSES + k[1:-2]) * CLASSES + k[2:-1]) * CLASSES + k[3:], minlength=SHAPES)
    return kinds, grams


def measures(raw: bytes, kinds: np.ndarray, grams: np.ndarray) -> dict[str, float | None]:
    """What the labellers look at; None where a text is too short to tell."""
    words = raw.split()
    n = len(words)
    visible = int(kinds.sum() - kinds[3] - kinds[4])
    letters = int(kinds[0] + kinds[1])
    long = n >= 20
    lines = [x for x in raw.split(b"\n") if x.strip()]
    g = grams.reshape((CLASSES,) * 4)
    return {
        "symbols": kinds[7] / visible if visible >= 10 else None,
        "capitals": kinds[1] / letters if letters >= 20 else None,
        "letters": letters / visible if visible >= 100 else None,
        "shouts": kinds[6] / n if n >= 5 else None,
        "bare_symbols": g[3:5, 7, 3:5].sum() / n if n >= 5 else None,
        "symbol_ends": g[[0, 1, 2, 5, 6], 7].sum() / n if n >= 5 else None,
        "distinct_pairs": len(set(zip(words, words[1:]))) / (n - 1) if long else None,
        "sentences": sum(w[-1] in b".,;:?!" for w in words) / n if long else None,
        "top_word": Counter(words).most_common(1)[0][1] / n if long else None,
        "doubled": sum(map(bytes.__eq__, words, words[1:])) / (n - 1) if n >= 5 else None,
        "repeated_lines": 1 - len(set(lines)) / len(lines) if len(lines) >= 4 else None,
    }


# Fixed values: (measure, junk if at least, clean if at most); "distinct_pairs", "letters" and "sentences" are read the other way round.
LABELLERS = (
    ("symbols", 0.03, 0.01),
    ("capitals", 0.35, 0.15),
    ("letters", -0.7, -0.85),
    ("shouts", 0.2, 0.02),
    ("bare_symbols", 0.1, 0.02),
    ("symbol_ends", 0.1, 0.02),
    ("distinct_pairs", -0.5, -0.8),
    ("sentences", -0.03, -0.05),
    ("top_word", 0.25, 0.15),
    ("doubled", 0.2, 0.05),
    ("repeated_lines", 0.5, 0.2),
)


def votes(m: dict[str, float | None]) -> list[int]:
    """One vote a labeller: 2 clean, 1 junk, 0 none."""
    out = []
    for name, junk, clean in LABELLERS:
        x = m[name]
        if x is None:
            out.append(0)
            continue
        x = -x if junk < 0 else x
        out.append(1 if x >= junk else 2 if x <= clean else 0)
    return out


def pattern(v: list[int]) -> int:
    return sum(x * 3**i for i, x in enumerate(v))


def features(m: dict[str, float | None], grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features as (index, value): four-grams of byte kinds by the root of
    their share, and each measure's bin."""
    at = np.flatnonzero(grams)
    value = np.sqrt(grams[at] / max(1, grams.sum()))
    bins = [SHAPES + (i * 2654435761 + int(20 * x) * 40503) % BINS for i, x in enumerate(m.values()) if x is not None]
    return np.append(at, np.array(bins, np.int64)), np.append(value, np.full(len(bins), 0.3))


def label_model(counts: dict[int, int], rounds: int = 100) -> dict[int, float]:
    """Posterior probability of clean for each vote pattern, by expectation
    maximisation with labellers independent given the class. It starts from
    junk wherever a labeller says so, since each looks for one defect only."""
    k = len(LABELLERS)
    pats = np.array(sorted(counts))
    n = np.array([counts[p] for p in pats.tolist()], np.float64)
    v = np.stack([pats // 3**i % 3 for i in range(k)], axis=1)
    post = np.where((v == 1).any(1), 0.1, 0.95)
    for _ in range(rounds):
        w = np.stack([n * (1 - post), n * post])  # class 0 junk, 1 clean
        logp = np.log(w.sum(1) + 1.0)[:, None].repeat(len(pats), 1)
        for i in range(k):
            table_ = np.stack([w[:, v[:, i] == x].sum(1) for x in range(3)], axis=1) + 0.5
            table_ /= table_.sum(1, keepdims=True)
            told = v[:, i] > 0  # a labeller that is silent says nothing
            logp[:, told] += np.log(table_[:, 1:] / table_[:, 1:].sum(1, keepdims=True))[:, v[told, i] - 1]
        new = 1 / (1 + np.exp(np.clip(logp[0] - logp[1], -50, 50)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return dict(zip(pats.tolist(), post.tolist()))


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 300, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient descent; the last weight is the bias."""
    w = np.zeros(DIM + 1)
    if not rows:
        return w
    x = np.zeros((len(rows), DIM + 1), np.float32)
    x[:, DIM] = 1
    for r, (at, value, _) in enumerate(rows):
        np.add.at(x[r], at, value.astype(np.float32))
    y = np.array([p for *_, p in rows])
    look, last = w.copy(), w.copy()
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ look.astype(np.float32), -30, 30)))
        g = x.T @ ((p - y) / len(y)).astype(np.float32) + ridge * look
        last, w = w, look - 4.0 * g
        look = w + t / (t + 3) * (w - last)
    return w


def score(w: np.ndarray, at: np.ndarray, value: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip((w[at] * value).sum() + w[DIM], -30, 30))))


def _pack(at: np.ndarray, value: np.ndarray) -> bytes:
    return at.astype("<u2").tobytes() + value.astype("<f4").tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 6
    return np.frombuffer(raw[: 2 * n], "<u2").astype(np.int64), np.frombuffer(raw[2 * n :], "<f4")


def fit(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The scorer's weights: vote patterns of all documents, features of a sample."""

    def run(batches):
        for b, texts in text_batches(batches):
            chosen = b.column(b.schema.get_field_index("chosen")).to_pylist()
            pats, feats = [], []
            for t, c in zip(texts, chosen):
                raw = t.encode()
                kinds, grams = shapes(raw)
                m = measures(raw, kinds, grams)
                pats.append(pattern(votes(m)))
                feats.append(_pack(*features(m, grams)) if c and t.strip() else None)
            yield pa.RecordBatch.from_arrays([pa.array(pats, pa.int64()), pa.array(feats, pa.binary())], names=["pattern", "features"])

    prepare(docs.sparkSession)
    share = min(1.0, sample / max(1, docs.count()))
    spread = (F.xxhash64("text").cast("double") / 2.0**64 + 0.5) <= share
    voted = docs.select("text", F.coalesce(spread, F.lit(False)).alias("chosen")).mapInArrow(run, "pattern long, features binary")
    voted = written(voted, "votes")
    counts = {r["pattern"]: r["n"] for r in voted.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    posterior = label_model(counts) if counts else {}
    # one row for each text, so that a text with many copies isn't drawn as often; at most twice the sample
    rows = voted.where("features is not null").distinct().orderBy(F.xxhash64("features")).limit(2 * sample).collect()
    return train([(*_unpack(bytes(r["features"])), posterior[r["pattern"]]) for r in rows])


def _scores(weights: np.ndarray, texts: list[str]) -> np.ndarray:
    out = np.zeros(len(texts))
    for i, t in enumerate(texts):
        if t.strip():
            raw = t.encode()
            kinds, grams = shapes(raw)
            out[i] = score(weights, *features(measures(raw, kinds, grams), grams))
    return out


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, keep) for every document: the probability that it is clean.

    Null, empty or blank text scores 0 and is rejected. Copies score alike;
    repeated rows come out repeated. Other columns are never read. Empty table: no rows.
    """

    def run(batches):
        for b, texts in text_batches(batches):
            out = _scores(weights, texts)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out), pa.array(out >= threshold)], names=["doc_id", "score", "keep"])

    prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weights = fit(narrow)
    return narrow.mapInArrow(run, "doc_id long, score double, keep boolean")


def keep_clean(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""

    def run(batches):
        for b, texts in text_batches(batches):
            yield b.filter(pa.array(_scores(weights, texts) >= threshold))

    weights = fit(docs.select("text"))
    return docs.mapInArrow(run, docs.schema)


def op10_quality(spark, sf_dir) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
