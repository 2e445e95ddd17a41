"""Language identification by a bidirectional gated recurrent network over bytes.

Lower-cased UTF-8 text is read in windows of 64 bytes, forwards and backwards,
by two gated recurrent units; every byte gets the probabilities of all
languages, and a document's are the mean over its bytes. The network is
trained in numpy by backpropagation through time on a bounded, hashed sample
of documents of each language, and then labels whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table, text_batches

WINDOW = 64
HIDDEN = 8
# Training sample: about this many documents of each language, and windows of each document.
SAMPLE = 300
SAMPLE_WINDOWS = 8
STEPS = 400
BATCH = 96
UNKNOWN = "und"
# Rows of a batch that runs through the network at once, and bytes of text laid out for it.
ROWS = 1024
LAID_OUT = 1 << 22


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in rows of WINDOW, padded with 0, and each row's text."""
    raw = [t.lower().encode() for t in texts]
    n = [-(-len(r) // WINDOW) for r in raw]
    laid = b"".join(r.ljust(k * WINDOW, b"\0") for r, k in zip(raw, n))
    return np.frombuffer(laid, np.uint8).reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), n)


def fresh(classes: int, hidden: int = HIDDEN, seed: int = 1) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    draw = lambda *s, scale: (g.standard_normal(s) * scale).astype(np.float32)
    p = {"out": draw(2 * hidden, classes, scale=0.3), "bias": np.zeros(classes, np.float32)}
    for way in "fb":
        p[f"x{way}"] = draw(256, 3 * hidden, scale=0.5)  # gates' input of each byte: update, reset, candidate
        p[f"h{way}"] = draw(hidden, 3 * hidden, scale=hidden**-0.5)
    return p


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def run_one_way(p, way: str, seq: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (time, row, hidden) of one unit over ``seq`` (time, row)."""
    xs, u = p[f"x{way}"], p[f"h{way}"]
    k = u.shape[0]
    h = np.zeros((seq.shape[1], k), np.float32)
    out = np.empty((*seq.shape, k), np.float32)
    for t in range(len(seq)):
        x, hu = xs[seq[t]], h @ u
        gates = sigmoid(x[:, : 2 * k] + hu[:, : 2 * k])
        z, r = gates[:, :k], gates[:, k:]
        n = np.tanh(x[:, 2 * k :] + r * hu[:, 2 * k :])
        if keep is not None:
            keep.append((h, z, r, n, hu[:, 2 * k :]))
        h = n + z * (h - n)
        out[t] = h
    return out


def position_probabilities(p, rows: np.ndarray) -> np.ndarray:
    """(time, row, class) for ``rows`` of bytes."""
    seq = np.ascontiguousarray(rows.T)
    k = p["hf"].shape[0]
    logits = run_one_way(p, "f", seq) @ p["out"][:k] + run_one_way(p, "b", seq[::-1])[::-1] @ p["out"][k:] + p["bias"]
    logits -= logits.max(2, keepdims=True)
    np.exp(logits, out=logits)
    return logits / logits.sum(2, keepdims=True)


def gradients(p, rows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Backpropagation through time of the mean cross-entropy over all bytes."""
    seq = np.ascontiguousarray(rows.T)
    k, seen = p["hf"].shape[0], (seq > 0)
    kept = {"f": [], "b": []}
    hf, hb = run_one_way(p, "f", seq, kept["f"]), run_one_way(p, "b", seq[::-1], kept["b"])[::-1]
    logits = hf @ p["out"][:k] + hb @ p["out"][k:] + p["bias"]
    logits -= logits.max(2, keepdims=True)
    d = np.exp(logits)
    d /= d.sum(2, keepdims=True)
    d[:, np.arange(len(target)), target] -= 1
    d *= (seen / max(1, seen.sum()))[:, :, None]
    d = d.astype(np.float32)
    g = {name: np.zeros_like(v) for name, v in p.items()}
    g["bias"] = d.sum((0, 1))
    g["out"][:k], g["out"][k:] = np.einsum("trk,trc->kc", hf, d), np.einsum("trk,trc->kc", hb, d)
    for way, half, dd, order in (("f", slice(0, k), d, seq), ("b", slice(k, 2 * k), d[::-1], seq[::-1])):
        dh, u = np.zeros((len(target), k), np.float32), p[f"h{way}"]
        for t in range(len(order) - 1, -1, -1):
            h, z, r, n, hn = kept[way][t]
            dh = dh + dd[t] @ p["out"][half].T
            dn = dh * (1 - z) * (1 - n * n)
            da = np.concatenate([dh * (h - n) * z * (1 - z), dn * hn * r * (1 - r), dn], axis=1)
            dhu = np.concatenate([da[:, : 2 * k], dn * r], axis=1)
            np.add.at(g[f"x{way}"], order[t], da)
            g[f"h{way}"] += h.T @ dhu
            dh = dh * z + dhu @ u.T
    return g


def train(rows: np.ndarray, target: np.ndarray, classes: int, steps: int = STEPS, seed: int = 1) -> dict[str, np.ndarray]:
    """Adam over random batches in which every language is drawn as often."""
    p, g = fresh(classes, seed=seed), np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    of = [np.flatnonzero(target == c) for c in range(classes)]
    for step in range(1, steps + 1):
        at = np.concatenate([g.choice(x, max(1, BATCH // classes)) for x in of])
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, d in gradients(p, rows[at], target[at]).items():
            m[name] = 0.9 * m[name] + 0.1 * d
            v[name] = 0.99 * v[name] + 0.01 * d * d
            p[name] = p[name] - rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)
            p[name] = p[name].astype(np.float32)
    return p


def document_probabilities(p, texts: list[str]) -> np.ndarray:
    """(text, class): the mean over each text's bytes."""
    total = np.zeros((len(texts), len(p["bias"])))
    first, size = 0, 0
    for i, t in enumerate(texts):  # lay out a bounded number of bytes at a time
        size += len(t)
        if size >= LAID_OUT or i == len(texts) - 1:
            rows, of = windows(texts[first : i + 1])
            for a in range(0, len(rows), ROWS):
                part = rows[a : a + ROWS]
                pooled = (position_probabilities(p, part) * (part.T > 0)[:, :, None]).sum(0)
                np.add.at(total, of[a : a + ROWS] + first, pooled)
            first, size = i + 1, 0
    return total / np.maximum(total.sum(1, keepdims=True), 1e-9)


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], dict[str, np.ndarray]]:
    """Languages and network from (text, lang) rows; about ``sample`` distinct
    texts a language (all, if fewer), chosen by hash, and SAMPLE_WINDOWS windows a
    text reach the driver. Copies count once; every language that has a text with
    a byte is learned."""

    def pick(batches):
        for b, texts in text_batches(batches):
            out = []
            for t in texts:
                rows, _ = windows([t])
                out.append(rows[np.linspace(0, len(rows) - 1, min(len(rows), SAMPLE_WINDOWS)).astype(int)].tobytes() if len(rows) else b"")
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(out, pa.binary())], names=["lang", "rows"])

    prepare(docs.sparkSession)
    told = docs.where("lang is not null and text <> ''").select("text", "lang", F.xxhash64("text").alias("h"))
    counts = {r["lang"]: r["n"] for r in told.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return [], {}
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, min(1.0, sample / counts[lang])).otherwise(share)
    chosen = told.where(F.col("h").cast("double") / 2.0**64 + 0.5 <= share).dropDuplicates(["text", "lang"])
    read = lambda rows: [(r["lang"], bytes(r["rows"])) for r in rows.select("text", "lang").mapInArrow(pick, "lang string, rows binary").collect()]
    got = read(chosen)
    for lang in sorted(set(langs) - {lang for lang, _ in got}):  # no hash is low enough: its lowest
        got += read(told.where(F.col("lang") == lang).dropDuplicates(["text"]).orderBy("h").limit(sample))
    got.sort()
    rows = np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, WINDOW) for _, x in got])
    target = np.repeat([langs.index(lang) for lang, _ in got], [len(x) // WINDOW for _, x in got])
    return langs, train(rows, target, len(langs))


def predict(langs: list[str], p, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and its probability for each text; UNKNOWN and 0 without a letter."""
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    probabilities = document_probabilities(p, texts)
    best = probabilities.argmax(1)
    lettered = np.array([any(map(str.isalpha, t)) for t in texts])
    score = np.where(lettered, probabilities.max(1), 0.0)
    return [langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], np.clip(score, 0, 1)


def held_out(docs: DataFrame) -> F.Column:
    return F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    Trained on the documents that aren't held out (crc32 of doc_id modulo 4 is
    not 2) and have a language; only text is read for a prediction. A null text
    or one without a letter is ``und`` with score 0; so is every text when there
    is nothing to learn from. A null doc_id isn't held out. Copies score alike,
    repeated rows come out repeated. Empty table: no rows.
    """

    def run(batches):
        for b, texts in text_batches(batches):
            lang, score = predict(langs, p, texts)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    prepare(docs.sparkSession)
    langs, p = fit(docs.where(~held_out(docs)))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(docs).alias("held_out"), "text")
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with at least ``least`` probability, with all their columns."""

    def run(batches):
        for b, texts in text_batches(batches):
            lang, score = predict(langs, p, texts)
            yield b.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(lang, score)], pa.bool_()))

    langs, p = fit(docs.where(~held_out(docs)))
    return docs.mapInArrow(run, docs.schema)


def op5_language(spark, sf_dir) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
