"""Hard-negative mining against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from questlog.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, block int, chunk string, v int, score int"


def make(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "c", 2, 3) for i, v, label in rows], SCHEMA)


def usable(i, v, label):
    return i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, every=100, k=5):
    kept = []
    for i, v, label in rows:
        if usable(i, v, label):
            w = [math.floor(256 * float(np.float32(x))) for x in v]
            kept.append((i, int(math.fmod(label + 1, 10)) if i % 7 == 0 else label, w))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for at, (i, label, w) in enumerate(kept):
        if i % every:
            continue
        scored = [(-dot(w, x), j, other) for n, (j, other, x) in enumerate(kept) if n != at]
        for s, j, _ in sorted(r for r in scored if r[2] == label)[:k]:
            s = -s
            fit = sorted((a, b) for a, b, other in scored if other != label and 80 * s <= -100 * a <= 100 * s)
            out += [(i, j, n + 1, b, s, -a) for n, (a, b) in enumerate(fit[:k])]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def cloud(seed, n, d=6, centres=5, noise=0.2):
    r = np.random.default_rng(seed)
    c = r.normal(size=(centres, d))
    own = r.integers(centres, size=n)
    return [(i, (c[own[i]] + noise * r.normal(size=d)).astype(np.float32).tolist(), int(own[i] % 4)) for i in range(n)]


ODD = [
    (None, [1.0] * 6, 1), (300, None, 1), (400, [1.0, None, 1.0], 2), (500, [math.nan] * 6, 0), (600, [math.inf, 0.0], 0), (700, [1.0] * 6, None),
    (800, [], 1), (801, [], 2), (900, [0.0] * 6, 3), (1000, [1.0, 2.0], 3), (1001, [1.0, 2.0, 0.0], 2), (-100, [1.0] * 6, -1), (1100, [-1.0] * 6, 1),
]


@pytest.mark.parametrize("seed,chunk,block", [(1, 32, 4), (2, 4096, 512)])
def test_negatives_against_brute_force(spark, monkeypatch, seed, chunk, block):
    monkeypatch.setattr(negatives, "CHUNK", chunk)
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "PAGE", 4 if seed == 1 else 4096)
    rows = [*cloud(seed, 280), *ODD]
    # repeated rows, anchors among them; many equal vectors under ids and labels of their own
    rows += [rows[100], rows[100], rows[7], *((2000 + i, rows[200][1], i % 3) for i in range(40)), (200, rows[3][1], 2)]
    random.Random(seed).shuffle(rows)
    want = brute(rows)
    assert len(want) > 60
    assert got(negatives.hard_negatives(make(spark, rows).repartition(3))) == want


def test_walk_rescores_only_what_overlaps():
    r = np.random.default_rng(3)
    centres = r.integers(-2000, 2000, size=(4, 8))
    anchors = centres[r.integers(4, size=40)] + r.integers(-3, 4, size=(40, 8))
    x = centres[r.integers(4, size=2000)] + r.integers(-60, 60, size=(2000, 8))
    tree = negatives.spanning_tree(anchors)
    assert sorted(tree[2]) == list(range(40)) and (tree[0] == -1).sum() == 1
    true = anchors @ x.T
    low = np.sort(true, 1)[:, -5]
    windows = [(float(a), np.inf) for a in low]
    for exact in (True, False):
        rescored = []
        norms = np.sqrt((x.astype(float) ** 2).sum(1))
        seen = 0
        for at, rows, scores in negatives.walk(anchors, tree, x, norms, windows, lambda at: np.ones(len(x), bool), exact, rescored):
            assert (scores == true[at, rows]).all()
            assert set(np.flatnonzero(true[at] >= low[at])) <= set(rows.tolist())
            seen += 1
        assert seen == 40 and sum(rescored) < 0.6 * true.size


def test_numbers_beyond_float_sums(spark):
    rows = [(i, [float(2 ** (18 + i % 3)), float(i), 1.0], i % 2) for i in range(0, 1000, 20)]
    assert got(negatives.hard_negatives(make(spark, rows))) == brute(rows)


def test_no_rows_no_anchors(spark):
    assert negatives.hard_negatives(make(spark, [])).collect() == []
    assert negatives.hard_negatives(make(spark, [(1, [1.0], 1), (2, [1.0], 1), (100, None, 1)])).collect() == []
    assert negatives.hard_negatives(make(spark, [(100, [1.0], 1)])).collect() == []
