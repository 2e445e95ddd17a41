"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from questlog.llm import ngrams

SCHEMA = "doc_id long, text string, n long, node long, s long, low long, component_id long"
WORDS = [f"w{i}" for i in range(400)]


def make(spark, texts, ids):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in zip(ids, texts)], SCHEMA)


def shingle_set(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(ids, texts):
    found = [shingle_set(t) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if found[i] and found[j] and 100 * len(found[i] & found[j]) >= 85 * len(found[i] | found[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    low = lambda i: min((x for x in groups[find(i)] if x is not None), default=None)
    return sorted((str(ids[i]), len(found[i]), str(low(i) if found[i] else ids[i])) for i in range(len(ids)))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def prose(r, n):
    return [r.choice(WORDS) for _ in range(n)]


def near(r, words, changes):
    out = list(words)
    for _ in range(changes):
        out[r.randrange(len(out))] = r.choice(WORDS)
    return out


def corpus(seed):
    r = random.Random(seed)
    passage = prose(r, 60)
    texts = []
    for _ in range(12):  # groups of near copies, some just beyond the share
        base = prose(r, r.choice((5, 30, 120, 400)))
        texts += [" ".join(near(r, base, r.randrange(0, max(1, len(base) // 20) + 1))) for _ in range(r.choice((1, 3, 8)))]
    texts += [" ".join(prose(r, 25) + passage + prose(r, 15)) for _ in range(25)]  # a passage that many share
    texts += [" ".join(passage + prose(r, r.choice((1, 4, 9)))) for _ in range(25)]  # little else than that passage
    base = prose(r, 100)
    texts += [" ".join(near(r, base, r.choice((1, 2, 3, 4)))) for _ in range(40)]
    chain = prose(r, 80)
    for i in range(30):  # a chain whose ends have nothing in common
        texts.append(" ".join(chain))
        chain = chain[2:] + prose(r, 2)
    texts += [t.upper() for t in texts[:4]] + texts[:6] + [None, "", " \n\t", "one", "One", "one two three", "ONE  two\x0bthree", "日 本 é É", "日 本 é é", "x" * 9000]
    r.shuffle(texts)
    ids = r.sample(range(1000), len(texts))
    ids[3], ids[7], ids[8] = None, ids[9], None
    return ids, texts


@pytest.mark.parametrize("seed,hot,leaders", [(1, 4, 1), (2, 256, 3), (3, 12, 2)])
def test_classes_against_all_pairs(spark, seed, hot, leaders):
    ids, texts = corpus(seed)
    assert got(ngrams.classes(make(spark, texts, ids).repartition(3), hot, leaders)) == brute(ids, texts)


def test_shuffled_texts_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "BROADCAST_ROWS", 0)
    ids, texts = corpus(5)
    assert got(ngrams.classes(make(spark, texts, ids), 8)) == brute(ids, texts)


def test_linked_is_the_exact_share():
    r = np.random.default_rng(1)
    for _ in range(400):
        n = int(r.integers(1, 1500))
        a = np.unique(r.integers(0, 10**6, n))
        b = np.unique(np.concatenate([a[r.random(len(a)) < r.choice([0.8, 0.93, 1.0])], r.integers(0, 10**6, int(n * r.choice([0, 0.07, 0.2])))]))
        if len(b):
            both = len(np.intersect1d(a, b))
            assert ngrams.linked(a, b, 64) == (100 * both >= 85 * (len(a) + len(b) - both))


def test_marks_never_exceed_the_difference():
    r = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(r.integers(-(2**63), 2**63 - 1, int(r.integers(1, 900))))
        b = np.unique(np.concatenate([a[r.random(len(a)) < r.random()], r.integers(-(2**63), 2**63 - 1, int(r.integers(0, 200)))]))
        bits = sum(int(x).bit_count() for x in np.bitwise_xor(ngrams.mark(a), ngrams.mark(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_sizes():
    for n in range(1, 3000):
        assert ngrams.at_least(n) == -(-85 * n // 100) and 1 <= ngrams.short_lists(n) <= ngrams.first_shingles(n) <= n
        assert ngrams.short_lists(n) == n or n - ngrams.short_lists(n) == ngrams.at_least(n) - ngrams.occurrences(n)


def test_many_near_copies_and_no_documents(spark):
    assert ngrams.classes(make(spark, [], [])).collect() == []
    r = random.Random(9)
    base = prose(r, 200)
    texts = [" ".join(near(r, base, r.choice((1, 5, 9)))) for _ in range(600)]
    assert got(ngrams.classes(make(spark, texts, range(600)))) == brute(range(600), texts)


def test_registered_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got(ngrams.op13_ngrams(spark, folder)) == brute([r.doc_id for r in rows], [r.text for r in rows])


def test_a_group_of_edited_copies_is_joined_by_its_centre(spark, monkeypatch):
    """Copies edited so much that two of them seldom link, but each with the text itself: the pairs of different
    components that are left to prove are no more than the copies."""
    r = random.Random(4)
    base = prose(r, 150)
    texts = [" ".join(base)] + [" ".join(near(r, base, r.choice((1, 2, 2, 3, 4)))) for _ in range(500)]
    proved = []

    def written(df, name, put=ngrams.written):
        out = put(df, name)
        proved.extend([out.count()] if name == "pairs" else [])
        return out

    monkeypatch.setattr(ngrams, "written", written)
    assert got(ngrams.classes(make(spark, texts, range(len(texts))))) == brute(range(len(texts)), texts)
    assert len(proved) == 2 and proved[1] <= len(texts), proved
