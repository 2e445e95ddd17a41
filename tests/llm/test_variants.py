"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest

from questlog.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, sig int, size int"


def make(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in zip(ids or range(len(texts)), texts)], SCHEMA)


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, every=spelling.EVERY):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    close = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and near(a, b):
            close[a].append(b)
            close[b].append(a)
    form = {}
    for w in n:
        if close[w]:
            best = min(close[w], key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None))
    return out


def got(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, docs=60):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeé") for _ in range(r.randint(6, 9))) for _ in range(25)] + ["ÀÉÎÕÜß×÷", "Straße" * 2]
    texts = []
    for _ in range(docs):
        words = []
        for _ in range(r.randint(0, 150)):
            w = list(r.choice(stems[: r.choice((3, 27))]))
            for _ in range(r.choice((0, 0, 0, 0, 1, 1, 2))):
                w[r.randrange(len(w))] = r.choice("abcxÉ")
            words.append("".join(w).upper() if r.random() < 0.1 else "".join(w))
        texts.append(" 7,\n".join(words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_against_brute_force(spark, seed):
    texts = [*corpus(seed), None, "", "a b c", "x" * 20_000, "日本語のテキスト", "tokyoŌtokyo"] + ["repeated Rowsss"] * 7
    ids = [*range(len(texts) - 3), None, 5, 5]
    assert got(spelling.variants(make(spark, texts, ids), every=7)) == brute(zip(ids, texts), 7)


def test_full_buckets_lose_no_pair(spark):
    r = random.Random(4)
    words = {"".join(r.sample("abcdef", 6)) for _ in range(400)} | {"".join(r.choice("ab") for _ in range(r.randint(6, 8))) for _ in range(200)}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = {tuple(sorted((a, b))) for a, b in combinations(words, 2) if near(a, b)}
    for bucket in (3, 256):
        pairs = [tuple(sorted(p)) for p in spelling.near_words(df, bucket).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


@pytest.mark.parametrize("n1,n2", [(1, 7), (1, 4), (2, 3), (3, 2)])
def test_near_words_share_a_signature(n1, n2):
    r = random.Random(n1)
    for _ in range(300):
        w = "".join(r.choice("abcdeé") for _ in range(r.randint(6, 12)))
        i = r.randrange(len(w))
        for other in (w[:i] + w[i + 1 :], w[:i] + r.choice("abxyz") + w[i + 1 :], w[:i] + "q" + w[i:]):
            assert set(spelling.signatures(w, n1, n2)) & set(spelling.signatures(other, n1, n2))


def test_roots_at_the_end_of_a_long_chain(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(27)], "word string, form string")
    assert {(r.word, r.root) for r in spelling.rooted(forms).collect()} == {(f"w{i}", "w27") for i in range(27)}


def test_no_documents(spark):
    assert spelling.variants(make(spark, [])).collect() == []
    assert spelling.variants(make(spark, ["short one", None])).collect() == []


def test_registered_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert got(spelling.op12_spelling(spark, folder)) == brute(rows)
