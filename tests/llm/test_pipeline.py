"""The corpus pipeline against the same five decisions made in plain Python."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import regex

from questlog.llm import common, language, packing, privacy, quality, simhash

SF = "/root/testdata/sf0.001"


def brute_force(spark):
    docs = common.table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    weights = quality.fit(docs)
    kept = {i for i, s in zip(rows, quality._scores(weights, [r.text or "" for r in rows.values()])) if s >= quality.THRESHOLD}
    assert len(kept) > 0.7 * len(rows)
    left = docs.where(docs.doc_id.isin(list(kept)))
    langs, net = language.fit(left.where(~language.held_out(left)))
    ids = sorted(kept)
    told = language.predict(langs, net, [rows[i].text or "" for i in ids])
    ids = [i for i, lang, s in zip(ids, *told) if lang != "und" and s >= 0.4]
    fps = [simhash.fingerprint(rows[i].text or "") for i in ids]
    group = list(range(len(ids)))  # every pair, and the smallest id a group
    for _ in ids:
        before = list(group)
        for a in range(len(ids)):
            near = [b for b in range(len(ids)) if (fps[a] ^ fps[b]).bit_count() <= 3]
            low = min(group[b] for b in near)
            for b in near:
                group[b] = low
        if group == before:
            break
    return {ids[g] for g in set(group)}, rows


def test_pipeline_against_brute_force(spark):
    want, rows = brute_force(spark)
    docs = common.table(spark, SF, "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SF), "test")
        assert docs.columns == columns
    texts = {r.doc_id: r for r in docs.collect()}
    assert set(texts) == want and docs.count() == len(want)
    entities = regex.compile(privacy.ANY)
    for i, r in texts.items():
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (rows[i].lang, rows[i].source)
        found = entities.findall(rows[i].text)
        assert (r.text == rows[i].text) == (not found) and not any(x in r.text for x in found)
        assert entities.split(r.text) == entities.split(rows[i].text)  # all else is as it was
    pieces = corpus_pipeline.run(spark, SF).toPandas()
    assert set(pieces.doc_id) == want
    model = packing._tokenizer(packing.tokenizer_path())
    for i, g in pieces.groupby("doc_id"):
        n = len(model.tokenizer.encode(texts[i].text, add_special_tokens=False).ids) + 1
        g = g.sort_values("start")
        assert g.length.sum() == n == g.doc_tokens.iloc[0] and (np.cumsum(g.length) - g.length == g.start).all()
    assert pieces.groupby("sequence_id").length.sum().max() <= 2048


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    common.table(spark, SF, "documents").limit(0).write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
