"""HTML extraction, top-k search and tool-call linking against brute force."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest

from questlog.llm import html, toolcalls, topk

# ---- HTML ---------------------------------------------------------------------


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 12))] for _ in range(2))
        same = html.shared(a, b)
        assert len(same) == len(a) and sum(same) == brute_lcs(a, b)
        kept, at = [x for x, s in zip(a, same) if s], 0
        for x in kept:
            at = b.index(x, at) + 1


def page(body, n):
    return f"<html><head><title>T{n}</title></head><body><div>Welcome to the site</div><div>{body}</div><div>All about us</div></body></html>"


def test_pages_without_landmarks_lose_what_their_neighbours_share(spark):
    rows = [(i, f"http://h.org/a/{i}", page(f"Story number {i} is told here &amp; now", i), "x") for i in range(5)]
    rows += [(9, "http://other.org/a/1", page("Alone", 9), "x"), (10, None, None, "x"), (11, "x", "", "x"), (12, "http://h.org/a/1", rows[1][2], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in html.extract(pages.repartition(4)).collect()}
    for i in (0, 2, 3, 4):
        assert got[i].text == f"Story number {i} is told here & now" and got[i].n_chars == len(got[i].text)
    assert got[9].text == "Welcome to the site Alone All about us"  # no neighbour in its host
    assert got[10].text == got[11].text == "" and got[10].url is None
    assert "Story number 1" in got[1].text and "Story number 1" in got[12].text  # copies don't delete each other
    assert len(got) == len(rows)


def test_article_without_its_surroundings():
    text = """<!DOCTYPE html><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>
    <div class="ad">Buy</div><main><article><h1>Title &eacute;</h1><p>One <b>bold</b>word<p>Two&nbsp; three<br>four
    <script>var a="</p>";</script><style>p{}</style><!-- no --><form><input value=x>Search</form><aside>More</aside>
    <div class="comments"><article class="comment"><p>First!</p></article></div><p>End &am</article></main><div id="sidebar">S</div><footer>F</footer>"""
    assert html.main_text(html.lines(text), []) == "Title é One boldword Two three four End &am"
    assert html.lines("") == [] and html.lines("<p") == [] and html.lines("plain") == [("plain", False, False)]


ARTICLE = "<article><h1>Title</h1><p>One two three.</p><p>Four five.</p></article>"


@pytest.mark.parametrize(
    "body,text",
    [
        (f"<form id=aspnetForm><input type=hidden value=x><nav>Menu</nav>{ARTICLE}<footer>F</footer></form>", "Title One two three. Four five."),
        (f"<div><form action=/search><input> Search</div>{ARTICLE}", "Title One two three. Four five."),  # never closed
        ("<form><p>One.</p><p>Two.</p><p>Three.</p></form>", "One. Two. Three."),
        (f"{ARTICLE}<form><p>Subscribe</p></form>", "Title One two three. Four five."),
        ("<article><p>In</p><form>Mail <p>us</p></form><p>Out</p></article>", "In Out"),
        ('<article><p>Intro</p><svg class="i" viewBox="0 0" /><p>Rest</p><svg><text>x</text></svg><p>End</p></article>', "Intro Rest End"),
        ('<article><div class="share-price"><p>Price</p></div><div class="related-work"><p>Work</p></div><section id="search"><p>Search</p></section></article>', "Price Work Search"),
        ('<article><p>A</p><div class="share-bar">S</div><div class="x related_posts">R</div><div id="comments">C</div><p class="ad">B</p></article>', "A"),
        ('<div class="share-price">P</div><article><p>A</p></article>', "A"),
    ],
)
def test_parts_told_by_markup(body, text):
    assert html.main_text(html.lines(f"<html><body>{body}</body></html>"), []) == text


def test_a_page_of_unclosed_forms_is_read_in_one_pass():
    page = "<form>" * 20_000 + "<p>x</p>" * 20_000
    assert len(html.main_text(html.lines(page), [])) > 20_000


def test_long_page():
    body = "".join(f"<p>line {i}</p>" for i in range(3000))
    assert html.main_text(html.lines(f"<article>{body}</article>"), []).count("line") == 3000


# ---- top-k ---------------------------------------------------------------------


def brute_topk(rows, every, k):
    ok = {i: np.floor(256 * np.array(v, np.float64)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and i is not None}
    out = []
    for q, v in ok.items():
        if q % every == 0:
            score = sorted((-int((np.resize(v, 4) * x).sum()), i) for i, x in ok.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(score[:k])]
    return sorted(out)


@pytest.mark.parametrize("n", [3, 900])
def test_topk_against_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 100)
    monkeypatch.setattr(topk, "PAGE", 16)
    r = random.Random(n)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(n)]
    rows += [(n + i, [0.5, 0.25, 0.0, 0.0]) for i in range(150 if n > 3 else 0)]  # ties
    rows += [(5000, None), (5001, [1.0, None, 0.0, 0.0]), (5002, [float("nan"), 0.0, 0.0, 0.0]), (5003, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, score int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(tuple(x) for x in topk.top_k(df, every=50 if n > 3 else 1).collect())
    assert got == brute_topk(rows, 50 if n > 3 else 1, 5)


def test_search_skips_distances_and_stays_exact():
    g = np.random.default_rng(0)
    centres = g.standard_normal((40, 8)) * 50
    x = np.concatenate([c + g.standard_normal((50, 8)) for c in centres])
    pages = topk.build(x, 32)
    counted = []
    for q in x[::97]:
        found = topk.search(pages, x, 0, q, np.inf, 5, None, counted)
        want = np.sort(np.linalg.norm(x - q, axis=1))[:5]
        assert np.allclose(np.sort(np.linalg.norm(x[found] - q, axis=1))[:5], want)
    assert sum(counted) < 0.5 * len(x) * len(x[::97])


def brute_rows(rows, every, k=5):
    """Every row is one of its own: repeated query rows ask, and are found, as often as they are there."""
    w = [(i, np.floor(256 * np.array(v, np.float64))) for i, v in rows]
    out = []
    for at, (q, v) in enumerate(w):
        if q % every == 0:
            score = sorted((-int(sum(a * b for a, b in zip(v, x))), i) for n, (i, x) in enumerate(w) if n != at)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(score[:k])]
    return sorted(out)


def test_topk_answers_every_query_row(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 20)
    r = random.Random(4)
    rows = [(i % 60, [float(np.float32(r.gauss(0, 1))) for _ in range(3)]) for i in range(120)]  # two vectors an id
    rows += [rows[0], rows[0], rows[50], (100, []), (100, []), (150, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(x) for x in topk.top_k(df.repartition(3), every=50).collect()) == brute_rows(rows, 50)


def test_topk_of_empty_vectors(spark):
    rows = [(i, []) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(x) for x in topk.top_k(df).collect()) == brute_rows(rows, 50)


def test_topk_by_many_routes_on_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 32)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(tuple(x) for x in topk.top_k(df).collect()) == brute_rows(rows, 50)


def test_topk_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0


# ---- tool calls ------------------------------------------------------------------

CALL = '<tool_call>{"id":"a","name":"add","arguments":{"y":2,"x":1.50},"depends_on":["b"]}</tool_call><tool_call>{"id":"b","name":"reply","arguments":{"text":3}}</tool_call>'
MESSAGES = [
    (1, 0, "system", "be\nnice"), (1, 1, "user", 'hi "x" é / \t'), (1, 2, "assistant", "yo"), (1, 3, "user", ""), (1, 5, "user", None),
    (1, 5, "user", None), (2, 0, "user", "q"), (2, 1, "assistant", CALL), (2, 2, "tool", '{"tool_call_id":"a","content":{"z":1}}'),
    (2, 3, "tool", '{"tool_call_id":"zz","content":"n"}'), (2, 4, "assistant", "<tool_call>{bad</tool_call>"),
    (3, 0, "assistant", '<tool_call>{"id":"a","name":"n","arguments":{},"depends_on":["b"]}</tool_call><tool_call>{"id":"b","name":"n","arguments":{},"depends_on":["a"]}</tool_call>'),
    (None, 1, "user", "x"), (4, None, None, "x"), (5, 0, "assistant", "first"), (6, 0, "user", "one"), (6, 0, "user", "two"), (6, 1, "assistant", "z" * 100_000),
]


def test_linking(spark):
    df = spark.createDataFrame([(*m, 1, "c") for m in MESSAGES], "conv_id long, turn long, role string, text string, n int, content string")
    rows = toolcalls.link_calls(df.repartition(3)).collect()
    by = {(r.conv_id, r.position): r for r in rows}
    assert len(by) == len(rows) == 16  # two messages hold two calls each, one row is repeated, three results are linked
    one = by[1, 2]
    assert one.status == "linked" and one.valid and json.loads(one.json) == {
        "arguments": {"text": 'hi "x" é / \t', "turn": 1}, "depends_on": [], "id": "1:1", "name": "reply", "result": "yo"
    }
    assert one.json == json.dumps(json.loads(one.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert [by[1, p].status for p in (1, 3, 4)] == ["message", "no_result", "no_result"]
    assert by[1, 4].copies == 2 and not by[1, 4].valid and by[1, 3].valid
    at = {r.id: r for r in rows if r.conv_id == 2}
    assert at["b"].position < at["a"].position and not at["b"].valid and at["a"].valid is None
    assert json.loads(at["a"].json)["result"] == '{"z":1}' and '"x":1.5,"y":2' in at["a"].json
    assert at["zz"].status == "orphan_result" and "malformed" in at["2:4:0"].json
    assert {r.status for r in rows if r.conv_id == 3} == {"cycle"}
    assert by[None, 1].status == by[4, 1].status == by[5, 1].status == "message"
    assert sorted(r.status for r in rows if r.conv_id == 6) == ["duplicate", "linked"]
    assert toolcalls.link_calls(df.limit(0)).count() == 0


def test_odd_ids_and_names_stay_json(spark):
    odd = ["a\nb", "t\tx", 'q"q', "back\\slash", "\r\x0b\x01", "é 😀", ""]
    block = lambda **x: f"<tool_call>{json.dumps(x)}</tool_call>"
    rows = [(7, i, "assistant", block(id=x, name=x, arguments={x or "k": x})) for i, x in enumerate(odd)]
    rows += [(7, 100 + i, "tool", json.dumps({"tool_call_id": x, "content": x})) for i, x in enumerate(odd) if x]
    rows += [(None, 1, "assistant", block(id="n", name="n")), (None, 2, "tool", json.dumps({"tool_call_id": "n", "content": "c"})), (8, None, "assistant", block(id="m"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = toolcalls.link_calls(df).collect()
    assert all(isinstance(json.loads(r.json), dict) for r in got)
    by = {json.loads(r.json).get("id"): json.loads(r.json) for r in got if r.conv_id == 7}
    for x in odd:
        if x:
            assert by[x] == {"arguments": {x: x}, "depends_on": [], "id": x, "name": x, "result": x}
            same = next(r.json for r in got if r.conv_id == 7 and json.loads(r.json)["id"] == x)
            assert same.lower() == json.dumps(by[x], sort_keys=True, separators=(",", ":"), ensure_ascii=False).lower()
    assert [r.status for r in got if r.conv_id != 7] == ["message"] * 3  # rows without an identifier


def test_long_conversation_is_in_order(spark):
    n = 1000
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(toolcalls.link_calls(df).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, n // 2 + 1)) and [r.turn for r in got] == list(range(0, n, 2))


def test_blocks_follow_the_input_bytes(spark):
    from questlog.llm import common

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert common.blocks_for(pages) == least and common.blocks_for(pages, 16 * 1024) > 2 * least
