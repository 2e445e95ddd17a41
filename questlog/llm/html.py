"""HTML extraction by nearest-URL page differencing.

Pages are sorted by host and URL path, so a page's neighbours in that order are
the nearest URLs of its host. A page is read into text lines (one a block
element) that carry what the markup says of them. Its lines are aligned with
those of the nearer neighbour by longest common subsequence, and shared lines
are the site's: they are deleted. Markup overrules the comparison both ways:
what lies in navigation, headers, footers, asides, forms, adverts, notices,
comments or scripts goes even if it differs from page to page, and prose
(paragraphs, headings, quotes) inside a marked article stays even if another
page has the same sentence. Two copies of one page would delete each other, so
a neighbour that shares most of the prose is no template witness: the other
neighbour is taken, and if that is a copy too, nothing is deleted.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, ordered_blocks, prepare, table

# Element names by their part in a page.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe object svg canvas menu dialog title".split()
)
RAW = "script|style|textarea|title|noscript|template|iframe|svg"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption".split())
CONTAINERS = frozenset(["article", "main"])
CLOSED_BY_NEXT = frozenset("li dt dd tr td th option".split())
# Words of class and id names, and roles, that mark parts outside the main text.
MARKS = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies
    disqus disclaimer footer header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination
    popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor
    sponsored subscribe toolbar widget""".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())

# What may stand beside such a word in one name of a part inside an article ("share-bar", "related_posts").
SHELL = frozenset(
    """area articles bar block box btn button buttons container content form icons inner item items links list outer panel posts row section
    slot stories thread top unit wrap wrapper""".split()
)
# Ids that mark a part inside an article; other ids there name its own sections.
INNER_IDS = frozenset("ad ads comment comments disqus newsletter related recommended replies respond share sharing sidebar social".split())
# What the prose of a page begins with, and what holds an article.
PROSE_TAG = re.compile(r"<(?:p|h[1-6]|blockquote|pre|td|dd)\b", re.I)
HOLDER_TAG = re.compile(r"""<(?:article|main)\b|\brole\s*=\s*["']?main\b""", re.I)
FORM_END = re.compile(r"</form\b", re.I)

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<svg\b(?:"[^"]*"|'[^']*'|[^'">])*(?<=/)>|<(?P<raw>{RAW})\b(?:"[^"]*"|'[^']*'|[^'">])*>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*\Z""",
    re.S | re.I,
)
ATTR = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
# A neighbour with this share of a page's prose is a copy of it.
COPY = 0.5


def _names_a_part(name: str, value: str, in_main: bool) -> bool:
    """Whether a class or id marks a part outside the main text: by any of its words; inside an article, where names
    also tell what the text is about ("share-price", id "search"), only by a whole name made of such words."""
    if MARKS.isdisjoint(re.split(r"[^a-z0-9]+", value)):
        return False
    if not in_main:
        return True
    marks = INNER_IDS if name == "id" else MARKS
    for token in value.split():
        words = [w for w in re.split(r"[^a-z0-9]+", token) if w]
        if not marks.isdisjoint(words) and all(w in marks or w in SHELL or w.isdigit() for w in words):
            return True
    return False


class Forms:
    """Which forms hold the article, a main element or most of the page's prose, as server-side frameworks write
    them: those are no form fields. An unclosed form reaches to the end of the page. The page is read once, at its first form."""

    def __init__(self, html: str):
        self.html = html
        self.at: list[list[int]] | None = None

    def wraps(self, start: int) -> bool:
        if self.at is None:
            self.at = [[m.start() for m in pattern.finditer(self.html)] for pattern in (FORM_END, HOLDER_TAG, PROSE_TAG)]
        ends, holders, prose = self.at
        i = bisect_left(ends, start)
        stop = ends[i] if i < len(ends) else len(self.html)
        within = lambda places: bisect_left(places, stop) - bisect_left(places, start)
        return within(holders) > 0 or within(prose) > 1 and 2 * within(prose) > len(prose)


def _marked(tag: str, attrs: str, in_main: bool) -> bool:
    """Whether an element's markup places it outside the main text."""
    if tag in DROPPED or (tag == "header" and not in_main):
        return True
    if not attrs or tag in ("html", "body") or tag in CONTAINERS and "comment" not in attrs.lower():
        return False
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name in ("class", "id") and _names_a_part(name, value, in_main):
            return True
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def lines(html: str) -> list[tuple[str, bool, bool]]:
    """The page's text lines outside marked parts: (text, in a main container, prose).
    Tags may be unclosed or the page cut off anywhere."""
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # (tag, drops, main) of open elements that matter
    buffer: list[str] = []
    block, linked, in_link, at = "", 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(buffer)).split())
        if text:
            out.append((text, main > 0, block in PROSE and 2 * linked <= len(text)))
        buffer.clear()
        linked = 0

    drops = main = 0
    forms = Forms(html)
    for m in TOKEN.finditer(html):
        if m.start() > at and not drops:
            buffer.append(html[at : m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue  # a comment, a declaration, a raw-text element or a cut-off tag
        if tag in INLINE:
            if tag == "a":
                in_link = not m["end"]
            if m["end"] or not m["attrs"] or not _marked(tag, m["attrs"], main > 0):
                if not m["end"] or not any(t == tag for t, *_ in stack):
                    continue
        else:
            flush()
            in_link = 0
            if stack and not m["end"] and (stack[-1][0] == "p" or stack[-1][0] == tag in CLOSED_BY_NEXT):
                _, d, c = stack.pop()
                drops -= d
                main -= c
        if tag in VOID:
            continue
        if m["end"]:
            block = ""
            if any(t == tag for t, *_ in stack):
                while stack:
                    t, d, c = stack.pop()
                    drops -= d
                    main -= c
                    if t == tag:
                        break
            continue
        if m["attrs"].endswith("/") and tag not in PROSE:
            continue
        if tag not in INLINE:
            block = tag
        d = _marked(tag, m["attrs"], main > 0) and not (tag == "form" and not main and not drops and forms.wraps(m.end()))
        c = not d and (tag in CONTAINERS or 'role="main"' in m["attrs"])
        if d or c or any(t == tag for t, *_ in stack):  # an open namesake must not close the marked one
            stack.append((tag, d, c))
            drops += d
            main += c
    if not drops:
        buffer.append(html[at:])
    flush()
    return out


def shared(a: list[str], b: list[str]) -> list[bool]:
    """Which of ``a``'s lines are in a longest common subsequence with ``b``:
    one bit of an integer for each line of ``b``, one addition for each of ``a``."""
    where: dict[str, int] = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, [full]
    for line in a:
        hit = v & where.get(line, 0)
        v = ((v + hit) | (v - hit)) & full
        rows.append(v)
    found, j = [False] * len(a), len(b)
    length = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    for i in range(len(a), 0, -1):
        if not j:
            break
        if length(i, j) > length(i - 1, j):
            while rows[i] >> (j - 1) & 1:
                j -= 1
            found[i - 1] = True
            j -= 1
    return found


def common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def main_text(page: list[tuple[str, bool, bool]], neighbours: list[list[tuple[str, bool, bool]]]) -> str:
    """The main text of a page, given its neighbours' lines, the nearest first."""
    own = [text for text, *_ in page]
    contained = any(main for _, main, _ in page)
    kept = [main or not contained for _, main, _ in page]
    safe = [main and prose for _, main, prose in page]
    weight = sum(len(t) for t, k in zip(own, kept) if k)
    for other in neighbours:
        same = shared(own, [text for text, *_ in other])
        if sum(len(t) for t, k, s in zip(own, kept, same) if k and s) > COPY * weight:
            continue  # a copy of this page
        kept = [k and (f or not s) for k, f, s in zip(kept, safe, same)]
        break
    return " ".join(t for t, k in zip(own, kept) if k)


FIELDS = "page_id long, url string, text string, n_chars long"


def _extract(batches):
    """Stream a sorted block: a page is done when its successor is read; holds three pages."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    before = now = None  # rows: (block, role, host, path, page_id, url, lines)

    def finish(after):
        near = []
        for x in (before, after):
            if x and x[0] == now[0] and x[2] == now[2]:
                near.append((-common_prefix(x[3], now[3]), len(near), x[6]))
        text = main_text(now[6], [x[2] for x in sorted(near, key=lambda x: x[:2])])
        return now[4], now[5], text, len(text)

    for b in batches:
        out = []
        get = lambda name: b.column(b.schema.get_field_index(name)).to_pylist()  # noqa: E731, B023
        for row in zip(*[get(n) for n in ("_block", "_role", "host", "path", "page_id", "url", "html")]):
            after = (*row[:6], lines(row[6] or ""))
            if now and now[1] == 0:
                out.append(finish(after))
            before, now = now, after
        yield _batch(out, names)
    if now and now[1] == 0:
        yield _batch([finish(None)], names)


def _batch(out, names):
    columns = zip(*out) if out else [[]] * len(names)
    types = [pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; empty text where there is none.

    Null html counts as empty, a null URL as a host of its own; repeated rows
    come out repeated (copies don't delete each other's text). Other columns are
    not read. Empty table: no rows.
    """
    prepare(pages.sparkSession)
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*://"
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select(
        F.lower(F.regexp_extract(url, scheme + "([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, f"(?:{scheme}[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
    )
    return ordered_blocks(rows, ["host", "path", "page_id"], blocks_for(rows)).mapInArrow(_extract, FIELDS)


def op4_html(spark, sf_dir) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
