"""Main text of web pages: flat text blocks, each described by its own and its
neighbours' word count and link density and by one number that says where the
markup puts it, and kept or dropped by a decision tree.

The tree is trained on a small labelled table and on the blocks of at most
``PAGES`` pages that hold an article element, labelled by whether they stand in
it.  Each of those pages is shown twice, once with the place of its blocks and
once as a page without such an element, so that the tree also learns what word
counts and link densities say alone.

Edge cases: null or empty html gives an empty text; markup that is not closed
or cut off is read as far as it goes; repeated rows each give a row; an empty
table gives an empty result; other columns are ignored, and one that is named
like the result is replaced by it.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)

#: Elements whose text is never shown, or is not prose.
SILENT = {"script", "style", "noscript", "template", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "head"}
RAW = {"script", "style", "title", "noscript", "iframe", "template", "svg", "textarea", "xmp"}
#: Elements that do not end a text block.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and landmark roles that hold no part of an article wherever they stand.
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "select", "button", "textarea", "input", "fieldset"} | SILENT
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
PROSE = {"article", "main"}
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
GONE = re.compile(r"display\s*:\s*none", re.I)
#: Where a block stands: in a box of the kinds above, or outside the page's article; on a page without one; in it.
OUTSIDE, UNKNOWN, INSIDE = 0, 1, 2


def boxed(name: str, attrs: str) -> bool:
    """Whether an element with these attributes is hidden or no prose."""
    if name in CHROME:
        return True
    if not attrs:
        return False
    of = {k.lower(): (a or b or c).strip().lower() for k, a, b, c in ATTRIBUTE.findall(attrs)}
    return of.get("hidden", "until-found") != "until-found" or of.get("aria-hidden") == "true" or of.get("role") in ROLES or bool(GONE.search(of.get("style", "")))


def blocks_of(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, place) of each block, in page order."""
    out: list[tuple[str, int, int, bool, bool]] = []
    buffer: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, chrome, prose
    links = 0
    chrome = prose = False

    def flush():
        nonlocal buffer
        if buffer:
            text = " ".join("".join(t for t, _ in buffer).split())
            if text:
                linked = sum(len(t.split()) for t, a in buffer if a)
                out.append((text, len(text.split()), linked, chrome, prose))
            buffer = []

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            buffer.append((entities.unescape(page[at:end]), links > 0))
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attrs = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name == "a":
            links = 0 if closing else 1
        if name == "br":
            buffer.append((" ", False))
        if name in INLINE:
            continue
        flush()
        links = 0
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    chrome, prose = stack[-1][1:] if stack else (False, False)
                    break
            continue
        if name in RAW:
            close = re.compile(f"</{name}", re.I).search(page, at)
            at = close.start() if close else n
        elif name == "body":
            stack, chrome, prose = [], False, False
        elif name not in VOID and name not in ("p", "li", "html", "option", "dt", "dd", "tr", "td", "th"):
            box = boxed(name, attrs) or name == "header" and not prose
            prose = prose or name in PROSE
            chrome = chrome or box
            stack.append((name, chrome, prose))
    flush()
    known = any(prose and not chrome for *_, chrome, prose in out)
    return [(t, w, a, OUTSIDE if chrome or known and not prose else INSIDE if prose else UNKNOWN) for t, w, a, chrome, prose in out]


#: Pages, of those with an article, whose blocks the tree learns from.
PAGES = 50
#: Labelled table to train on: place, words, link density, words and link
#: density of the block before and of the block after, main text.
FEATURES = ("place", "words", "links", "words_before", "links_before", "words_after", "links_after")
LABELLED = """
2 8 0 9 0 60 0 1            2 60 0 8 0 45 0 1           2 45 0 60 0 3 0 1           2 3 0 45 0 80 0 1           2 1 0 80 0 1 0 1
2 1 0 1 0 30 0 1            2 120 .05 30 0 12 0 1        2 12 .1 120 0 14 0 1        2 5 0 0 0 0 0 1             2 4 0 9 0 14 0 1
2 14 0 4 0 7 0 1            2 30 .2 5 0 5 0 1           2 2 0 90 .1 9 0 1           2 7 0 1 1 25 0 1            2 25 0 7 0 13 1 1
2 200 0 2 0 2 0 1           2 6 1 40 0 5 1 0            2 5 1 6 1 4 1 0             2 4 1 5 1 14 0 0            2 3 1 70 0 30 0 0
0 1 1 0 0 1 1 0             0 1 1 1 1 2 1 0             0 9 0 1 1 6 0 0             0 14 0 60 0 0 0 0           0 40 0 12 0 20 0 0
0 25 0 40 0 8 0 0           0 80 .1 30 0 30 0 0         0 3 0 5 0 0 0 0             0 30 0 60 0 50 0 0          0 4 0 90 0 7 0 0
0 12 .9 40 0 40 0 0         0 70 0 20 0 22 0 0          0 5 0 5 0 5 0 0             0 6 .5 2 1 9 0 0            0 1 1 30 0 1 1 0
0 120 0 0 0 40 0 0          1 60 0 8 0 45 0 1           1 45 .1 60 0 30 0 1         1 30 0 45 0 20 0 1          1 90 0 0 0 0 0 1
1 20 .1 70 0 40 0 1         1 25 .2 4 1 4 1 1           1 40 0 3 0 5 0 1            1 18 0 22 0 16 0 1          1 7 0 2 1 50 0 1
1 9 0 30 0 40 0 1           1 4 0 50 0 45 0 1           1 6 0 60 0 35 .1 1          1 2 1 0 0 2 1 0             1 1 1 2 1 1 1 0
1 5 .8 3 1 4 1 0            1 30 .9 20 1 20 1 0         1 3 0 2 1 2 1 0             1 4 0 3 0 2 0 0             1 2 0 0 0 3 1 0
1 6 0 5 0 0 0 0             1 40 0 40 0 0 0 1           1 35 0 50 0 4 1 1           1 70 0 6 0 3 0 1            1 28 0 0 0 0 0 1
1 15 0 40 0 3 .5 1          1 50 .1 2 .5 2 .5 1         1 16 0 4 .9 30 0 1          1 22 .3 30 0 3 0 1          1 3 0 2 1 40 0 1
1 5 0 2 1 60 0 1            1 4 0 4 .9 35 0 1           1 2 0 0 0 50 0 1            1 3 0 60 0 2 1 0            1 4 0 50 0 5 .5 0
1 2 0 40 0 0 0 0            1 5 0 30 0 3 1 0            1 12 .6 40 0 30 0 0         1 8 .7 60 0 10 0 0          1 5 0 4 1 6 .5 0
1 3 1 60 0 60 0 0           2 1 0 1 0 1 0 1             2 1 0 12 0 9 0 1            2 1 0 2 0 1 0 1             2 2 0 1 0 30 0 1
"""


def labelled() -> tuple[np.ndarray, np.ndarray]:
    rows = np.array(LABELLED.split(), float).reshape(-1, len(FEATURES) + 1)
    return rows[:, :-1], rows[:, -1].astype(int)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """A binary decision tree by Gini impurity: (feature, threshold, below,
    above), or the class at a leaf."""
    if depth == 0 or len(set(y)) == 1:
        return int(2 * y.sum() >= len(y))
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, hits = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1])  # last row below each threshold
        if not len(cut):
            continue
        n, k = cut + 1.0, hits[cut]
        m, j = len(y) - n, hits[-1] - k
        cost = 2 * k * (1 - k / n) + 2 * j * (1 - j / m)
        i = int(cost.argmin())
        if best is None or cost[i] < best[0] - 1e-12:
            best = cost[i], f, (v[cut[i]] + v[cut[i] + 1]) / 2
    if best is None:
        return int(2 * y.sum() >= len(y))
    _, f, t = best
    low = x[:, f] <= t
    return f, float(t), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def planted(x: np.ndarray, y: np.ndarray):
    """A tree that parts the blocks by place first and then grows."""
    below = [grow(x[x[:, 0] == p], y[x[:, 0] == p]) if (x[:, 0] == p).any() else 0 for p in (OUTSIDE, UNKNOWN, INSIDE)]
    return 0, 0.5, below[0], (0, 1.5, below[1], below[2])


@lru_cache(maxsize=1)
def tree():
    """The tree that the small table alone gives."""
    return planted(*labelled())


def rows_of(blocks: list[tuple[str, int, int, int]]) -> list[tuple]:
    """The features of each block of a page."""
    shape = [(0, 0.0), *((w, a / w) for _, w, a, _ in blocks), (0, 0.0)]
    return [(b[3], *shape[i + 1], *shape[i], *shape[i + 2]) for i, b in enumerate(blocks)]


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", most: int = PAGES):
    """A tree from the small table and the blocks of at most ``most`` pages
    with an article: those with the smallest hash of key and page.  Only the
    blocks' numbers leave the executors."""
    some = (pages.where(F.contains(F.lower(html), F.lit("<article"))).select(F.xxhash64(key, html).alias("_h"), F.col(html).alias("_html"))
            .orderBy("_h", "_html").limit(most))

    def run(batches):
        for b in batches:
            found = []
            for page in b.column(0):
                rows = rows_of(blocks_of(page.as_py()))
                found.append([x for r in rows if any(q[0] == INSIDE for q in rows) for x in (*r, r[0] == INSIDE)])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64()))], ["rows"])

    seen = some.select("_html").mapInArrow(run, "rows array<double>").collect()  # ``most`` pages
    x, y = labelled()
    more = np.array([v for r in seen for v in r.rows]).reshape(-1, len(FEATURES) + 1)
    more = more[np.lexsort(more.T)]
    unplaced = more.copy()
    unplaced[:, 0] = UNKNOWN
    return planted(np.concatenate([x, more[:, :-1], unplaced[:, :-1]]), np.concatenate([y, more[:, -1], unplaced[:, -1]]).astype(int))


def decide(node, row) -> int:
    while not isinstance(node, int):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


def main_text(page: str | None, model=None, placed: bool = True) -> str:
    """The kept blocks of a page, joined by an empty line.  ``placed`` False:
    judged without the place of the blocks."""
    model = model or tree()
    blocks = blocks_of(page or "")
    rows = rows_of(blocks if placed else [(t, w, a, UNKNOWN) for t, w, a, _ in blocks])
    return "\n\n".join(b[0] for b, r in zip(blocks, rows) if decide(model, r))


def extract(pages: DataFrame, model=None, html: str = "html", out: str = "text", placed: bool = True) -> DataFrame:
    """The other columns of ``pages`` with the main text of each page."""
    keep = [c for c in pages.columns if c not in (html, out)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(keep).schema)
    model = model or tree()

    def run(batches):
        for b in batches:
            texts = pa.array([main_text(x.as_py(), model, placed) for x in b.column(len(keep))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], texts], [*keep, out])

    return pages.select(*keep, html).mapInArrow(run, f"{schema}, `{out}` string")


def op9_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract(pages, fit(pages)).withColumn("n_chars", F.length("text").cast("long"))
