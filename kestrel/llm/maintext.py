"""Main text of web pages from flat text blocks and a decision tree.

A page is cut at block-level tags into a flat list of text blocks.  Each block
has its word count and link density, those of the blocks before and after it,
and where it stands (inside an article, inside a container that its tag, class
or role marks as not part of one, heading).  A decision tree, trained by Gini
gain on the small labelled table below, tells main text from the rest.

Nulls and edge cases: null and empty pages, and pages without main text, give
the empty text.  Unclosed tags, comments, scripts and truncated pages are read
to the end; a tag that never closes is markup.  Pages of any length are read
whole.  Repeated rows are treated alike; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ship, tidy

#: Tags that end a text block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split())
#: Containers that are tracked, and those that are never main text.
CONTAINERS = frozenset(
    "article aside blockquote body button details dialog div dl fieldset figure footer form header iframe label main "
    "menu nav ol section select span table td ul".split())
OUTSIDE_TAGS = frozenset("aside button dialog footer form iframe label menu nav select".split())
OUTSIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words of class and id attributes that mark such containers.
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification pagination "
    "paywall popup promo promoted promotion recommended related reply replies share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription tags toolbar widget".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|title|object)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<([/!?]?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[/!?][^>]*(?:>|\Z)|([^<]+|<)", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def _is_outside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in OUTSIDE_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    for name, *values in _NAMES.findall(attributes):
        value = "".join(values)
        if name.lower() == "role":
            if value.strip().lower() in OUTSIDE_ROLES:
                return True
        elif any(w.lower() in OUTSIDE_WORDS for w in _WORD.findall(value)):
            return tag != "body"
        elif not in_article and any(w.lower() == "header" for w in _WORD.findall(value)):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int, int, int, int, int]]:
    """(text, words, link words, in article, outside, heading) of each text block."""
    out: list = []
    stack: list[tuple[str, bool, bool]] = []  # tag, outside here or above, in article
    parts: list[str] = []
    links = [0]
    link_text: list[str] = []
    in_link = False
    heading = 0

    def flush() -> None:
        nonlocal in_link
        text = " ".join(html.unescape("".join(parts)).split())
        if in_link:
            links[0] += len("".join(link_text).split())
            link_text.clear()
        if text:
            outside, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            n = len(text.split())
            out.append((text, n, min(links[0], n), int(article), int(outside), heading))
        parts.clear()
        links[0] = 0

    for m in _TOKEN.finditer(page):
        if m.group(5) is not None:
            parts.append(m.group(5))
            if in_link:
                link_text.append(m.group(5))
            continue
        tag = m.group(3)
        if tag is None:
            continue  # comments, scripts and the like
        tag, closing, attributes = tag.lower(), m.group(2) == "/", m.group(4) or ""
        if m.group(2) in ("!", "?"):
            continue
        if tag in BLOCK_TAGS:
            flush()
            if tag[0] == "h" and len(tag) == 2 and tag[1].isdigit():
                heading = 0 if closing else 1
        if tag == "a":
            if in_link:
                links[0] += len("".join(link_text).split())
                link_text.clear()
            in_link = not closing
        elif tag in CONTAINERS:
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        if tag == "span" and stack[k][1]:
                            flush()
                        del stack[k:]
                        break
            elif not attributes.rstrip().endswith("/"):
                above, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                opens = tag in ("article", "main")
                outside = _is_outside(tag, attributes, article or opens)
                if tag == "span" and outside and not above:
                    flush()
                if opens and not article and not outside:
                    # a container left open before the article does not swallow it
                    above = any(t in ("aside", "dialog", "form", "nav") for t, o, _ in stack if o)
                stack.append((tag, above or outside, article or (opens and not outside)))
    flush()
    return out


FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after",
            "place", "outside", "heading")


def rows_of(found: list[tuple[str, int, int, int, int, int]]) -> list[tuple[float, ...]]:
    """Features of each block of a page.

    place: 2 inside the article, 1 on a page that marks none, 0 elsewhere on a page that does.
    """
    has = any(b[3] and not b[4] for b in found)
    own = [(float(n), k / n) for _, n, k, _, _, _ in found]
    none = (0.0, 0.0)
    return [(*own[i], *(own[i - 1] if i else none), *(own[i + 1] if i + 1 < len(own) else none),
             2.0 if b[3] else 0.0 if has else 1.0, float(b[4]), float(b[5])) for i, b in enumerate(found)]


#: Labelled table: FEATURES in their order, then 1 for main text.
LABELLED = (
    # pages with an article element
    (60, 0.00, 12, 0.00, 40, 0.00, 2, 0, 0, 1), (40, 0.05, 60, 0.00, 30, 0.00, 2, 0, 0, 1),
    (3, 0.00, 50, 0.00, 0, 0.00, 2, 0, 0, 1), (1, 0.00, 0, 0.00, 20, 0.00, 2, 0, 0, 1),
    (10, 0.00, 9, 0.00, 80, 0.00, 2, 0, 1, 1), (5, 0.00, 30, 0.00, 45, 0.00, 2, 0, 1, 1),
    (8, 0.50, 25, 0.00, 30, 0.00, 2, 0, 0, 1), (2, 1.00, 40, 0.00, 35, 0.00, 2, 0, 0, 1),
    (120, 0.02, 5, 0.00, 9, 0.00, 2, 0, 0, 1), (15, 0.00, 18, 0.00, 5, 0.10, 2, 0, 0, 1),
    (9, 0.00, 6, 1.00, 10, 0.00, 0, 1, 0, 0), (14, 0.00, 1, 1.00, 11, 0.00, 0, 1, 0, 0),
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 1, 0, 0), (2, 1.00, 0, 0.00, 1, 1.00, 0, 1, 0, 0),
    (12, 0.00, 60, 0.00, 0, 0.00, 0, 1, 0, 0), (45, 0.00, 30, 0.00, 12, 0.10, 0, 1, 0, 0),
    (30, 0.00, 80, 0.00, 20, 0.00, 2, 1, 0, 0), (6, 0.30, 70, 0.00, 25, 0.00, 2, 1, 0, 0),
    (4, 0.00, 25, 0.00, 30, 0.00, 2, 1, 1, 0), (25, 0.00, 4, 0.00, 12, 0.00, 2, 1, 0, 0),
    (7, 0.00, 12, 0.00, 0, 0.00, 0, 0, 0, 0), (35, 0.10, 60, 0.00, 8, 0.50, 0, 0, 0, 0),
    (3, 1.00, 2, 1.00, 40, 0.00, 0, 0, 0, 0), (6, 0.00, 3, 1.00, 10, 0.00, 0, 0, 1, 0),
    (1, 1.00, 0, 0.00, 60, 0.00, 2, 0, 0, 1), (3, 1.00, 2, 1.00, 2, 1.00, 2, 0, 0, 1),
    (2, 1.00, 3, 1.00, 8, 0.00, 2, 0, 0, 1), (6, 0.70, 12, 0.00, 0, 0.00, 2, 0, 0, 1),
    (12, 0.00, 0, 0.00, 0, 0.00, 2, 0, 0, 1), (2, 0.00, 0, 0.00, 9, 0.00, 2, 0, 0, 1),
    (4, 0.00, 4, 0.00, 5, 0.10, 2, 0, 0, 1), (9, 0.00, 6, 0.00, 7, 0.00, 2, 0, 1, 1),
    (16, 0.00, 30, 0.00, 0, 0.00, 0, 0, 0, 0), (50, 0.00, 12, 0.00, 40, 0.00, 0, 0, 0, 0),
    (20, 0.00, 6, 1.00, 70, 0.00, 0, 0, 0, 0), (11, 0.05, 30, 0.00, 0, 0.00, 0, 0, 1, 0),
    (80, 0.00, 2, 1.00, 12, 0.00, 0, 0, 0, 0), (13, 0.00, 0, 0.00, 10, 0.00, 0, 0, 0, 0),
    (1, 0.00, 1, 0.00, 1, 0.00, 2, 0, 0, 1), (2, 0.00, 1, 0.00, 0, 0.00, 2, 0, 0, 1),
    (1, 0.00, 2, 0.00, 2, 0.00, 2, 0, 0, 1), (35, 0.00, 50, 0.00, 1, 1.00, 2, 0, 0, 1),
    (1, 1.00, 1, 0.00, 1, 1.00, 2, 0, 0, 1), (20, 0.30, 14, 0.00, 2, 1.00, 2, 0, 0, 1),
    (1, 0.00, 1, 1.00, 0, 0.00, 2, 0, 0, 1), (3, 0.00, 2, 1.00, 12, 0.00, 2, 0, 0, 1),
    (5, 0.00, 6, 0.80, 2, 0.00, 2, 0, 0, 1), (2, 0.00, 4, 1.00, 1, 1.00, 2, 0, 0, 1),
    (44, 0.00, 60, 0.00, 33, 0.00, 0, 0, 0, 0), (28, 0.00, 9, 0.00, 64, 0.00, 0, 0, 0, 0),
    (19, 0.00, 25, 0.00, 18, 0.00, 0, 0, 0, 0), (65, 0.00, 31, 0.00, 90, 0.00, 0, 0, 0, 0),
    # pages without one
    (55, 0.00, 8, 0.00, 60, 0.00, 1, 0, 0, 1), (80, 0.05, 55, 0.00, 40, 0.00, 1, 0, 0, 1),
    (25, 0.00, 60, 0.00, 3, 1.00, 1, 0, 0, 1), (18, 0.10, 40, 0.00, 35, 0.05, 1, 0, 0, 1),
    (8, 0.00, 30, 0.00, 42, 0.00, 1, 0, 0, 1), (5, 0.00, 45, 0.00, 28, 0.00, 1, 0, 1, 1),
    (9, 0.00, 2, 1.00, 60, 0.00, 1, 0, 1, 1), (7, 0.00, 1, 1.00, 35, 0.00, 1, 0, 1, 1),
    (12, 0.00, 22, 0.00, 4, 0.00, 1, 0, 0, 1), (30, 0.20, 9, 0.00, 33, 0.00, 1, 0, 0, 1),
    (14, 0.00, 3, 1.00, 0, 0.00, 1, 0, 0, 1), (11, 0.00, 0, 0.00, 0, 0.00, 1, 0, 0, 1),
    (24, 0.00, 0, 0.00, 1, 1.00, 1, 0, 0, 1), (33, 0.00, 2, 1.00, 1, 1.00, 1, 0, 0, 1),
    (13, 0.00, 0, 0.00, 1, 1.00, 1, 0, 0, 1), (28, 0.00, 35, 0.00, 0, 0.00, 1, 0, 0, 1),
    (1, 1.00, 1, 1.00, 1, 1.00, 1, 0, 0, 0), (2, 1.00, 0, 0.00, 3, 1.00, 1, 0, 0, 0),
    (4, 1.00, 60, 0.00, 3, 1.00, 1, 0, 0, 0), (6, 0.67, 40, 0.00, 0, 0.00, 1, 0, 0, 0),
    (3, 0.00, 1, 1.00, 2, 1.00, 1, 0, 0, 0), (2, 0.00, 5, 0.60, 0, 0.00, 1, 0, 0, 0),
    (12, 0.75, 20, 0.50, 8, 0.80, 1, 0, 0, 0), (40, 0.80, 3, 1.00, 2, 1.00, 1, 0, 0, 0),
    (20, 0.00, 30, 0.00, 25, 0.00, 1, 1, 0, 0), (60, 0.00, 10, 0.00, 55, 0.00, 1, 1, 0, 0),
    (5, 0.00, 60, 0.00, 0, 0.00, 1, 1, 0, 0), (3, 0.00, 2, 0.00, 45, 0.00, 1, 1, 1, 0),
    (9, 0.00, 12, 0.00, 50, 0.00, 1, 1, 0, 0), (15, 0.20, 0, 0.00, 30, 0.00, 1, 1, 0, 0),
)


def _gini(labels: list[int]) -> float:
    p = sum(labels) / len(labels)
    return 2 * p * (1 - p) * len(labels)


def train(rows: tuple = LABELLED, depth: int = 8, least: int = 2):
    """A leaf (0 or 1) or (feature, bound, tree below or at the bound, tree above)."""
    labels = [int(r[-1]) for r in rows]
    leaf = int(2 * sum(labels) >= len(labels))
    if depth == 0 or len(set(labels)) == 1 or len(rows) < 2 * least:
        return leaf
    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            bound = (low + high) / 2
            a, b = [r for r in rows if r[f] <= bound], [r for r in rows if r[f] > bound]
            if min(len(a), len(b)) < least:
                continue
            cost = _gini([int(r[-1]) for r in a]) + _gini([int(r[-1]) for r in b])
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, bound, a, b)
    if best is None or best[0] >= _gini(labels) - 1e-12:
        return leaf
    _, f, bound, a, b = best
    return f, bound, train(tuple(a), depth - 1, least), train(tuple(b), depth - 1, least)


def decide(tree, row: tuple[float, ...]) -> int:
    while not isinstance(tree, int):
        f, bound, low, high = tree
        tree = low if row[f] <= bound else high
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    return " ".join(b[0] for b, r in zip(found, rows_of(found)) if decide(tree, r))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row of ``pages``."""
    ship(pages.sparkSession)
    tree = train()
    kind = pages.schema[id_col].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(p, tree) for p in b.column("h").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), b.column("u"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    return pages.select(F.col(id_col).alias("i"), F.col(url_col).alias("u"), F.col(html_col).alias("h")).mapInArrow(
        run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")
