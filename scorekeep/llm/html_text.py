"""Main text of HTML pages by line-block distribution.

Markup is stripped first: every block element makes a line, elements that never hold the article (menus,
footers, forms, scripts, ...) become gaps of empty lines, and so do the edges of containers.  Then the text
lengths of WINDOW consecutive lines are summed from every line on.  The sum rises from 0 at a surge and falls
to 0 again at a dive; the lines between them are a stretch of text.  Where the page marks an article or its
main part, every line inside it is kept; besides, on every page, each stretch that holds a share SHARE of the densest
one's window sum, and the shorter ones of the same container, unless mostly links.  An element whose class, id
or role says that it is no part of the article is kept if it holds one, or the densest stretch of a page without.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import over_slices

WINDOW = 3
SHARE = 0.2
LINKS = 0.5

# Element names of HTML, by what they mean here.
RAW = frozenset("script style textarea title template noscript iframe noembed noframes xmp".split())
SKIPPED = frozenset("""head nav header footer aside form menu dialog button select option svg math canvas audio video object""".split())
CONTAINERS = frozenset("html body div section main article center table".split())
BLOCKS = CONTAINERS | SKIPPED | frozenset("""p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote hr tr td th thead tbody tfoot
 caption figure figcaption fieldset legend address details summary hgroup search""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset("article main".split())
#: Words in a class, id or role that mark what does not belong to the article.
CHROME_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie
 cookies consent gdpr notice notices alert newsletter subscribe popup modal overlay nav navbar navigation menu menubar breadcrumb
 breadcrumbs sidebar side aside widget header masthead footer comment comments reply replies disqus discussion respond related
 recommended share sharing social toolbar pagination pager login signup search contentinfo complementary""".split())

#: Tags; a quote counts only where a value begins, after an equals sign.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<raw>""" + "|".join(sorted(RAW)) + r""")\b(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*+>.*?
 (?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*+)>|<[!?/][^>]*>""".replace("\n ", ""),
                  re.S | re.I)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[-_]+")
#: Words that may stand before a chrome word in a class, id or role: site-header, but not has-sidebar.
PLACE_WORDS = frozenset("site page main top bottom left right primary secondary global".split())
#: Skipped elements that may also wrap a whole page.
WRAPPERS = frozenset(["form"])


def _is_chrome(name: str, rest: str, article: int) -> bool:
    if name in SKIPPED and not (article and name == "header"):  # an article's own header holds its title
        return True
    if name in ("body", "html", "article", "main") or "=" not in rest:
        return False
    return any(_is_chrome_token(t) for m in _MARKS.findall(rest) for t in " ".join(m).lower().split())


def _is_chrome_token(token: str) -> bool:
    parts = [p for p in _PART.split(token) if p]
    while len(parts) > 1 and parts[0] in PLACE_WORDS:
        parts = parts[1:]
    return bool(parts) and all(p in CHROME_WORDS for p in parts)


class _Lines:
    """Lines of a page: raw text, length of it in links, and its innermost article, container and chrome (0: none).

    Containers and chrome elements are numbered as they open; each list has the number of the one around it."""

    def __init__(self):
        self.text: list[str] = []
        self.links: list[int] = []
        self.place: list[tuple[int, int, int]] = []
        self.boxes, self.chrome, self.soft = [0], [0], [False]
        self.articles = [0]  # the chrome around each article
        self.parts: list[str] = []
        self.linked = 0

    def close(self, place: tuple[int, int, int], gap: bool = False) -> None:
        if self.parts:
            self.text.append("".join(self.parts))
            self.links.append(self.linked)
            self.place.append(place)
            self.parts, self.linked = [], 0
        if gap:
            self.text += [""] * WINDOW
            self.links += [0] * WINDOW
            self.place += [(0, 0, 0)] * WINDOW

    def around(self, chrome: int) -> Iterator[int]:
        """The chrome element and all around it."""
        while chrome:
            yield chrome
            chrome = self.chrome[chrome]


def _lines(page: str) -> _Lines:
    out, stack, links, at = _Lines(), [], 0, 0
    here = (0, 0, 0)  # article, container, chrome
    open_names: dict[str, int] = {}
    open_inline: dict[str, int] = {}

    def add(piece: str) -> None:
        if piece:
            out.parts.append(piece)
            out.linked += len(piece) if links else 0

    for m in _TAG.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            add(" ")
        if name == "a":
            links = 0 if m["end"] else 1
        if name not in BLOCKS:
            if not (not m["end"] and name not in VOID and not m["rest"].endswith("/") and _is_chrome(name, m["rest"], here[0])) and not (
                    m["end"] and open_inline.get(name)):
                continue
        out.close(here, gap=name in CONTAINERS or name in SKIPPED)
        if name in VOID:
            continue
        if not m["end"]:
            if name == "p":  # a paragraph ends where a block begins; it never holds one
                continue
            chrome = _is_chrome(name, m["rest"], here[0])
            stack.append((name, chrome, here))
            open_names[name] = open_names.get(name, 0) + 1
            open_inline[name] = open_inline.get(name, 0) + chrome
            article, box, skipped = here
            if chrome:
                out.chrome.append(skipped)
                out.soft.append(name not in SKIPPED or name in WRAPPERS)
                skipped = len(out.chrome) - 1
            if name in ARTICLE:
                out.articles.append(skipped)
                article = len(out.articles) - 1
            if name in CONTAINERS or name in SKIPPED:
                out.boxes.append(box)
                box = len(out.boxes) - 1
            here = article, box, skipped
        elif open_names.get(name):
            while stack:
                top, chrome, here = stack.pop()
                open_names[top] -= 1
                open_inline[top] -= chrome
                if top == name:
                    break
    add(page[at:])
    out.close(here)
    return out


def _stretches(length: np.ndarray) -> list[tuple[int, int, int]]:
    """First line, end and largest window sum of each stretch."""
    total = np.concatenate(([0], np.cumsum(length)))
    n = len(length)
    window = total[np.minimum(np.arange(n) + WINDOW, n)] - total[:-1]
    up = window > 0
    surges = np.flatnonzero(up & ~np.concatenate(([False], up[:-1])))
    dives = np.flatnonzero(up & ~np.concatenate((up[1:], [False]))) + 1
    return [(int(a), int(min(b + WINDOW - 1, n)), int(window[a:b].max())) for a, b in zip(surges, dives, strict=True)]


def _shown(found: _Lines, length: list[int]) -> list[int]:
    """Lines (and gaps) that no chrome element takes out; one that holds an article or the densest stretch doesn't."""
    text = [i for i, n in enumerate(length) if n]
    inner = [i for i in text if found.place[i][0] and found.place[i][2] == found.articles[found.place[i][0]]]
    holds = {c for i in inner for c in found.around(found.place[i][2])}
    free = {c for c in holds if found.soft[c]}
    hidden = lambda i: any(c not in free for c in found.around(found.place[i][2]))
    if inner and all(hidden(i) for i in inner):
        free |= holds
    if not inner:
        open_lines = [i for i in range(len(length)) if all(found.soft[c] for c in found.around(found.place[i][2]))]
        best, at = 0, []
        for a, b, dense in _stretches(np.array([length[i] for i in open_lines], np.int64)):
            lines = [i for i in open_lines[a:b] if length[i]]
            if dense > best and sum(found.links[i] for i in lines) < LINKS * sum(length[i] for i in lines):
                best, at = dense, lines
        free |= {c for i in at for c in found.around(found.place[i][2])}
    return [i for i in range(len(length)) if not hidden(i)]


def _groups(boxes: list[int], of: list[int]) -> list[int]:
    """For the container of each line with text, the innermost one around it (or itself) that holds two lines or
    containers with text, or 0."""
    held = [0] * len(boxes)
    for box in of:
        held[box] += 1
    for box in range(len(boxes) - 1, 0, -1):
        held[boxes[box]] += held[box] > 0
    group = list(range(len(boxes)))
    for box in range(1, len(boxes)):
        if held[box] < 2:
            group[box] = group[boxes[box]]
    return [group[box] for box in of]


def main_text(page: str | None) -> str:
    """The article's blocks, joined by a line feed; empty if the page is null or has no text."""
    if not page:
        return ""
    found = _lines(page)
    texts = [" ".join(html.unescape(t).split()) for t in found.text]
    shown = _shown(found, [len(t) for t in texts])
    texts, links, place = ([x[i] for i in shown] for x in (texts, found.links, found.place))
    length = np.array([len(t) for t in texts], np.int64)
    if not length.any():
        return ""
    text = np.flatnonzero(length).tolist()
    group = dict(zip(text, _groups(found.boxes, [place[i][1] for i in text]), strict=True))
    stretches = _stretches(length)
    dense = max(d for _, _, d in stretches)
    kept, dense_groups, others = {i for i in text if place[i][0]}, set(), []
    for a, b, d in stretches:
        lines = [i for i in range(a, b) if texts[i]]
        if sum(links[i] for i in lines) < LINKS * sum(length[i] for i in lines):
            if d >= SHARE * dense:
                kept.update(lines)
                dense_groups.update(group[i] for i in lines if not place[i][0])
            else:
                others += lines
    # a short stretch goes with the dense ones of its container
    kept.update(i for i in others if group[i] in dense_groups)
    return "\n".join(texts[i] for i in sorted(kept))


def _extracting(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = [main_text(t) for t in part.column("html").to_pylist()]
    yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                      pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points of text) of every row; null or empty html gives an empty text.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one
    line feed in page order.  Null ids and urls and repeated rows come back as they are.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(over_slices(_extracting, "html"), "page_id long, url string, text string, n_chars long")


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
