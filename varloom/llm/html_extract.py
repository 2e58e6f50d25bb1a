"""Main text of web pages by composite text density.

The nodes are a page's block elements and links; text-level elements (b, span, br) belong to the
block they stand in. For every node the link-adjusted characters per tag are computed; a node's
density sum adds those of its children. The node with the greatest density sum sets a threshold,
the least density on the path from body to it; below every outermost node at or over the
threshold, the subtree with the greatest density sum is main text, whole but for elements that
are no prose. Those are taken out first: by their element, role or style (menus, page headers,
footers, sidebars, forms, scripts, styles), and by whole class names (notices, adverts, reader
comments and the like) unless they hold the page's main or article or, where it has none, the
subtree of the greatest density sum. Lists of mere links are menus where body itself is chosen.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import lean

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in "script style title textarea noscript iframe template xmp noembed noframes".split()}
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag closes if it is open, up to the nearest of the second.
CLOSES = {
    **dict.fromkeys("li".split(), ({"li"}, {"ul", "ol", "menu", "dir"})),
    **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, {"dl"})),
    **dict.fromkeys(("td", "th"), ({"td", "th"}, {"tr", "table"})),
    "tr": ({"tr", "td", "th"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})),
    "option": ({"option"}, {"select"}),
}
NO_PROSE = frozenset("nav aside footer form button select input object canvas svg math audio video dialog menu head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription sidebar rail menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments discussion disqus reply replies respond share sharing social "
    "related recommended recommendations widget login signup search pagination pager skip toc".split()
)
#: Words that leave a name of CLASSES what it is ("site-footer", "widget-area"); any other makes it another name ("no-sidebar", "related-work").
QUALIFIERS = frozenset(
    "area articles article bar block bottom box body bottombar btn button buttons card cards c col column container content desktop entry fixed global group heading icon icons id inner item items js l left "
    "link links list main media mobile outer page panel policy post posts primary right row secondary section site slot sticky stories story text title top unit wrap wrapper".split()
)
#: What holds articles of others.
OTHERS = frozenset("comment comments discussion disqus reply replies respond related recommended recommendations".split())
SPLIT = re.compile(r"[^a-z]+")
#: A list or box of at least so many links that are at least this share of its characters is a menu.
MENU_LINKS, MENU_SHARE = 3, 0.8
MENUS = ("ul", "ol", "div", "section", "table", "dl")


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if "=" in raw else {}


def noise_names(got: dict[str, str], in_article: Callable[[], bool]) -> set[str]:
    """The words of CLASSES that classes or the id consist of; an article's own header and its section Discussion are part of it."""
    found: set[str] = set()
    for where in ("class", "id"):
        for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", got.get(where, "")).lower().split():
            words = set(SPLIT.split(name)) - {""}
            named = words & CLASSES
            if named and words <= CLASSES | QUALIFIERS and not (where == "id" and words == {"discussion"} and in_article()):
                found |= named
    return set() if found == {"header"} and in_article() else found


def is_noise(tag: str, raw: str, in_article: Callable[[], bool]) -> tuple[bool, set[str]]:
    """Whether an element is no prose by its name, role or style, and the words of its classes that say so."""
    if tag in NO_PROSE or tag == "header" and not in_article():
        return True, set()
    if not raw.strip():
        return False, set()
    got = attributes(raw)
    if got.get("role", "").lower() in ROLES or got.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", ""), re.I) or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", raw):
        return True, set()
    if tag in ("body", "html", "h1"):
        return False, set()
    return False, noise_names(got, in_article)


class Page:
    """The DOM in page order: of each node its tag and parent, and the texts with their nodes."""

    def __init__(self, html: str):
        self.tag, self.parent, self.noise = ["#root"], [-1], [False]
        self.named: list[set[str]] = [set()]  # words of an element's classes that say it is no prose
        self.texts: list[tuple[int, str]] = []  # (node, text); a block's start and end are (-1, "")
        self._parse(html)
        self._settle()

    def _open(self, stack: list[int], tag: str, raw: str) -> int:
        above = stack[-1]
        in_article = lambda: any(self.tag[i] in ("article", "main") for i in stack)
        self.tag.append(tag)
        self.parent.append(above)
        noise, named = is_noise(tag, raw, in_article)
        self.noise.append(self.noise[above] or noise)
        self.named.append(named)
        return len(self.tag) - 1

    def _settle(self) -> None:
        """Noise by class, but for what holds the page's main or article or, without these, its densest subtree."""
        n, tag, parent, noise, named = len(self.tag), self.tag, self.parent, self.noise, self.named
        if not any(named):
            return
        main = [t == "main" and not x for t, x in zip(tag, noise)]
        article = [t == "article" and not x and not w for t, x, w in zip(tag, noise, named)]
        for i in range(n - 1, 0, -1):
            main[parent[i]] |= main[i]
            article[parent[i]] |= article[i]
        if not (main[0] or article[0]):
            others = noise[:]  # prose of others may be the densest
            for i in range(1, n):
                others[i] = others[i] or others[parent[i]] or bool(named[i] & OTHERS)
            best = Densities(self, others).best
            while best > 0:
                article[best] = True
                best = parent[best]
        for i in range(1, n):
            held = main[i] or not named[i] & OTHERS and article[i]
            noise[i] = noise[i] or noise[parent[i]] or bool(named[i]) and tag[i] not in ("main", "article") and not held

    def _close(self, stack: list[int], tags: set[str], stop: set[str]) -> None:
        """Close down to the outermost open one of tags that no element of stop is above."""
        for depth in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[depth]]
            if name in stop:
                break
            if name in tags:
                del stack[depth:]
                self.texts.append((-1, ""))
                self._close(stack, tags, stop)
                return

    def _parse(self, html: str) -> None:
        stack, at, n = [0], 0, len(html)
        is_open: dict[str, int] = {}
        while at < n:
            i = html.find("<", at)
            if i < 0:
                i = n
            if i > at:
                self.texts.append((stack[-1], html[at:i]))
            if i == n:
                break
            if html.startswith("<!--", i):
                end = html.find("-->", i + 4)
                at = end + 3 if end >= 0 else n
                continue
            m = TAG.match(html, i) or LOOSE_TAG.match(html, i)
            if not m:
                if i + 1 < n and (html[i + 1] in "!?/" or html[i + 1].isalpha()):
                    end = html.find(">", i)  # a declaration, or a tag that the page breaks off in
                    at = end + 1 if end >= 0 else n
                else:
                    self.texts.append((stack[-1], "<"))
                    at = i + 1
                continue
            at, tag = m.end(), m[2].lower()
            if m[1]:
                if is_open.get(tag):
                    for depth in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[depth]] == tag:
                            break
                    else:
                        depth = 0
                    if depth:
                        if any(self.tag[x] in BLOCKS for x in stack[depth:]):
                            self.texts.append((-1, ""))
                        for x in stack[depth:]:
                            is_open[self.tag[x]] -= 1
                        del stack[depth:]
                continue
            if tag in RAW:
                end = RAW[tag].search(html, at)
                at = end.end() if end else n
                continue
            if tag in BLOCKS:
                self.texts.append((-1, ""))
            closing, stop = CLOSES.get(tag, (None, None)) if tag in CLOSES else (({"p"}, {"table", "button", "article", "section", "div", "td", "th", "li", "body"}) if tag in BLOCKS else (None, None))
            if closing and any(is_open.get(t) for t in closing):
                before = stack[:]
                self._close(stack, closing, stop)
                for x in before[len(stack) :]:
                    is_open[self.tag[x]] -= 1
            if tag == "br":
                self.texts.append((stack[-1], " "))
            node = self._open(stack, tag, m[3])
            if tag not in VOID and not (m[3].endswith("/") and tag not in BLOCKS):
                stack.append(node)
                is_open[tag] = is_open.get(tag, 0) + 1

    def main_text(self) -> str:
        n, tag, parent, noise = len(self.tag), self.tag, self.parent, self.noise
        d = Densities(self, noise)
        if not d.chars[0]:
            return ""
        taken = d.chosen()
        flat = {i for i in taken if tag[i] in ("#root", "html", "body")}
        inside, menu = [False] * n, [False] * n
        for i in range(n):
            menu[i] = i > 0 and menu[parent[i]] or bool(flat) and i not in taken and tag[i] in MENUS and d.link_tags[i] >= MENU_LINKS and d.link_chars[i] >= MENU_SHARE * d.chars[i]
            inside[i] = (i in taken or i > 0 and inside[parent[i]]) and not noise[i] and not menu[i]
        blocks, now = [], []
        for i, t in d.texts:
            if i < 0:
                blocks.append(now)
                now = []
            elif inside[i]:
                now.append(t)
        blocks.append(now)
        return "\n".join(x for x in (" ".join("".join(b).split()) for b in blocks if b) if x)


class Densities:
    """Of a page without its noise: characters, tags, density and density sum of each node, and the nodes chosen by them."""

    def __init__(self, page: Page, noise: list[bool]):
        n, tag, parent = len(page.tag), page.tag, page.parent
        self.tag, self.noise = tag, noise
        node = [t in BLOCKS or t in ("#root", "html", "a") for t in tag]
        self.node = [x and not z for x, z in zip(node, noise)]
        #: The node that a node is a child of.
        self.above = above = [-1] * n
        link = [False] * n
        for i in range(1, n):
            link[i] = tag[i] == "a" or link[parent[i]]
            above[i] = parent[i] if node[parent[i]] else above[parent[i]]
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        self.texts = [(i, unescape(t) if "&" in t else t) for i, t in page.texts if i < 0 or not noise[i]]
        for i, t in self.texts:
            if i >= 0:
                k = len(t) - t.count(" ") - t.count("\n")
                chars[i] += k
                if link[i]:
                    link_chars[i] += k
        for i in range(n - 1, 0, -1):
            if not noise[i]:
                p = parent[i]
                chars[p] += chars[i]
                tags[p] += tags[i] + node[i]
                link_chars[p] += link_chars[i]
                link_tags[p] += link_tags[i] + (tag[i] == "a")
        self.chars, self.link_chars, self.link_tags = chars, link_chars, link_tags
        self.body = body = next((i for i in range(n) if tag[i] == "body"), 0)
        share = link_chars[body] / max(1, chars[body])
        self.dense = [density(chars[i], tags[i], link_chars[i], link_tags[i], share) if x else 0.0 for i, x in enumerate(self.node)]
        self.total = [0.0] * n
        for i in range(1, n):
            if self.node[i]:
                self.total[above[i]] += self.dense[i]
        self.best = max(range(n), key=lambda i: (self.total[i], -i))
        if not self.total[self.best]:
            self.best = body if chars[body] else 0

    def chosen(self) -> set[int]:
        """Of each outermost node at or over the threshold, the subtree of the greatest sum."""
        path, i = [self.dense[self.best]], self.best
        while i != self.body and i > 0:
            i = self.above[i]
            path.append(self.dense[i])
        threshold = min(path)
        top, out = [-1] * len(self.tag), {}
        for i, x in enumerate(self.node):
            if x:
                above = top[self.above[i]] if i else -1
                top[i] = above if above >= 0 else (i if self.chars[i] and self.dense[i] >= threshold else -1)
                if top[i] >= 0 and self.total[i] > self.total[out.setdefault(top[i], top[i])]:
                    out[top[i]] = i
        return set(out.values())


def density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Composite text density: characters per tag, less the more of both are links; share: of the whole page's."""
    if not chars:
        return 0.0
    c, t, lc, lt = chars, max(1, tags), max(1, link_chars), max(1, link_tags)
    base = math.log(c / max(1, chars - link_chars) * lc + share * c + math.e)
    return max(0.0, c / t * math.log(max(1.0, c / lc * t / lt)) / math.log(max(base, 1.001)))


def main_text(html: str | None) -> str:
    return Page(html).main_text() if html else ""


def extracted(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text, n_chars.

    Blocks stand one a line, white space in them is one space. Null or empty html, and pages
    without prose, have an empty text; null page_ids and urls stay null; repeated rows are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    return rows.mapInArrow(lean(run), "page_id long, url string, text string, n_chars long")
