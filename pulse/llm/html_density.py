"""Main text of web pages by composite text density.

The page becomes a tree of block nodes (inline tags only count as tags). Every node has a density:
characters per tag, adjusted by the share of its characters and tags that are links. The densities of
a node's children are summed, and the smallest density on the path from the node with the largest sum to
the body is the threshold. From the body down, every block that reaches it (as do all blocks around it) gives
the subtree with the largest sum inside it; so an article in several containers is kept from all of them.
Where the densest node lies in an ``article`` or ``main`` element, that element is the article: ``main`` if it
holds several articles, and else the innermost ``article`` with those of its siblings that reach the threshold.
Inside the article a block below the threshold goes if it is a menu (links of few words and little else) or if a
word of its class or id that may also be a subject (``related``, ``search`` ...) calls it boilerplate; at or above the
threshold such a block stays.

Never part of an article, whatever their density: scripts, styles, forms, navigation, asides, footers,
headers outside the article, and elements whose class, id or role calls them a menu, sidebar, notice,
advert or reader comments. A button stays where it stands in the text of a block.

What decides where: on pages whose boilerplate is in such elements or so named these rules leave the article alone, and
the densities only confirm it; on pages without these hints the densities find it (see the tests).

Defined results: null or empty html gives an empty text; broken markup is read on as far as it goes
(unclosed tags end with their parent, a tag without end is text); a very long page is read whole; of several densest
nodes the first in page order counts; repeated rows each get a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pulse.llm.common import blocks, ensure_columns, map_arrow

# --- fixed values: element names and the words that mark boilerplate ------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                  "ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead title tr ul xmp".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p plaintext pre search section summary table ul xmp".split())
NEVER = frozenset("applet audio canvas datalist dialog embed fieldset footer form frame frameset head iframe input "
                  "legend link map menu meta meter nav noembed noframes noscript object optgroup option output progress "
                  "script select style svg template textarea title video aside".split())
KEEP = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
WORDS = frozenset("ad ads adsense advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment "
                  "comments commentlist consent cookie cookies disqus footer gdpr masthead menu modal nav "
                  "navbar navigation newsletter notice notices pager pagination popup sidebar sidenav signup "
                  "sponsor sponsored subscribe toolbar topbar widget widgets".split())
# Words that may also name what an article is about.
DOUBTFUL = frozenset("discussion login overlay promo promotion recommended related replies reply respond search share sharing skip social".split())
MENU_LINK = 24  # characters of a link in a menu, on average at most
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NOT_MARKS = ("has", "no", "with", "without", "is", "not")
# What ends an open element: tag -> (elements it closes, elements that shield them).
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
          "option": (("option",), ("select",))}
SHIELDS = ("table", "td", "th", "button", "object", "caption")

_STRICT = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LENIENT = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_MARKS = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def marked(attributes: str, words: frozenset = WORDS) -> bool:
    """Whether class, id or role call an element boilerplate."""
    for m in _MARKS.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            if value.strip().lower() in ROLES:
                return True
            continue
        for name in value.split():
            parts = [p.lower() for p in _PARTS.findall(name)]
            if parts and parts[0] not in NOT_MARKS and not words.isdisjoint(parts):
                return True
    return False


class Tree:
    """Nodes in page order with their parents. ``texts``: each text with the node it is in, and
    (node, None) where a block begins or ends."""

    def __init__(self, page: str, forms: bool = False, marks: bool = True):
        self.never = NEVER - {"form"} if forms else NEVER
        self.marks = marks
        self.tag, self.parent, self.block, self.dropped, self.link = ["#"], [-1], [True], [False], [False]
        self.doubtful: set[int] = set()
        self.texts: list[tuple[int, str | None]] = []
        self._stack = [0]
        self._blocks = [0]  # places of open blocks in the stack
        self._open: dict[str, list[int]] = {}  # places in the stack, by tag
        self._read(page)

    def _read(self, page: str) -> None:
        at, n, tag_at = 0, len(page), _STRICT.match
        raw_end: dict[str, re.Pattern] = {}
        while at < n:
            lt = page.find("<", at)
            if lt < 0:
                break
            if lt > at:
                self.texts.append((self._stack[-1], page[at:lt]))
            at = lt
            nxt = page[lt + 1:lt + 2]
            if nxt in ("!", "?"):
                comment = page.startswith("<!--", lt)
                end = page.find("-->" if comment else ">", lt + 4 if comment else lt)
                at = n if end < 0 else end + (3 if comment else 1)
                continue
            letter = page[lt + 2:lt + 3] if nxt == "/" else nxt
            m = None
            if letter.isascii() and letter.isalpha():
                m = tag_at(page, lt)
                if m is None and tag_at is not _LENIENT.match:
                    tag_at = _LENIENT.match  # a quote that never ends: from here on any > ends a tag
                    m = tag_at(page, lt)
                if m is None:
                    break  # no > is left: the rest is text
            elif nxt == "/" and letter and (end := page.find(">", lt)) >= 0:
                at = end + 1  # an end tag without a name
                continue
            if m is None:
                self.texts.append((self._stack[-1], "<"))
                at = lt + 1
                continue
            at, name = m.end(), m[2].lower()
            if m[1]:
                self._end(name)
                continue
            self._start(name, m[3])
            if name in RAW:
                stop = raw_end.get(name) or raw_end.setdefault(name, re.compile(f"</{name}(?=[\\s/>])", re.I))
                e = stop.search(page, at)
                at = e.start() if e else n
            elif name in VOID:
                self._pop()
        if at < n:
            self.texts.append((self._stack[-1], page[at:]))

    def _innermost(self, names) -> int:
        return max((self._open[x][-1] for x in names if self._open.get(x)), default=-1)

    def _start(self, name: str, attributes: str) -> None:
        if name in ENDS_P and self._innermost(("p",)) > self._innermost(SHIELDS):
            self._end("p")
        if name == "a" and self._open.get("a"):
            self._end("a")
        if name in CLOSES:
            ends, shields = CLOSES[name]
            while (k := self._innermost(ends)) > self._innermost(shields):
                self._end(self.tag[self._stack[k]])
        above, block = self._stack[-1], name in BLOCK
        drop = self.dropped[above] or name in self.never or (self.marks and bool(attributes) and name not in KEEP and marked(attributes))
        if name == "header" and not drop:
            drop = self._innermost(("article", "main")) < 0
        if block:
            self.texts.append((above, None))
        elif name == "br":
            self.texts.append((above, "\n"))
        self.tag.append(name)
        self.parent.append(above)
        self.block.append(block)
        self.dropped.append(drop)
        self.link.append(self.link[above] or name == "a")
        if self.marks and attributes and not drop and name not in KEEP and marked(attributes, DOUBTFUL):
            self.doubtful.add(len(self.tag) - 1)
        self._open.setdefault(name, []).append(len(self._stack))
        if block:
            self._blocks.append(len(self._stack))
        self._stack.append(len(self.tag) - 1)

    def _pop(self) -> None:
        k = self._stack.pop()
        self._open[self.tag[k]].pop()
        if self.block[k]:
            self._blocks.pop()
            self.texts.append((k, None))

    def _end(self, name: str) -> None:
        depths = self._open.get(name)
        if not depths:
            return
        to = depths[-1]
        if name not in BLOCK and self._blocks[-1] > to:
            return  # an inline end tag doesn't end the block it is in
        while len(self._stack) > to:
            self._pop()


def density(c: float, t: float, lc: float, lt: float, share: float) -> float:
    """Characters per tag, adjusted by the links: ``share`` is the body's link share. Zero
    denominators count as one."""
    t, lt_, lc_ = max(t, 1), max(lt, 1), max(lc, 1)
    arg = c / lc_ * (t / lt_)
    if arg <= 1:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    return c / t * math.log(arg) / max(math.log(base), 0.05)


def _size(text: str) -> int:
    return sum(map(len, text.split()))


def main_text(page: str | None) -> str:
    """The article of one page. If a form or a mark covers all of it, forms, then marks are let pass."""
    if not page:
        return ""
    return _article(Tree(page)) or _article(Tree(page, forms=True)) or _article(Tree(page, forms=True, marks=False))


def _article(tree: Tree) -> str:
    n, parent, block, dropped = len(tree.tag), tree.parent, tree.block, tree.dropped
    chars, tags, link_chars, link_tags, own = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    holder = list(range(n))  # the block that an inline node lies in
    for k in range(1, n):
        if not block[k]:
            holder[k] = holder[parent[k]]
    buttons = {k for k in range(n) if tree.tag[k] == "button"}
    if buttons:  # those that stand alone in their block are controls
        spoken = {holder[k] for k, t in tree.texts if t and not dropped[k] and k not in buttons and not t.isspace()}
        dropped = list(dropped)
        for k in range(1, n):
            dropped[k] = dropped[k] or dropped[parent[k]] or k in buttons and holder[k] not in spoken
    texts = [(k, entities.unescape(t) if t and "&" in t else t) for k, t in tree.texts if not dropped[k]]
    for k, text in texts:
        if text and (size := _size(text)):
            chars[k] += size
            own[holder[k]] += size
            if tree.link[k]:
                link_chars[k] += size
    for k in range(n - 1, 0, -1):
        if not dropped[k]:
            p = parent[k]
            chars[p] += chars[k]
            link_chars[p] += link_chars[k]
            tags[p] += tags[k] + 1
            link_tags[p] += link_tags[k] + (tree.tag[k] == "a")
    if not chars[0]:
        return ""
    share = link_chars[0] / chars[0]
    dens, total = [0.0] * n, [0.0] * n
    for k in range(n):
        if block[k] and chars[k] and not dropped[k]:
            dens[k] = density(chars[k], tags[k], link_chars[k], link_tags[k], share)
            if k:
                total[holder[parent[k]]] += dens[k]
    for k in range(n):
        if total[k] and own[k]:  # text directly in a block counts like a child
            total[k] += density(own[k], 1, 0, 0, share)
    best = max(range(n), key=total.__getitem__)
    if not total[best]:
        best = max(range(n), key=dens.__getitem__)
    path = [best]
    while path[-1]:
        path.append(parent[path[-1]])
    limit = min(dens[k] for k in path if block[k])
    roots = _roots(tree, path, dens, total, holder, limit)
    inside = [False] * n
    for k in range(n):
        menu = block[k] and dens[k] < limit and (k in tree.doubtful or link_tags[k] >= 3 and link_chars[k] >= 0.9 * chars[k]
                                                 and link_chars[k] <= MENU_LINK * link_tags[k])
        inside[k] = (k in roots or k > 0 and inside[parent[k]]) and not dropped[k] and not menu
    out: list[str] = []
    words: list[str] = []
    for k, text in [*texts, (0, None)]:
        if text is None:
            if words and (line := " ".join("".join(words).split())):
                out.append(line)
            words = []
        elif inside[k]:
            words.append(text)
    return "\n".join(out)


def _roots(tree: Tree, path: list[int], dens: list[float], total: list[float], holder: list[int], limit: float) -> set[int]:
    """The nodes whose subtrees are the article. ``path``: the densest node and all above it."""
    n, tag, parent = len(tree.tag), tree.tag, tree.parent
    main = next((k for k in path if tag[k] == "main"), None)
    article = next((k for k in path if tag[k] == "article"), None)
    if main is not None:
        outer, several = [-1] * n, 0  # the outermost article around a node, below main
        for k in range(main + 1, n):
            if parent[k] < main:
                break
            outer[k] = outer[parent[k]] if outer[parent[k]] >= 0 else k if tag[k] == "article" else -1
            several += outer[k] == k and dens[k] > 0
        if several > 1 or article is None:
            return {main}
    if article is not None:
        return {article} | {k for k in range(n) if tag[k] == "article" and parent[k] == parent[article] and 0 < limit <= dens[k]}
    best = list(range(n))  # the node of the largest sum in each subtree, the first of several
    for k in range(n - 1, 0, -1):
        p = parent[k]
        if total[best[k]] > total[best[p]] or best[p] != p and total[best[k]] == total[best[p]]:
            best[p] = best[k]
    reach, roots = [False] * n, {path[0]}
    for k in range(n):
        reach[k] = tree.block[k] and dens[k] > 0 and dens[k] >= limit and (not k or reach[holder[parent[k]]])
        if reach[k]:
            roots.add(best[k])
    return roots


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per row of ``pages``; no shuffle, whole pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html"):
            texts = [main_text(p) for p in block.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": block.column("page_id"), "url": block.column("url"),
                                              "text": pa.array(texts, pa.large_string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return map_arrow(ensure_columns(pages, {"page_id": "long", "url": "string", "html": "string"}), run,
                     "page_id long, url string, text string, n_chars long")
