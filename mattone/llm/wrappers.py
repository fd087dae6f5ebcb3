"""Main text of web pages by wrapper induction.

The page of the smallest page_id of a host is its reference.  Every other page of the host is aligned with it by
simple tree matching: two nodes match if their tags are equal, and matched children keep their order.  A
reference text that the same words fill on most aligned pages is template, a slot whose words vary is content;
a block with one varying slot is content as a whole.
Only counts per reference text travel, so a host of any size is induced from all its pages, in parallel.
A matching depends on the tags alone and is kept per pair of shapes, which pages of a host mostly share.

Elements whose tag, or a whole word of whose class, id or role, names a role that is no main text (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, comments) are template by that role: such a slot may vary as well.
If that leaves a page no ``article`` or ``main``, wrappers so named around one, or else around most of the words, have no role.
Words that repeat inside an ``article`` or ``main`` element are the article's own and stay content.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.llm.arrays import slices
from mattone.llm.scratch import small_side, written

# A text is template if at least this share of three pages or more, aligned with it, have the same words there.
CONSTANT, LEAST_PAGES = 0.8, 3
# References are broadcast if together they hold at most this many characters; else both sides are shuffled by host.
BROADCAST_CHARS = 16 << 20
# A task forgets its shapes, matchings and references beyond so many children of shapes and pairs of matchings, or so many references.
KEPT_PAIRS, KEPT_REFERENCES = 1 << 18, 256

# Names of elements, by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
ROLE_TAGS = frozenset("head script style noscript template iframe object embed svg canvas nav header footer aside form button select textarea dialog menu title".split())
ROLE_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside notice notices cookie cookies consent banner ad ads advert adverts advertisement sponsored promo "
    "form search login signup newsletter subscribe comment comments disqus share sharing social related breadcrumb breadcrumbs pagination popup modal skip".split()
)
ARTICLE = frozenset({"article", "main"})
# Tags that can wrap a whole page; the other tags of a role keep it whatever they hold.
WRAPPERS = frozenset({"form", "header", "aside"})
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_ENDS = frozenset(
    "address article aside blockquote details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split()
)
P_WALLS = frozenset({"div", "section", "article", "main", "td", "th", "li", "body", "table", "button", "blockquote", "aside", "nav", "header", "footer", "form"})

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*+)(?:>|$)|<!--.*?(?:-->|$)|<[!?/][^>]*+(?:>|$)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW_ENDS = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d\xa0"


def _spaced(text: str) -> str:
    """``text`` trimmed, each run of white space in it one space."""
    for space in _SPACES[1:]:
        if space in text:
            text = text.replace(space, " ")
    while "  " in text:
        text = text.replace("  ", " ")
    return text.strip(" ")


class Page:
    """Nodes of a page in document order: tag ('#text' for texts), parent, text, and whether it is template by role."""

    __slots__ = ("tag", "parent", "text", "role", "article")

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.text, self.role, self.article = ["#page"], [-1], [""], [False], [False]
        open_ = [0]
        at = 0
        size = len(html)
        while at < size:
            for found in _TAG.finditer(html, at):
                start = found.start()
                if start > at:
                    self._add_text(open_[-1], html[at:start])
                at = found.end()
                closes, name, attributes, cut_closes, cut_name, cut_attributes = found.groups()
                name = name or cut_name
                if not name:
                    continue
                name = name.lower()
                if closes or cut_closes:
                    self._close(open_, name)
                    continue
                if name in P_ENDS:
                    self._close_within(open_, {"p"}, P_WALLS)
                if name in CLOSES:
                    self._close_within(open_, *CLOSES[name])
                node = self._add(open_[-1], name, attributes or cut_attributes)
                if name in VOID:
                    continue
                if name in RAW:
                    end = _RAW_ENDS[name].search(html, at)
                    stop = end.start() if end else size
                    self._add_text(node, html[at:stop])
                    gone = html.find(">", stop)
                    at = size if gone < 0 else gone + 1
                    break
                open_.append(node)
            else:
                if at < size:
                    self._add_text(open_[-1], html[at:])
                at = size
        self._settle()

    def _settle(self) -> None:
        """From the elements that a role is named for to all below them, wrappers of the main text apart."""
        own = self.role
        if True not in own:
            return

        def reached() -> list[bool]:
            out: list[bool] = []
            for named, parent in zip(own, self.parent):
                out.append(named or parent >= 0 and out[parent])
            return out

        role = reached()
        if not any(tag in ARTICLE and not r for tag, r in zip(self.tag, role)):
            fixed = [tag in ROLE_TAGS and tag not in WRAPPERS for tag in self.tag]
            if any(r and not f for r, f in zip(own, fixed)):
                words, articles = [len(text.split()) for text in self.text], [int(tag in ARTICLE) for tag in self.tag]
                for node in range(len(own) - 1, 0, -1):
                    if not fixed[node]:
                        words[self.parent[node]] += words[node]
                        articles[self.parent[node]] += articles[node]
                for node in range(1, len(own)):
                    if not fixed[node] and (articles[node] if articles[0] else 2 * words[node] > words[0]):
                        own[node] = False
                role = reached()
        self.role = role

    def _add(self, parent: int, tag: str, attributes: str) -> int:
        node = len(self.tag)
        main = tag in ARTICLE
        role = tag in ROLE_TAGS
        if attributes and not role and not main and tag not in ("html", "body"):
            for a, b, c in _NAMES.findall(attributes):
                role = role or any(word.lower() in ROLE_WORDS for word in (a or b or c).split())
        self.tag.append(tag)
        self.parent.append(parent)
        self.text.append("")
        self.role.append(role)
        self.article.append(main or self.article[parent])
        return node

    def _add_text(self, parent: int, text: str) -> None:
        if not text or text.isspace() and self.tag[parent] in ("#page", "html", "head"):
            return
        node = self._add(parent, "#text", "")
        self.text[node] = unescape(text)

    def _close(self, open_: list[int], name: str) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if self.tag[open_[i]] == name:
                del open_[i:]
                return
            if name in INLINE and self.tag[open_[i]] not in INLINE:
                return

    def _close_within(self, open_: list[int], names: set[str], walls: set[str]) -> None:
        for i in range(len(open_) - 1, 0, -1):
            tag = self.tag[open_[i]]
            if tag in names:
                del open_[i:]
                return
            if tag in walls:
                return

    def words(self, node: int) -> str:
        return _spaced(self.text[node])

    def blank(self, node: int) -> bool:
        return not self.text[node].lstrip(_SPACES)

    def main_text(self, template: frozenset[int] = frozenset()) -> str:
        """Blocks in page order, joined by a line feed; those are left out whose texts are all in ``template``."""
        blocks: list[str] = []
        parts: list[str] = []
        own = False

        def flush() -> None:
            nonlocal own
            if own and (block := _spaced("".join(parts))):
                blocks.append(block)
            parts.clear()
            own = False

        open_: list[int] = []
        for node, (tag, parent) in enumerate(zip(self.tag, self.parent)):
            while open_ and parent != open_[-1]:
                if self.tag[open_.pop()] not in INLINE and parts:
                    flush()
            if tag == "#text":
                if not self.role[node]:
                    parts.append(self.text[node])
                    own = own or node not in template and not self.blank(node)
                continue
            if tag == "br":
                parts.append(" ")
            elif parts and tag not in INLINE:
                flush()
            open_.append(node)
        flush()
        return "\n".join(blocks)


class Shapes:
    """Shapes of subtrees, and how two shapes match.

    A shape is a number for a tag and the shapes of the children that take part in the alignment: those that are no template by role, blank
    texts left out.  Two subtrees of one shape match node by node, and a matching depends on the two shapes alone, so that pages laid out
    alike share it.  A child's number is less than its parent's.
    """

    def __init__(self) -> None:
        self.number: dict[tuple, int] = {}
        self.tag: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.size: list[int] = []
        # Of two different shapes of one tag: the weight of their matching, and its pairs of children by place, the last ones first.
        self.matched: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
        self.outlines: dict[Page, tuple[list[list[int]], list[int]]] = {}
        self.held = 0

    def outline(self, page: Page) -> tuple[list[list[int]], list[int]]:
        """(children that take part in the alignment, shape) of each node."""
        slots: list[list[int]] = [[] for _ in page.tag]
        shape = [0] * len(slots)
        for node in range(len(slots) - 1, -1, -1):
            tag = page.tag[node]
            if page.role[node] or tag == "#text" and page.blank(node):
                continue
            kids = slots[node]
            kids.reverse()
            key = (tag, *[shape[k] for k in kids])
            found = self.number.get(key)
            if found is None:
                found = self.number[key] = len(self.tag)
                self.tag.append(tag)
                self.children.append(key[1:])
                self.size.append(1 + sum([self.size[k] for k in key[1:]]))
                self.held += len(key)
            shape[node] = found
            if node:
                slots[page.parent[node]].append(node)
        return slots, shape

    def kept_outline(self, page: Page) -> tuple[list[list[int]], list[int]]:
        """``outline`` of a page that many are aligned with, computed once."""
        if page not in self.outlines:
            self.outlines[page] = self.outline(page)
        return self.outlines[page]

    def _equal_start(self, x: int, y: int) -> int:
        """How many first children have equal shapes: no matching outweighs their pairs, nor is one of equal weight preferred."""
        n = 0
        for u, v in zip(self.children[x], self.children[y]):
            if u != v:
                break
            n += 1
        return n

    def match(self, x: int, y: int) -> None:
        """Weighs the largest matching of two different shapes of one tag, and of all below them that it takes."""
        # Pairs that can match at all: equal tags below matching parents. Equal shapes match as a whole, so what lies below them need not be compared.
        todo, i = [(x, y)], 0
        seen = {(x, y)}
        while i < len(todo):
            x, y = todo[i]
            i += 1
            start = self._equal_start(x, y)
            others = set(self.children[y][start:])
            for u in set(self.children[x][start:]):
                for v in others:
                    if u != v and self.tag[u] == self.tag[v] and (u, v) not in self.matched and (u, v) not in seen:
                        seen.add((u, v))
                        todo.append((u, v))
        for x, y in sorted(todo):
            self.matched[x, y] = found = self._matching(x, y)
            self.held += 1 + len(found[1])

    def _matching(self, x: int, y: int) -> tuple[int, list[tuple[int, int]]]:
        start = self._equal_start(x, y)
        kids, others = self.children[x][start:], self.children[y][start:]
        weights: dict[int, list[int]] = {}
        rows = [[0] * (len(others) + 1)]
        for u in kids:
            if u not in weights:
                weights[u] = [self.size[u] if u == v else self.matched[u, v][0] if self.tag[u] == self.tag[v] else 0 for v in others]
            above, row, last = rows[-1], [0], 0
            for own, before, best in zip(weights[u], above, above[1:]):
                if own and before + own > best:
                    best = before + own
                if last > best:
                    best = last
                row.append(best)
                last = best
            rows.append(row)
        chosen, i, j = [], len(kids), len(others)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                chosen.append((start + i, start + j))
        chosen += [(k, k) for k in range(start - 1, -1, -1)]
        return 1 + sum([self.size[k] for k in self.children[x][:start]]) + rows[-1][-1], chosen


def align(page: Page, reference: Page, shapes: Shapes | None = None) -> list[tuple[int, int]]:
    """Pairs (text of page, text of reference) of the largest simple tree matching."""
    shapes = shapes or Shapes()
    (a, shape_a), (b, shape_b) = shapes.outline(page), shapes.kept_outline(reference)
    out, todo = [], [(0, 0)]
    while todo:
        x, y = todo.pop()
        if page.tag[x] == "#text":
            out.append((x, y))
            continue
        kids, others, pair = a[x], b[y], (shape_a[x], shape_b[y])
        if pair[0] == pair[1]:
            todo += zip(kids, others)
            continue
        if pair not in shapes.matched:
            shapes.match(*pair)
        todo += [(kids[i], others[j]) for i, j in shapes.matched[pair][1]]
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*:?//([^/?#]*)", 1))


class _References:
    """The last few parsed references, as rows of a host mostly come with the same one, and the shapes met beside them."""

    def __init__(self) -> None:
        self.kept: dict[str, Page] = {}
        self.shapes = Shapes()

    def get(self, html: str) -> Page:
        if self.shapes.held > KEPT_PAIRS or len(self.kept) >= KEPT_REFERENCES and html not in self.kept:
            self.kept, self.shapes = {}, Shapes()
        if html not in self.kept:
            self.kept[html] = Page(html)
        return self.kept[html]

    def align(self, page: Page, reference: Page) -> Iterator[tuple[int, int, bool]]:
        """Pairs of ``align``, and whether both have the same words."""
        for u, v in align(page, reference, self.shapes):
            yield u, v, page.text[u] == reference.text[v] or page.words(u) == reference.words(v)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    references, met, same = _References(), Counter(), Counter()
    for batch in batches:
        for host, html, ref in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "reference"))):
            reference = references.get(ref)
            page = Page(html)
            for _, v, equal in references.align(page, reference):
                met[host, v] += 1
                same[host, v] += equal
    rows = list(met)
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([met[r] for r in rows], pa.int64()), pa.array([same[r] for r in rows], pa.int64())],
        ["host", "node", "met", "same"],
    )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    references = _References()
    for piece in slices(batches, "html"):
        texts = []
        for html, ref, nodes in zip(*(piece.column(c).to_pylist() for c in ("html", "reference", "nodes"))):
            page = Page(html or "")
            template: frozenset[int] = frozenset()
            if nodes:
                reference, constant = references.get(ref), set(nodes)
                template = frozenset(
                    u for u, v, equal in references.align(page, reference) if equal and v in constant and not page.article[u] and not reference.article[v]
                )
            texts.append(page.main_text(template))
        yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages(page_id, url, html)``.

    A null or empty page has an empty text.  A null url belongs to the host of the empty name; a null page_id is
    extracted and never a reference.  Repeated rows are answered each; a host with fewer than three aligned pages has no
    constant texts; an empty table gives an empty result; other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    filled = rows.where("page_id is not null and length(html) > 0")
    first = small_side(written(filled.groupBy("host").agg(F.min("page_id").alias("page_id")), "first-pages"))
    references = written(filled.join(first, ["host", "page_id"]).groupBy("host").agg(F.min("html").alias("reference")), "references")
    chars = references.agg(F.coalesce(F.sum(F.length("reference")), F.lit(0))).first()[0]

    def by_host(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if chars <= BROADCAST_CHARS else side

    aligned = rows.where("length(html) > 0").select("host", "html").join(by_host(references), "host")
    counts = aligned.mapInArrow(_counts, "host string, node int, met long, same long").groupBy("host", "node").agg(F.sum("met").alias("met"), F.sum("same").alias("same"))
    constant = counts.where((F.col("met") >= LEAST_PAGES) & (F.col("same") >= CONSTANT * F.col("met")))
    # A host's list is at most as long as its reference page.
    templates = written(constant.groupBy("host").agg(F.collect_list("node").alias("nodes")).join(references, "host"), "templates")
    joined = rows.join(by_host(templates), "host", "left").select("page_id", "url", "html", "reference", "nodes")
    return joined.mapInArrow(_extract, "page_id long, url string, text string")
