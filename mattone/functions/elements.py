"""The elements of a page as a table inside its row: one scan, then containment tests.

``with_elements`` cuts a page at every ``<`` and pairs opening with closing tags; an element is the interval of pieces
from its opening to its closing tag, so one element lies inside another just when its interval does.  Selectors are
filters on that array, and reading one more field costs no further look at the page.

Pairing needs no stack.  In the order of (tag, place), an opening tag that is the i-th tag and the o-th opening one
(both from 0) leaves ``2 * o + 1 - i`` more tags opened than closed, and the c-th closing one closes level ``i - 2 * c``.  Of one
tag and level, opening and closing tags take turns, so in the order of (tag, level, place) each opening tag stands right before its own closing
one.  All of this is sorting and numbering of arrays: a page of n tags costs n log n, and no Python worker or shuffle.

``insides`` reads the elements of one node without the table, by one pattern.  It follows elements of the node's tag inside one another
``NESTED`` deep; what it can not follow, or what is never closed, it gives up to the end of the text, which ``open_ended`` tells.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.functions.html import Node, Path, visible_text
from mattone.functions.text import bound

# Elements that have no closing tag.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "use", "wbr"]

_NAME = r"^/?([A-Za-z][A-Za-z0-9]*)(?=[\s>/])"


def with_elements(pages: DataFrame, html: str = "html", only: list[str] | None = None) -> DataFrame:
    """Add ``pieces``, the page cut at every ``<``, and ``elements``, structs (begin, end, tag, depth) in page order.

    ``begin`` and ``end`` number the pieces of the opening and the closing tag; piece 0 is what stands before the first ``<``.  An element that is never closed ends behind the last
    piece; void and self-closed ones end where they begin.  ``depth`` is 1 for an element in no other, counting tags opened
    and not yet closed.  Closing tags that close nothing are passed over.  A null or empty page has no elements.
    With ``only`` these tags alone are listed, and ``depth`` counts them alone; elements of other tags change neither where one begins nor where it ends.
    """
    keep = pages.columns
    cut = pages.withColumn("pieces", F.coalesce(F.split(html, "<"), F.array().cast("array<string>")))

    def tag(name: Column, at: Column, closing: bool) -> Column:
        return F.struct(name.alias("tag"), at.alias("at"), F.lit(closing).alias("closing"))

    def name(p: Column, i: Column) -> Column:
        # Most pieces of a page are tags that are not asked for: their first characters tell, without a pattern.
        asked = i > 0 if only is None else (i > 0) & F.lower(F.left(p, F.lit(2))).isin(_beginnings(only))
        found = F.when(asked, F.lower(F.regexp_extract(p, _NAME, 1))).otherwise("")
        return found if only is None else bound(found, lambda n: F.when(n.isin(only), n).otherwise(""))

    named = cut.withColumn("_names", F.transform("pieces", name))

    def tags(name: Column, at: Column) -> Column:
        piece = F.get(F.col("pieces"), at)
        alone = name.isin(VOID) | (piece.contains("/>") & piece.rlike(r"^[^>]*/>"))
        both = F.array(tag(name, at, False), tag(name, at, True))
        return F.when(name == "", F.slice(both, 1, 0)).when(F.startswith(piece, F.lit("/")), F.slice(both, 2, 1)).when(alone, both).otherwise(F.slice(both, 1, 1))

    every = F.transform("_names", tags)
    listed = named.withColumn("_tags", F.flatten(every if only is None else F.filter(every, lambda t: F.size(t) > 0)))
    # In page order: how many elements are open around each opening tag.
    placed = listed.withColumn("_tags", F.transform("_tags", lambda t, i: F.struct(t["tag"].alias("tag"), t["at"].alias("at"), t["closing"].alias("closing"), i.alias("i"))))

    def opening(t: Column, o: Column) -> Column:
        return F.struct(t["tag"].alias("tag"), t["at"].alias("at"), t["closing"].alias("closing"), (2 * o + 1 - t["i"]).alias("depth"))

    def closing(t: Column) -> Column:
        return F.struct(t["tag"].alias("tag"), t["at"].alias("at"), t["closing"].alias("closing"), F.lit(0).alias("depth"))

    opened = F.transform(F.filter("_tags", lambda t: ~t["closing"]), opening)
    closed = F.transform(F.filter("_tags", lambda t: t["closing"]), closing)
    by_tag = placed.withColumn("_tags", F.sort_array(F.concat(opened, closed)))
    # In the order of (tag, place): the level that each tag opens or closes among those of its name.
    numbered = by_tag.withColumn("_tags", F.transform("_tags", lambda t, i: F.struct(t["tag"].alias("tag"), t["at"].alias("at"), t["closing"].alias("closing"), t["depth"].alias("depth"), i.alias("i"))))

    def level(t: Column, at: Column) -> Column:
        return F.struct(t["tag"].alias("tag"), at.alias("level"), t["at"].alias("at"), t["closing"].alias("closing"), t["depth"].alias("depth"))

    opened = F.transform(F.filter("_tags", lambda t: ~t["closing"]), lambda t, o: level(t, 2 * o + 1 - t["i"]))
    closed = F.transform(F.filter("_tags", lambda t: t["closing"]), lambda t, c: level(t, t["i"] - 2 * c))
    by_level = numbered.withColumn("_tags", F.sort_array(F.concat(opened, closed)))

    def element(t: Column, i: Column) -> Column:
        after = F.get(F.col("_tags"), i + 1)
        own = (after["tag"] == t["tag"]) & (after["level"] == t["level"]) & after["closing"]
        end = F.when(own, after["at"]).otherwise(F.size("pieces"))
        return F.struct(t["at"].alias("begin"), end.alias("end"), t["tag"].alias("tag"), t["depth"].alias("depth"), t["closing"].alias("closing"))

    paired = by_level.withColumn("elements", F.filter(F.transform("_tags", element), lambda e: ~e["closing"]))
    plain = F.transform("elements", lambda e: F.struct(e["begin"].alias("begin"), e["end"].alias("end"), e["tag"].alias("tag"), e["depth"].alias("depth")))
    return paired.select(*keep, "pieces", F.sort_array(plain).alias("elements"))


def _beginnings(tags: list[str]) -> list[str]:
    """The first two characters, in lower case, of what follows ``<`` in opening and closing tags of these names."""
    opening = {t[:2] for t in tags if len(t) > 1} | {t + after for t in tags if len(t) == 1 for after in " \t\n\x0b\f\r>/"}
    return sorted(opening | {"/" + t[0] for t in tags})


def _opens(element: Column, node: Node, whole: bool, pieces: str) -> Column:
    """Whether the element's opening tag has the node's word in its attribute, or as all of its value."""
    piece = F.get(F.col(pieces), element["begin"])
    # Plain search first: few tags hold the word at all.
    return piece.contains(node.word) & piece.rlike("^" + node.opening(whole).removeprefix("<"))


def select(node: Node, whole: bool = False, elements: str = "elements", pieces: str = "pieces") -> Column:
    """The elements of a node: of its tag, with its word in its attribute, or as all of the attribute's value."""
    if node.attr is None:
        return F.filter(elements, lambda e: e["tag"] == node.tag)
    return F.filter(elements, lambda e: (e["tag"] == node.tag) & _opens(e, node, whole, pieces))


def first(node: Node, whole: bool = False) -> Column:
    """The first element of a node, null without one."""
    return F.get(select(node, whole), F.lit(0))


def holds(outer: Column, inner: Column) -> Column:
    """Whether one element lies inside another."""
    return (inner["begin"] > outer["begin"]) & (inner["end"] <= outer["end"])


def within(inner: Column, outer: Column) -> Column:
    """Those of the inner elements that lie in the outer one."""
    return F.filter(inner, lambda e: holds(outer, e))


def within_any(inner: Column, outer: Column) -> Column:
    """Those of the inner elements that lie in any of the outer ones.

    Naming the outer ones twice keeps them a finished column: Spark would move an expression named once into the inner loop.
    """
    found = F.filter(inner, lambda e: F.exists(outer, lambda o: holds(o, e)))
    return F.when(F.size(outer) > 0, found).otherwise(F.slice(inner, 1, 0))


def inside(element: Column, pieces: str = "pieces") -> Column:
    """What stands between an element's tags, markup included; empty without the element."""
    opening = F.get(F.col(pieces), element["begin"])
    start = F.regexp_replace(opening, "^[^>]*>", "")
    length = element["end"] - element["begin"] - 1
    more = F.when(length > 0, F.concat(start, F.lit("<"), F.array_join(F.slice(pieces, element["begin"] + 2, length), "<"))).otherwise(start)
    return F.when(element["end"] > element["begin"], more).otherwise("")


# How deep ``insides`` follows elements of one tag inside one another, and how far from a tag's beginning it looks for its word.
NESTED = 12
TAG_LENGTH = 1024


def _content(tag: str) -> str:
    """Pattern of what stands in an element behind its opening tag: up to its own closing tag, the end, or what is nested too deep.

    Its outer loops are possessive, which Java runs without recursion and never goes back into.
    """
    name = rf"(?i:{tag})(?=[\s>/])"
    other = rf"[^<]+|<(?!/?{name})|<{name}[^<>]*(?<=/)>"
    content = rf"(?:{other})*+"
    for _ in range(NESTED):
        content = rf"(?:{other}|<{name}{content}</{name})*+"
    return content


def _opening(node: Node, whole: bool) -> str:
    """Pattern of the opening tags that ``select`` finds, up to where ``inside`` begins; a tag ends before the next ``<``.

    A node's word comes first, as Java skips to a literal text; what must stand before it is looked up from there.  Group 1 takes part
    in the match where the tag is too long to tell, or its attribute holds ``>``.
    """
    if node.attr is None:
        return rf"()?+<(?=(?i:{node.tag})[\s>/])(?:[^<>]*>)?+"
    word, tag = re.escape(node.word or ""), rf"<{node.tag}(?=[\s>/])[^<>]{{0,{TAG_LENGTH}}}\s{node.attr}="
    if whole:
        word, before, doubtful, after = rf'{node.attr}="{word}"', rf'{tag}"{word}"', "", ""
    else:
        before, doubtful, after = rf'{tag}"[^"<>]{{0,{TAG_LENGTH}}}', rf'{tag}"[^"<]{{0,{TAG_LENGTH}}}|', '[^"<]*"'
    return rf'{word}(?:(?<={before})(?={after}[^<>]*>)[^<>]*>|(?<={doubtful}[^<]{{{TAG_LENGTH}}})())'


def _reading(node: Node, whole: bool, overlapping: bool) -> str:
    """Pattern of an element, its inside being group 2; to the end where it is doubtful."""
    doubt = r"(?!)" if node.attr is None else r"\1.+"
    # An element that opens where the text ends is not closed in it, and holds nothing that would tell.
    inside = rf"({doubt}|(?!\z){_content(node.tag)}(?:(?=</(?i:{node.tag})[\s>/])|.*))"
    # A tag that closes itself holds nothing.
    return rf"(?s){_opening(node, whole)}(?:(?<=/>)|{f'(?={inside})' if overlapping else inside})"


def first_inside(text: Column, node: Node, whole: bool = False) -> Column:
    """Inside of the first element of a node, as ``inside(first(node))``; empty without one. Holds unless ``open_ended``."""
    return F.regexp_extract(text, _reading(node, whole, False), 2)


def insides(text: Column, node: Node, nested: bool = True) -> Column:
    """Insides of all elements of a node in page order, those in others of the node too if ``nested``. Holds unless one is ``open_ended``."""
    return F.regexp_extract_all(text, F.lit(_reading(node, False, nested)), F.lit(2))


def open_ended(text: Column, found: Column) -> Column:
    """Whether an inside reaches to the end of the text it was read from, so that the element is not closed there, or could not be followed."""
    return (found != "") & F.endswith(text, found)


def text_of(element: Column, pieces: str = "pieces") -> Column:
    """Visible text of an element; empty without the element."""
    return visible_text(inside(element, pieces))


def select_path(pages: DataFrame, path: Path, out: str) -> DataFrame:
    """Add the elements at the end of a path, each node's inside one of the node before, one projection per node."""
    found = pages.withColumn(out, select(path[0]))
    for node in path[1:]:
        deeper = found.withColumn("_deeper", select(node))
        found = deeper.withColumn(out, within_any(F.col("_deeper"), F.col(out))).drop("_deeper")
    return found


def listed(pages: DataFrame, columns: list[str], elements: str = "elements") -> DataFrame:
    """One row per struct of an array column, its fields beside ``columns``.

    An outer generator and a filter on its result: from a plain one Spark infers a filter on the array's size, which it would
    push below the scan of the page and so compute every step of it again, many times over.
    """
    return pages.select(*columns, F.inline_outer(elements)).where(F.col("begin").isNotNull())
