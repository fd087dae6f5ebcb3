"""Reading elements out of saved pages with patterns over (tag, attribute, label).

Everything is an expression over one page's text, so a job over pages is
a narrow projection: no shuffle and no Python worker.  Patterns hold single
character classes under their loops, which Java matches without recursion, so
the length of a page does not matter.  Where an element ends is counted, not matched: elements of
its own tag may stand inside it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.functions.text import BLANK_CLASS, UNCLEAN_CLASS, bound, none_if_empty, normalize_text, strip, strip_computed

# Code points by name of reference, and of the numbers 128 to 159, which pages mean as Windows-1252.
NAMES = ",".join(f"{name}:{code}" for name, code in {**name2codepoint, "apos": 39}.items())
WINDOWS = ",".join(f"{code}:{ord(bytes([code]).decode('cp1252'))}" for code in range(128, 160) if code not in (129, 141, 143, 144, 157))
UNKNOWN = 0xFFFD
# References that page text mostly has, the ampersand's last: a text with no others is read by plain replacement.
COMMON = ["nbsp", "euro", "agrave", "egrave", "eacute", "igrave", "ograve", "ugrave", "sup2", "quot", "lt", "gt", "amp"]


@dataclass(frozen=True)
class Node:
    """A tag with an optional attribute whose value holds a given word."""

    tag: str
    attr: str | None = None
    word: str | None = None

    def opening(self, whole: bool = False) -> str:
        """Pattern of the opening tag; the word stands in the attribute's value or is all of it."""
        name = rf"<{self.tag}(?=[\s>/])"
        if self.attr is None:
            return rf"{name}[^>]*>"
        around = "" if whole else '[^"]*'
        return rf'{name}[^>]*\s{self.attr}="{around}{re.escape(self.word or "")}{around}"[^>]*>'


Path = tuple[Node, ...]


@dataclass(frozen=True)
class PageLayout:
    """Where the parts of a listing page stand; a path names an element inside another."""

    title: Path
    price: Path
    location_box: Node
    location: Path
    description: Node
    description_title: Path
    description_text: Path
    update: Path
    badge_box: Path
    badge: Path
    energy_attr: str
    costs: Node
    price_info: Node
    features: Node
    luxury_icon: str
    characteristic: Node

    def box_tags(self) -> list[str]:
        """Tags of the elements that hold the fields, characteristics left out."""
        paths = (self.title, self.price, self.location, self.description_title, self.description_text, self.update, self.badge_box, self.badge)
        nodes = [n for path in paths for n in path] + [self.location_box, self.description, self.costs, self.price_info, self.features]
        return sorted({n.tag for n in nodes})


@dataclass(frozen=True)
class CardLayout:
    """Where the parts of one result card stand."""

    card: Node
    href_word: str


# Class words and attributes of the source's pages.
LISTING_PAGE = PageLayout(
    title=(Node("h1", "class", "styles_ld-title__title__Ww2Gb"),),
    price=(Node("div", "class", "Price_price__mzj0D"), Node("span")),
    location_box=Node("button", "class", "styles_ld-blockTitle__link__paCwh"),
    location=(Node("span", "class", "styles_ld-blockTitle__location__n2mZJ"),),
    description=Node("div", "data-tracking-key", "description"),
    description_title=(Node("p", "class", "styles_ld-descriptionHeading__title__ifRR2"),),
    description_text=(Node("div", "class", "styles_in-readAll__04LDT"), Node("div")),
    update=(Node("div", "class", "styles_ld-lastUpdate__0G31u"), Node("span", "class", "styles_ld-lastUpdate__text__KLqrs")),
    badge_box=(Node("div", "class", "styles_ld-featuresBadges__mJqLG"), Node("ul", "class", "styles_ld-featuresBadges__list__MGuKy")),
    badge=(Node("li", "class", "styles_ld-featuresBadges__badge___8QgZ"), Node("span", "class", "nd-badge")),
    energy_attr="data-energy-class",
    costs=Node("div", "data-tracking-key", "costs"),
    price_info=Node("div", "data-tracking-key", "price-information"),
    features=Node("div", "class", "styles_ld-mainFeatures__item"),
    luxury_icon="#diamond",
    characteristic=Node("div", "class", "styles_ld-primaryFeaturesDialogSection__feature__Maf3F"),
)
RESULT_CARD = CardLayout(
    card=Node("div", "class", "styles_in-listingCardPropertyContent__tfu8w"),
    href_word="immobiliare.it/annunci",
)
FEE_LABEL = "Spese condominio"
SQM_LABEL = "Prezzo al m²"
LUXURY_WORD = "Lusso"

DT = Node("dt")
DD = Node("dd")


def _character(code: Column) -> Column:
    """The character of a code point given in decimal digits; of none, of a surrogate and beyond Unicode the replacement character."""
    digits = bound(F.regexp_replace(code, "^0+", ""), lambda d: F.coalesce(F.try_element_at(F.expr(f"str_to_map('{WINDOWS}')"), d), d))
    number = bound(digits, lambda d: F.when(F.length(d).between(1, 7), d.cast("bigint")))

    def valid(n: Column) -> Column:
        return F.when(n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF), n).otherwise(F.lit(UNKNOWN))

    return F.decode(F.unhex(F.lpad(F.hex(bound(number, valid)), 8, "0")), "UTF-32")


def _resolved(piece: Column) -> Column:
    """What followed an ampersand, with the reference it may begin with resolved.

    Each step is bound: unbound, the steps name one another some two hundred times over, in every text that a plan shows.
    """
    name = "^([A-Za-z][A-Za-z0-9]*);"
    hexes = F.regexp_replace(F.regexp_extract(piece, "^#[xX]([0-9A-Fa-f]+)", 1), "^0+", "")
    code = (
        F.when(piece.rlike(name), F.try_element_at(F.expr(f"str_to_map('{NAMES}')"), F.regexp_extract(piece, name, 1)))
        .when(piece.rlike("^#[0-9]"), F.regexp_extract(piece, "^#([0-9]+)", 1))
        .when(piece.rlike("^#[xX][0-9A-Fa-f]"), bound(hexes, lambda h: F.when(F.length(h).between(1, 6), F.conv(h, 16, 10)).otherwise(F.lit("0"))))
    )
    rest = F.regexp_replace(piece, "^(?:#[xX][0-9A-Fa-f]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);?", "")
    return bound(code, lambda code: F.when(code.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(_character(code), rest)))


def unescape(c: Column) -> Column:
    """Character references resolved: those named in HTML 4 and apos, with their semicolon, and all numbers, decimal or hexadecimal, with it or without.

    Each is read once, from left to right: ``&amp;lt;`` is ``&lt;``.  What is no reference stays.
    """

    def resolved(t: Column) -> Column:
        pieces = F.transform(F.split(t, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(_resolved(piece)))
        return F.when(t.contains("&"), F.array_join(pieces, "")).otherwise(t)

    plain = c
    for name in COMMON:
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(chr(name2codepoint[name])))
    return F.when(c.rlike(f"&(?!(?:{'|'.join(COMMON)});)"), F.transform(F.array(c), resolved)[0]).otherwise(plain)


# What shows nothing, and tags that part words.
UNSEEN = r"(?is)<!--.*?-->|<(script|style)(?=[\s>]).*?</\1\s*>"
BREAK = r"(?i)</?(?:br|p|div|ul|ol|li|dl|dt|dd|h[1-6]|table|tr|td|th|section|article)(?=[\s>/])[^>]*>"


def visible_text(c: Column) -> Column:
    """Text of a fragment: tags dropped, those of blocks as blanks, character references resolved, stripped."""
    seen = F.when(c.contains("<!--") | c.contains("<s"), F.regexp_replace(c, UNSEEN, "")).otherwise(c)
    shown = bound(F.regexp_replace(F.regexp_replace(seen, BREAK, " "), "<[^>]*>", ""), unescape)
    return F.when(c.contains("<") | c.contains("&"), strip_computed(shown)).otherwise(strip(c))


def _element(path: Path) -> str:
    """Pattern of the last element of the path, its inside captured up to the first closing tag."""
    return "(?s)" + ".*?".join(node.opening() for node in path) + rf"(.*?)</{path[-1].tag}>"


def inside(rest: Column, tag: str) -> Column:
    """What stands in an element, given the text behind its opening tag: up to its own closing tag.

    An element that is never closed reaches to the end.
    """

    def closed(rest: Column) -> Column:
        first = F.get(F.split(rest, rf"(?i)</{tag}(?=[\s>])", 2), F.lit(0))
        # Most elements hold no other one of their tag and end at the first closing tag.
        return bound(first, lambda first: F.when(first.rlike(rf"(?i)<{tag}(?=[\s>/])"), _balanced(rest, tag)).otherwise(first))

    return bound(rest, closed)


def _balanced(rest: Column, tag: str) -> Column:
    """The text cut before every tag of the name, and joined up to the piece that closes more than was opened."""
    cut = F.split(F.regexp_replace(rest, rf"(?i)<(?=/?{tag}(?=[\s>/]))", "\x01<"), "\x01")

    def step(state: Column, piece: Column) -> Column:
        depth = state["depth"] + F.when(F.startswith(piece, F.lit("</")), -1).otherwise(1)
        moved = F.struct(depth.alias("depth"), (state["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"))
        return F.when(state["depth"] > 0, moved).otherwise(state)

    def joined(pieces: Column) -> Column:
        begin = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("n"))
        end = F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), begin, step)
        return F.array_join(F.slice(pieces, F.lit(1), end["n"]), "")

    return F.transform(F.array(cut), joined)[0]


def _behind(html: Column, opening: str) -> Column:
    """Text behind the first match; empty without one."""
    return F.regexp_extract(html, f"(?s){opening}(.*)$", 1)


def fragment(html: Column, path: Path) -> Column:
    """Inside of the first such element, markup included; empty when there is none."""
    for node in path:
        html = inside(_behind(html, node.opening()), node.tag)
    return html


def fragments(html: Column, path: Path) -> Column:
    """Insides of all such elements, in page order."""
    cut = F.split(html, "(?s)" + ".*?".join(node.opening() for node in path))
    return F.transform(_behind_first(cut), lambda rest: inside(rest, path[-1].tag))


def first_text(html: Column, path: Path) -> Column:
    """Text of the first such element; null when there is none or it is empty."""
    return bound(bound(fragment(html, path), visible_text), none_if_empty)


def all_texts(html: Column, path: Path) -> Column:
    """Texts of all such elements, in page order, empty ones included."""
    return F.transform(fragments(html, path), visible_text)


def chunks(html: Column, node: Node) -> Column:
    """The page cut before each such element: one text per element, from its inside to the next one."""
    return _behind_first(F.split(html, node.opening()))


def _behind_first(cut: Column) -> Column:
    """The pieces of a cut text but the first."""
    return F.filter(cut, lambda piece, i: i > 0)


def section(html: Column, node: Node) -> Column:
    """Inside of the element whose attribute is just the node's word; null when absent or empty."""
    opening = rf'<{node.tag}(?=[\s>/])[^>]*\s{node.attr}="{node.word}"[^>]*>'
    return bound(inside(_behind(html, opening), node.tag), none_if_empty)


def labelled_fragment(scope: Column, label: str) -> Column:
    """Inside of the first ``dd`` that follows a ``dt`` holding the label; null without the label."""
    pattern = rf"(?s){DT.opening()}[^<]*{re.escape(label)}.*?{DD.opening()}(.*?)</dd>"
    # Plain search first: a scope without the label needs no matching.
    return F.when(scope.contains(label), F.regexp_extract(scope, pattern, 1))


def labelled_value(html: Column, label: str, where: Node | None = None) -> Column:
    """Normalised text of the first ``dd`` that follows a ``dt`` holding the label."""
    scope = section(html, where) if where else html
    found = bound(scope, lambda scope: labelled_fragment(scope, label))
    return bound(bound(bound(found, visible_text), normalize_text), none_if_empty)


def with_characteristics(
    pages: DataFrame, html: str = "html", out: str = "characteristics", container: Node | None = LISTING_PAGE.characteristic
) -> DataFrame:
    """Add the ``dt``/``dd`` pairs of the page as a map; a later pair wins over an earlier one of its key.

    Sorting each page's pairs by key and position puts the last value of a key at
    the end of its run, so a page of n pairs costs n log n, not n squared.
    """
    pairs = definition_pairs(F.col(html), container)
    sorted_pairs = pages.withColumn("_pairs", F.sort_array(pairs))

    def ends_run(p: Column, i: Column) -> Column:
        after = F.get(F.col("_pairs"), i + 1)
        return after.isNull() | (after["k"] != p["k"])

    last = sorted_pairs.withColumn("_pairs", F.filter("_pairs", ends_run))
    as_map = F.map_from_arrays(F.col("_pairs")["k"], F.col("_pairs")["v"])
    return last.withColumn(out, as_map).drop("_pairs")


def definition_pairs(html: Column, container: Node | None = None) -> Column:
    """``dt``/``dd`` pairs as structs (k, i, v): key, position, normalised value; non-empty ones only.

    With a container each of its elements gives its first pair; without one every
    ``dt`` directly followed by a ``dd`` counts.
    """
    if container:
        # Words are looked for from the left: greedily, each class would be read to its end and back.
        pair = _pair_behind(container.opening().replace("[^>]*\\s", "[^>]*?\\s").replace('="[^"]*', '="[^"]*?'))
    else:
        # Atomic groups end each part at its first closing tag.
        pair = rf"(?s){DT.opening()}(?>(.*?)</dt>)\s*{DD.opening()}(?>(.*?)</dd>)"

    def both(html: Column) -> Column:
        return F.arrays_zip(*[F.regexp_extract_all(html, F.lit(pair), F.lit(i)).alias(n) for i, n in ((1, "k"), (2, "v"))])

    found = bound(html, both)
    if container:
        # Some element holds no key, or not before its value: all are read one by one.
        found = bound(found, lambda found: F.when(F.exists(found, lambda e: e["k"] == ""), _pairs_one_by_one(html, container)).otherwise(found))
    # One step per transform: a lambda computes what it names as often as it names it.
    trimmed = F.transform(found, lambda e, i: F.struct(_clean(e["k"], visible_text, UNSHOWN).alias("k"), i.alias("i"), F.btrim(e["v"]).alias("v")))
    read = F.transform(trimmed, lambda e: F.struct(e["k"].alias("k"), e["i"].alias("i"), _clean(e["v"], lambda v: bound(visible_text(v), normalize_text), UNREAD).alias("v")))
    return F.filter(read, lambda e: (e["k"] != "") & (e["v"] != ""))


# What a text holds that is not just itself when shown, and when shown and normalised.
UNSHOWN = rf"[<&]|^[{BLANK_CLASS}]|[{BLANK_CLASS}]\z"
UNREAD = rf"[<&,;{UNCLEAN_CLASS}]|\x20\x20|^\x20|\x20\z"


def _clean(text: Column, reading: Callable[[Column], Column], unclean: str) -> Column:
    """``reading(text)``; one look spares it those texts, most of them, that it would leave as they are."""
    return F.when(text.rlike(unclean), reading(text)).otherwise(text)


def _pair_behind(opening: str) -> str:
    """Pattern of a container's opening tag and, captured, the insides of the ``dt`` and the ``dd`` behind it.

    Nothing but the opening tag is matched where either is missing before the next container, the ``dd`` comes first or begins in the ``dt``.
    Possessive loops need no recursion; blanks before the value are left out, as it is stripped anyway.
    """

    def up_to(tag: str) -> str:
        return rf"(?:[^<]+|<(?!{tag}|{opening.removeprefix('<')}))*+"

    dd = r"dd(?=[\s>/])"
    key = rf"<dt(?=[\s>/])[^<>]*>({up_to(f'/dt>|{dd}')})</dt>"
    value = rf"<{dd}[^<>]*>\s*({up_to('/dd>')})</dd>"
    return rf"(?s){opening}(?:{up_to(r'd[dt](?=[\s>/])')}{key}{up_to(dd)}{value})?+"


def _pairs_one_by_one(html: Column, container: Node) -> Column:
    """Insides of the first ``dt`` and the first ``dd`` of each container, wherever they stand."""
    return F.transform(
        chunks(html, container),
        lambda c: F.struct(F.regexp_extract(c, _element((DT,)), 1).alias("k"), F.regexp_extract(c, _element((DD,)), 1).alias("v")),
    )


def badge_fragments(html: Column, layout: PageLayout = LISTING_PAGE) -> Column:
    """Insides of the badges in the first list of badges."""
    return fragments(fragment(html, layout.badge_box), layout.badge)


def badges(html: Column, layout: PageLayout = LISTING_PAGE) -> Column:
    """Non-empty normalised badge texts, in page order."""
    texts = F.transform(badge_fragments(html, layout), visible_text)
    return F.filter(F.transform(texts, normalize_text), lambda b: b != "")


def location_fragments(html: Column, layout: PageLayout = LISTING_PAGE) -> Column:
    """Insides of the location parts in every box that names the place."""
    return F.flatten(F.transform(fragments(html, (layout.location_box,)), lambda box: fragments(box, layout.location)))


def energy_attr(html: Column, attr: str = LISTING_PAGE.energy_attr) -> Column:
    """Value of the energy attribute, stripped and upper-cased; null when empty or absent."""
    return bound(F.upper(strip_computed(F.regexp_extract(html, rf'<span[^>]*\s{attr}="([^"]*)"', 1))), none_if_empty)


def luxury_flag(html: Column, layout: PageLayout = LISTING_PAGE) -> Column:
    """True when the icon stands in an item of the main features and the word in any span of the page, else null - never false."""
    icon = rf'(?s)<svg(?=[\s>]).*?<use[^>]*\shref="{re.escape(layout.luxury_icon)}"'
    word = rf"<span(?=[\s>])[^>]*>[^<]*{LUXURY_WORD}"
    shown = F.exists(fragments(html, (layout.features,)), lambda item: item.rlike(icon))
    # Plain search first: few pages show the icon at all.
    return F.when(html.contains(layout.luxury_icon), F.when(html.rlike(word) & shown, True))


def is_auction(text: Column) -> Column:
    """Auctions show a lowest bid."""
    return F.lower(text).contains("da €")
