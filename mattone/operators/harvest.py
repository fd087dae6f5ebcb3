"""Saved pages in, listing ids and raw page fields out."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.functions import elements as E
from mattone.functions import html as H
from mattone.functions.numbers import last_update
from mattone.functions.text import bound, is_blank, listing_key, none_if_empty, normalize_text, strip
from mattone.functions.urls import listing_id

SOURCE = "immobiliare"


def harvest_cards(
    pages: DataFrame, layout: H.CardLayout = H.RESULT_CARD, source: str = SOURCE, html: str = "html"
) -> DataFrame:
    """One row per listing card of each page, with the reason it is skipped or null.

    A card ends where its element does, or at the next card.  The checks run in
    order - link, title, id, auction - and the first that fails names the reason.
    """
    keep = [c for c in pages.columns if c != html]
    cards = pages.select(*keep, F.posexplode(H.chunks(F.col(html), layout.card)).alias("position", "_rest"))
    anchor = rf'(?s)<a(?=\s)[^>]*\shref="[^"]*{re.escape(layout.href_word)}[^"]*"[^>]*>.*?</a>'
    # Cut, match and read in steps that name finished columns.
    cut = cards.select(*keep, "position", H.inside(F.col("_rest"), layout.card.tag).alias("_card"))
    matched = cut.withColumn("_anchor", F.regexp_extract("_card", anchor, 0))

    def attribute(name: str) -> Column:
        return bound(bound(F.regexp_extract("_anchor", rf'^<a[^>]*\s{name}="([^"]*)"', 1), H.unescape), none_if_empty)

    read = matched.select(
        *keep,
        "position",
        attribute("href").alias("link"),
        F.coalesce(attribute("title"), bound(H.visible_text(F.col("_anchor")), none_if_empty)).alias("title"),
        H.is_auction(H.visible_text(F.col("_card"))).alias("auction"),
    )
    source_id = listing_id(F.col("link"))
    reason = (
        F.when(F.col("link").isNull(), "no_link")
        .when(F.col("title").isNull(), "no_title")
        .when(source_id.isNull(), "no_id")
        .when(F.col("auction"), "auction")
    )
    return read.select(
        *keep,
        "position",
        "link",
        "title",
        F.lit(source).alias("source"),
        source_id.alias("source_id"),
        reason.alias("skip_reason"),
    )


def ids_of(cards: DataFrame, as_of: Column, keep: list[str] | None = None) -> DataFrame:
    """``ids`` rows of the cards that are not skipped, with the columns to keep for ordering them."""
    return cards.where(F.col("skip_reason").isNull()).select(
        *(keep or []),
        "source",
        "source_id",
        strip(F.col("title")).alias("title"),
        F.col("link").alias("url"),
        as_of.alias("fetch_date"),
        listing_key(F.col("source"), F.col("source_id")).alias("id"),
    )


# Texts of a listing page that become one normalised line.
ONE_LINE = ("description", "description_title", "fee_text", "price_sqm_text")


def with_boxes(pages: DataFrame, layout: H.PageLayout) -> DataFrame:
    """The elements that hold the fields, each once: outer ones first, then those inside them.

    Reads the columns of ``with_elements``; the two projections name finished columns, so nothing is looked up twice.
    """
    outer = {
        "_title": E.first(layout.title[0]),
        "_price_box": E.first(layout.price[0]),
        "_update_box": E.first(layout.update[0]),
        "_badge_outer": E.first(layout.badge_box[0]),
        "_description": E.first(layout.description, whole=True),
        "_costs": E.first(layout.costs, whole=True),
        "_price_info": E.first(layout.price_info, whole=True),
        "_features": E.select(layout.features),
        "_boxes": E.select(layout.location_box),
        "_heading": E.select(layout.description_title[0]),
        "_text_box": E.select(layout.description_text[0]),
    }
    found = pages.withColumns(outer)

    def inner(node: H.Node, box: str) -> Column:
        return F.get(E.within(E.select(node), F.col(box)), F.lit(0))

    found = found.withColumns(
        {
            "_price": inner(layout.price[1], "_price_box"),
            "_update": inner(layout.update[1], "_update_box"),
            "_badge_list": inner(layout.badge_box[1], "_badge_outer"),
            "_heading": F.get(E.within(F.col("_heading"), F.col("_description")), F.lit(0)),
            "_text_box": F.get(E.within(F.col("_text_box"), F.col("_description")), F.lit(0)),
            "_places": E.within_any(E.select(layout.location[0]), F.col("_boxes")),
        }
    )
    found = found.withColumns({"_text": inner(layout.description_text[1], "_text_box"), "_items": E.within(E.select(layout.badge[0]), F.col("_badge_list")), "_labels": E.select(layout.badge[1])})
    # The first label of each item.
    first = F.transform("_items", lambda item: F.get(E.within(F.col("_labels"), item), F.lit(0)))
    return found.withColumn("_labels", F.filter(first, lambda e: e.isNotNull()))


def page_fragments(layout: H.PageLayout) -> dict[str, Column]:
    """Markup around each field that stands in a box, from the columns of ``with_boxes``."""
    return {
        "page_title": E.inside(F.col("_title")),
        "price_text": E.inside(F.col("_price")),
        "location_parts": F.transform("_places", lambda e: E.inside(e)),
        "description_title": E.inside(F.col("_heading")),
        "description": E.inside(F.col("_text")),
        "update_text": E.inside(F.col("_update")),
        "badges": F.transform("_labels", lambda e: E.inside(e)),
        "_costs_html": E.inside(F.col("_costs")),
        "_price_html": E.inside(F.col("_price_info")),
        "_shown": F.exists("_features", lambda e: E.inside(e).rlike(_icon(layout))),
    }


def _icon(layout: H.PageLayout) -> str:
    return rf'(?s)<svg(?=[\s>]).*?<use[^>]*\shref="{re.escape(layout.luxury_icon)}"'


# Columns of ``with_insides`` that hold a field's markup, and those that hold the boxes around them; lists of either.
IN_BOXES = {"price_text": "_price_box", "update_text": "_update_box", "_badge_list": "_badge_outer", "description_title": "_description", "_text_box": "_description", "description": "_text_box"}
ON_PAGES = ("page_title", "_price_box", "_update_box", "_badge_outer", "_description", "_costs_html", "_price_html")


def with_insides(pages: DataFrame, html: str, layout: H.PageLayout) -> DataFrame:
    """The columns of ``page_fragments``, read by patterns, and ``_odd``: whether a box of the page is not closed where it should be.

    Each box is searched in the one around it, so only the outer ones cost a look at the whole page.  What was read of an odd page does not hold.
    """
    whole = F.coalesce(html, F.lit(""))
    # Plain search first: few pages show the icon at all.
    outer = {
        "page_title": E.first_inside(whole, layout.title[0]),
        "_price_box": E.first_inside(whole, layout.price[0]),
        "_update_box": E.first_inside(whole, layout.update[0]),
        "_badge_outer": E.first_inside(whole, layout.badge_box[0]),
        "_description": E.first_inside(whole, layout.description, whole=True),
        "_costs_html": E.first_inside(whole, layout.costs, whole=True),
        "_price_html": E.first_inside(whole, layout.price_info, whole=True),
        "_features": F.when(whole.contains(layout.luxury_icon), E.insides(whole, layout.features, nested=False)),
        "_boxes": E.insides(whole, layout.location_box, nested=False),
    }
    found = pages.withColumns(outer)

    def inner(node: H.Node, name: str) -> Column:
        return E.first_inside(F.col(IN_BOXES[name]), node)

    found = found.withColumns(
        {
            "price_text": inner(layout.price[1], "price_text"),
            "update_text": inner(layout.update[1], "update_text"),
            "_badge_list": inner(layout.badge_box[1], "_badge_list"),
            "description_title": inner(layout.description_title[0], "description_title"),
            "_text_box": inner(layout.description_text[0], "_text_box"),
            "_places": F.transform("_boxes", lambda box: E.insides(box, layout.location[0])),
        }
    )
    found = found.withColumns({"description": inner(layout.description_text[1], "description"), "_items": E.insides(F.col("_badge_list"), layout.badge[0])})
    found = found.withColumn("badges", F.transform("_items", lambda item: E.first_inside(item, layout.badge[1])))
    places = F.exists(F.arrays_zip(F.col("_boxes").alias("box"), F.col("_places").alias("places")), lambda b: F.exists(b["places"], lambda place: E.open_ended(b["box"], place)))
    odd = [
        *[E.open_ended(whole, F.col(c)) for c in ON_PAGES],
        *[F.exists(c, lambda box: E.open_ended(whole, box)) for c in ("_features", "_boxes")],
        *[E.open_ended(F.col(box), F.col(c)) for c, box in IN_BOXES.items()],
        places,
        F.exists("_items", lambda item: E.open_ended(F.col("_badge_list"), item)),
        F.exists(F.arrays_zip(F.col("_items").alias("item"), F.col("badges").alias("label")), lambda i: E.open_ended(i["item"], i["label"])),
    ]
    return found.withColumns(
        {
            "location_parts": F.flatten("_places"),
            "_shown": F.exists("_features", lambda item: item.rlike(_icon(layout))),
            "_odd": reduce(or_, [F.coalesce(o, F.lit(False)) for o in odd]),
        }
    )


def page_problem() -> Column:
    """Why a page cannot become a listing, or null; reads the columns of ``read_listing_pages``."""
    return (
        F.when(F.col("page_title").isNull(), "no_title")
        .when(is_blank(F.col("price_text")), "no_price")
        .when(F.size("location_parts") == 0, "no_location")
    )


def read_listing_pages(pages: DataFrame, html: str = "html", layout: H.PageLayout = H.LISTING_PAGE) -> DataFrame:
    """Listing pages to raw fields: the input of ``build_details``, in narrow steps without a shuffle.

    Elements, boxes, markup, visible text and normalised text are projections of their own, so that
    each step names a finished column instead of computing it anew.
    """
    keep = [c for c in pages.columns if c != html]
    mapped = H.with_characteristics(pages, html, "characteristics", layout.characteristic)
    read = with_insides(mapped, html, layout)
    # The table of an odd page's elements settles what patterns can not; it is empty for all others.
    fields = [*page_fragments(layout)]
    patterned = read.select(*keep, html, "characteristics", "_odd", *[F.col(c).alias(f"_read_{c}") for c in fields]).withColumn("_odd_html", F.when(F.col("_odd"), F.col(html)))
    boxes = with_boxes(E.with_elements(patterned, "_odd_html", layout.box_tags()), layout)
    marked = {c: F.when(F.col("_odd"), of_table).otherwise(F.col(f"_read_{c}")) for c, of_table in page_fragments(layout).items()}
    sections = boxes.select(*keep, html, "characteristics", *[c.alias(n) for n, c in marked.items()])
    word = rf"(?:\A|<)span(?=[\s>])[^<>]*>[^<]*{H.LUXURY_WORD}"
    # Plain search first: few pages show the icon at all.
    rest = {
        "energy_text": H.energy_attr(F.col(html), layout.energy_attr),
        "fee_text": H.labelled_fragment(none_if_empty(F.col("_costs_html")), H.FEE_LABEL),
        "price_sqm_text": H.labelled_fragment(none_if_empty(F.col("_price_html")), H.SQM_LABEL),
        "luxury": F.when(F.col(html).contains(layout.luxury_icon), F.when(F.col("_shown") & F.col(html).rlike(word), True)),
    }
    found = sections.select(*keep, "characteristics", *[c for c in fields if not c.startswith("_")], *[c.alias(n) for n, c in rest.items()])
    plain = ("page_title", "price_text", "update_text", *ONE_LINE)
    shown = found.withColumns(
        {c: H.visible_text(F.col(c)) for c in plain}
        | {c: F.transform(c, H.visible_text) for c in ("location_parts", "badges")}
    )
    lines = shown.withColumns(
        {c: none_if_empty(F.col(c)) for c in plain if c not in ONE_LINE}
        | {c: bound(normalize_text(F.col(c)), none_if_empty) for c in ONE_LINE}
        | {"badges": F.filter(F.transform("badges", normalize_text), lambda b: b != "")}
    )
    return lines.withColumns(
        {
            # Without a description text the heading is not read either.
            "description_title": F.when(F.col("description").isNotNull(), F.col("description_title")),
            "description": F.coalesce("description", F.lit("")),
            "last_updated": last_update(F.col("update_text")),
            "page_problem": page_problem(),
        }
    )
