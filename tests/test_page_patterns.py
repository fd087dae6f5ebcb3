"""Boxes and pairs of a page read by patterns, against the element table and the reading of pairs one by one."""

import random
import re

from conftest import SMALL
from pyspark.sql import functions as F

from mattone.functions import elements as E
from mattone.functions import html as H
from mattone.operators import harvest
from mattone.plans import fixtures as X

LAYOUT = H.LISTING_PAGE
WORDS = [
    LAYOUT.title[0], LAYOUT.price[0], LAYOUT.location_box, LAYOUT.location[0], *LAYOUT.description_title, LAYOUT.description_text[0],
    *LAYOUT.update, *LAYOUT.badge_box, *LAYOUT.badge, LAYOUT.features, LAYOUT.description, LAYOUT.costs, LAYOUT.characteristic,
]


def odd_pages(spark, n):
    """Saved pages as they are, and with tags put in, left out, repeated or cut short."""
    rng = random.Random(7)
    saved = [r.html for r in X.listing_pages(spark, SMALL).orderBy("k").limit(30).collect()]

    def snippet():
        tag, node = rng.choice(["div", "span", "li", "p", "button", "DIV", "dt", "dd"]), rng.choice(WORDS)
        attr = rng.choice(["", f' {node.attr}="{node.word}"', f' {node.attr}="x>y {node.word} z"', f" x='{'q' * 1200}' {node.attr}=\"{node.word}\""])
        return rng.choice([f"<{tag}{attr}>", f"</{tag}>", f"<{tag}{attr}/>", f"<{tag}{attr}>t&amp; u</{tag}>", f"<{tag}{attr}", node.word, "<div>" * 14 + "z" + "</div>" * 14])

    rows = [(-2, None), (-1, "")]
    for k in range(n):
        html = rng.choice(saved)
        for _ in range(rng.choice([0, 1, 2, 6])):
            at = rng.choice([m.start() for m in re.finditer("[<>]", html)])
            html = html[:at] + rng.choice([snippet(), snippet(), "", html[at : at + 90]]) + html[at + rng.choice([0, 0, 20]) :]
        rows.append((k, html))
    return spark.createDataFrame(rows, "k int, html string").repartition(8).cache()


def test_patterns_read_what_the_element_table_reads(spark):
    pages = odd_pages(spark, 240)
    fields = harvest.page_fragments(LAYOUT)
    table = harvest.with_boxes(E.with_elements(pages, "html", LAYOUT.box_tags()), LAYOUT).select("k", *[c.alias(n) for n, c in fields.items()])
    expected = {r.k: r for r in table.collect()}
    read = harvest.with_insides(pages, "html", LAYOUT).select("k", "_odd", *fields).collect()
    sure = [r for r in read if not r._odd]
    assert 100 < len(sure) < len(read)
    shown = {r.k: r.html and "#diamond" in r.html for r in pages.collect()}
    for r in sure:
        want = expected[r.k]
        assert all(r[c] == want[c] for c in fields if c not in ("_shown", "badges")), r.k
        assert [b for b in r.badges if b] == [b for b in want.badges if b] and (not shown[r.k] or r._shown == want._shown)


def test_ordinary_pages_need_no_element_table(spark):
    pages = X.listing_pages(spark, SMALL).select("k", "html")
    assert harvest.with_insides(pages, "html", LAYOUT).where("_odd").count() == 0


def test_odd_pages_read_as_their_element_table(spark):
    """A title never closed, a price in the fourteenth div, a value that holds a bracket."""
    title, price, place = '<h1 class="styles_ld-title__title__Ww2Gb">', '<div class="Price_price__mzj0D">', '<button class="styles_ld-blockTitle__link__paCwh"><span class="{}styles_ld-blockTitle__location__n2mZJ">Milano</span></button>'
    rows = [(1, place.format("") + f"{price}<span>€ 1</span></div>{title}Casa"), (2, place.format("a>b ") + price + "<div>" * 14 + "<span>€ 2</span>" + "</div>" * 15 + title + "Casa</h1>")]
    found = harvest.read_listing_pages(spark.createDataFrame(rows, "k int, html string"))
    assert [(r.page_title, r.price_text, r.location_parts) for r in found.orderBy("k").collect()] == [("Casa", "€ 1", ["Milano"]), ("Casa", "€ 2", ['b styles_ld-blockTitle__location__n2mZJ">Milano'])]


def test_pairs_of_containers_read_at_once_and_one_by_one(spark):
    pages = odd_pages(spark, 240).where("html is not null")
    node = LAYOUT.characteristic
    at_once = H.definition_pairs(F.col("html"), node).alias("pairs")
    each = H._pairs_one_by_one(F.col("html"), node)
    shown = F.transform(each, lambda e, i: F.struct(H.visible_text(e["k"]).alias("k"), i.alias("i"), H.normalize_text(H.visible_text(e["v"])).alias("v")))
    rows = pages.select(at_once, F.filter(shown, lambda e: (e["k"] != "") & (e["v"] != "")).alias("each")).collect()
    assert len(rows) == 241 and all(r.pairs == r.each for r in rows)
