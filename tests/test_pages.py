"""Cards, listing pages and crawl gates."""

import pytest
from pyspark.sql import functions as F

from mattone.functions import elements as E
from mattone.functions import html as H
from mattone.operators import crawl, details, harvest
from mattone.plans import fixtures as X

CARD = '<li><div class="x styles_in-listingCardPropertyContent__tfu8w y">{}</div></li>'
URL = "https://www.immobiliare.it/annunci/{}/"


def cards(spark, *inner):
    page = spark.createDataFrame([(1, "<ul>" + "".join(CARD.format(i) for i in inner) + "</ul> da € 1")], "page_id int, html string")
    rows = harvest.harvest_cards(page).orderBy("position").collect()
    return [(r.source_id, r.title, r.skip_reason) for r in rows]


def test_cards(spark):
    found = cards(
        spark,
        f'<a href="{URL.format(1)}" title="Uno &amp; due">testo</a>',
        f'<a class="k"\nhref="{URL.format(2)}"> Tre\n</a><p>DA € 100</p>',
        f'<a href="{URL.format(3)}"> </a>',
        '<a href="https://altro.it/1">no</a>',
        '<a href="https://www.immobiliare.it/annunci/x/">vendita</a>',
        "<p>vuoto</p>",
        f'<a href="{URL.format(4)}" title=""><b>Quattro</b></a>',
        f'<a href="{URL.format(5)}">Cinque</a><ul><li>x</li></ul><div><div>y</div></div><p>Da € 5</p>',
    )
    assert found == [
        ("1", "Uno & due", None),
        ("2", "Tre", "auction"),
        ("3", None, "no_title"),
        (None, None, "no_link"),
        (None, "vendita", "no_id"),
        (None, None, "no_link"),
        ("4", "Quattro", None),
        ("5", "Cinque", "auction"),
    ]


def test_a_page_without_cards(spark):
    assert cards(spark) == []


def one(spark, html, fn):
    return spark.createDataFrame([(html,)], "html string").select(fn(F.col("html")).alias("r")).first().r


def test_labelled_value_stays_in_its_section(spark):
    html = (
        '<div data-tracking-key="costs"><dl><dt>Prezzo</dt><dd>1</dd><dt>Spese condominio</dt><dd> € 70/mese,\n circa</dd></dl></div>'
        '<div data-tracking-key="price-information"><dt>Prezzo al m²</dt><dd><b>3.558</b> &euro;/m&sup2;</dd></div>'
    )
    assert one(spark, html, lambda c: H.labelled_value(c, H.FEE_LABEL, H.LISTING_PAGE.costs)) == "€ 70/mese. circa"
    assert one(spark, html, lambda c: H.labelled_value(c, H.SQM_LABEL, H.LISTING_PAGE.price_info)) == "3.558 €/m²"
    assert one(spark, html, lambda c: H.labelled_value(c, H.SQM_LABEL, H.LISTING_PAGE.costs)) is None
    assert one(spark, "<p></p>", lambda c: H.labelled_value(c, H.SQM_LABEL, H.LISTING_PAGE.costs)) is None


@pytest.mark.parametrize("container", [None, H.Node("div", "class", "f")])
def test_later_pairs_win(spark, container):
    pair = '<div class="f"><dt>{}</dt> <dd>{}</dd></div>'
    html = "".join(pair.format(*p) for p in [("a", "1"), ("b", " "), ("c", "x, y"), ("a", "2"), ("d", "<i>z</i>")])
    pages = spark.createDataFrame([(1, html), (2, "")], "k int, html string")
    found = H.with_characteristics(pages, container=container).orderBy("k").collect()
    assert [r.characteristics for r in found] == [{"a": "2", "c": "x. y", "d": "z"}, {}]


def test_many_pairs_on_one_page(spark):
    html = "".join(f"<dt>k{i % 5000}</dt><dd>{i}</dd>" for i in range(40000))
    page = spark.createDataFrame([(html,)], "html string")
    found = H.with_characteristics(page, container=None).first().characteristics
    assert found == {f"k{i}": str(35000 + i) for i in range(5000)}


def test_a_long_page_does_not_exhaust_the_matcher(spark):
    html = '<h1 class="styles_ld-title__title__Ww2Gb">' + "x y " * 500_000 + "</h1>"
    assert len(one(spark, html, lambda c: H.first_text(c, H.LISTING_PAGE.title))) == 1_999_999


def test_flags_and_attributes(spark):
    lux = '<div class="styles_ld-mainFeatures__item"><svg><use href="#diamond"></use></svg><span>Lusso</span></div>'
    assert one(spark, lux, H.luxury_flag) is True
    assert one(spark, lux.replace("#diamond", "#x"), H.luxury_flag) is None
    assert one(spark, '<span data-energy-class=" a+ "></span>', H.energy_attr) == "A+"
    assert one(spark, '<span data-energy-class=""></span>', H.energy_attr) is None
    footer = '<footer><svg><use href="#diamond"></use></svg><span>Lusso</span></footer>'
    assert one(spark, '<div class="styles_ld-mainFeatures__item">x</div>' + footer, H.luxury_flag) is None
    badge = '<li class="styles_ld-featuresBadges__badge___8QgZ"><span class="nd-badge">{}</span></li>'
    box = '<div class="styles_ld-featuresBadges__mJqLG"><ul class="styles_ld-featuresBadges__list__MGuKy">{}</ul></div>'
    inner = badge.format("A, b") + badge.format(" ") + badge.format("C")
    assert one(spark, badge.format("fuori") + box.format(inner) + badge.format("fuori"), H.badges) == ["A. b", "C"]
    assert one(spark, inner, H.badges) == []


@pytest.mark.parametrize(
    "rest, expected",
    [
        ("a</div>b", "a"),
        ("a<div>b</div>c</div>d</div>", "a<div>b</div>c"),
        ("<div><div></div></div>x</DIV >y", "<div><div></div></div>x"),
        ("a<divider>b</divider></div>c", "a<divider>b</divider>"),
        ("a<div>b</div>c", "a<div>b</div>c"),
        ("never closed", "never closed"),
        ("", ""),
    ],
)
def test_inside(spark, rest, expected):
    assert one(spark, rest, lambda c: H.inside(c, "div")) == expected


def test_visible_text(spark):
    assert one(spark, "prima<br>seconda <div>interno</div> <b>do</b>po<script>x</script><!-- n -->", lambda c: H.normalize_text(H.visible_text(c))) == "prima seconda interno dopo"


def test_location_parts_stand_in_their_box(spark):
    span = '<span class="styles_ld-blockTitle__location__n2mZJ">{}</span>'
    page = span.format("fuori") + '<button class="styles_ld-blockTitle__link__paCwh">' + span.format("Milano") + span.format("Via") + "</button>" + span.format("fuori")
    assert one(spark, page, H.location_fragments) == ["Milano", "Via"]


def test_raw_rows_are_rejected_with_the_first_reason(spark):
    good = {"Tipologia": "Loft", "Contratto": "Vendita", "Superficie": "35 m²"}
    base = dict(price_text="€ 1.000", location_parts=["Milano"], description="x", characteristics=good, url=URL.format(1))
    cases = [
        ({}, None),
        ({"url": "http://altrove/1"}, "url_prefix"),
        ({"price_text": " "}, "no_price"),
        ({"location_parts": []}, "no_location"),
        ({"location_parts": None, "description": ""}, "no_location"),
        ({"description": "\xa0"}, "no_description"),
        ({"characteristics": {}}, "no_characteristics"),
        ({"characteristics": {**good, "Contratto": ""}}, "no_contratto"),
        ({"characteristics": {k: v for k, v in good.items() if k != "Tipologia"}}, "no_tipologia"),
        ({"price_text": "€ 1,5"}, "bad_price"),
        ({"price_text": "€ -5"}, "price_eur_negative"),
        ({"characteristics": {**good, "Superficie": "0 m²"}}, "bad_surface"),
        ({"characteristics": {**good, "Superficie": "35 mq"}}, "bad_surface"),
        ({"characteristics": {**good, "Anno di costruzione": "1500"}}, "build_year_out_of_range"),
        ({"characteristics": {**good, "Tipologia": " "}}, "type_empty"),
    ]
    rows = [
        (str(i), "s", "t", r["url"], r["price_text"], None, None, None, None, None, r["description"], r["location_parts"], [], None, r["characteristics"])
        for i, r in enumerate({**base, **change} for change, _ in cases)
    ]
    raw = spark.createDataFrame(
        rows,
        "id string, source string, title string, url string, price_text string, price_sqm_text string, fee_text string, "
        "last_updated timestamp, energy_text string, description_title string, description string, "
        "location_parts array<string>, badges array<string>, luxury boolean, characteristics map<string,string>",
    )
    built = {r.id: r.reject_reason for r in details.build_details(raw, X.fetched_at()).collect()}
    assert [built[str(i)] for i in range(len(cases))] == [reason for _, reason in cases]


def gate(spark, pages, **rule):
    rows = [(1, page, scraped, inserted) for page, scraped, inserted in pages]
    found = crawl.crawl_gate(spark.createDataFrame(rows, "crawl_id int, page long, scraped long, inserted long"), **rule)
    return [(r.page, r.stop_reason) for r in found.orderBy("page").collect()]


def test_crawl_gate(spark):
    assert gate(spark, [(1, 10, 10), (2, 10, 0), (3, 10, 0), (4, 10, 0), (5, 10, 9)]) == [(1, None), (2, None), (3, None), (4, "low_success")]
    assert gate(spark, [(1, 0, 0), (2, 10, 10)]) == [(1, "low_success")]
    assert gate(spark, [(5, 10, 10), (6, 10, 10)], listing_limit=20) == [(5, None), (6, "listing_limit")]
    whole = [(i, 1, 1) for i in range(1, 200)]
    assert gate(spark, whole)[-1] == (81, "max_pages") and len(gate(spark, whole)) == 81
    assert gate(spark, [(1, 1, 1), (2, 1, 1), (500, 1, 1), (501, 1, 1)])[-1] == (500, "max_pages")
    assert gate(spark, [(1, 5, 5)]) == [(1, "no_next_page")]
    twice = [(i, 1, 1) for i in range(1, 101)] * 2
    assert gate(spark, twice, max_pages=40)[-1] == (41, "max_pages") and len(gate(spark, twice, max_pages=40)) == 41


def test_crawl_gate_moves(spark):
    """A crawl ends where it has no next page, or comes back to the page it is on."""
    shape = "crawl_id int, page long, scraped long, inserted long, to long"
    rows = [(1, 1, 1, 1, 2), (1, 2, 1, 1, 2), (1, 3, 1, 1, 4), (2, 1, 1, 1, None), (2, 2, 1, 1, 3)]
    found = crawl.crawl_gate(spark.createDataFrame(rows, shape), next_page="to").orderBy("crawl_id", "page").collect()
    assert [(r.crawl_id, r.page, r.stop_reason) for r in found] == [(1, 1, None), (1, 2, "page_unchanged"), (2, 1, "no_next_page")]


def test_a_visible_text_stays_a_short_expression(spark):
    """Its steps are bound: unbound, one such text was a hundred thousand characters of every plan that holds it."""
    shown = spark.range(1).select(F.lit("<b>a&amp;b &#8364; &eacute;</b>").alias("html")).hint("merge").repartition(1).select(H.visible_text(F.col("html")).alias("r"))
    assert shown.first().r == "a&b € é"
    assert shown._jdf.queryExecution().analyzed().toString().count("regexp_") < 30


def test_each_argument_is_computed_once(spark):
    html = F.concat(F.col("html"), F.lit(""))
    page = spark.createDataFrame([("",)], "html string")
    plan = page.select(H.labelled_value(html, H.FEE_LABEL, H.LISTING_PAGE.costs).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("data-tracking-key") == 1


def test_elements_of_some_tags_are_those_of_the_whole_table(spark):
    html = '<p>a<div class="x"><dt>k</dt><p/><P class="y">b<div>c</div></p><pre>d</pre></div><br><p\n>e'
    page = spark.createDataFrame([(html,)], "html string")
    every, some = (E.with_elements(page, only=only).first().elements for only in (None, ["div", "p"]))
    assert [(e.begin, e.end, e.tag) for e in some] == [(e.begin, e.end, e.tag) for e in every if e.tag in ("div", "p")]
