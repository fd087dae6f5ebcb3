"""Edge rows of every text reading."""

import html
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from mattone.functions import html as H
from mattone.functions import numbers as N
from mattone.functions import text as T
from mattone.functions import urls as U


def test_normalize_text(read):
    given = ["  a\n\tb ", "a,b;c", "a\xa0b", None, "a\x07b", "a\x1fb", "", " x  y　"]
    assert read(T.normalize_text, given) == ["a b", "a.b.c", "a b", "", "ab", "a b", "", "x y"]


def test_strip_every_blank(read):
    assert read(T.strip, ["\xa0 a\x85", "\x1fa b ", "a", "", None, " "]) == ["a", "a b", "a", "", None, ""]
    assert read(T.is_blank, ["\xa0 ", "", None, "a", " a"]) == [True, True, True, False, False]


def test_parse_price(read):
    given = ["€ 300.000", "€\xa0950", "€ 1.000,50", "da € 100", "", "€ 1e3", "€ -5", None]
    assert read(N.parse_price, given) == [300000.0, 950.0, None, None, None, 1000.0, -5.0, None]


def test_parse_price_sqm(read):
    given = ["3.558 €/m²", "3.558,50 €/m²", "3.558.50 €/m²", "3558 €/m²", "3.558 €", None]
    assert read(N.parse_price_sqm, given) == [
        ("3.558 EUR/sqm", 3558.0),
        ("3.558,50 EUR/sqm", 3558.5),
        ("3.558.50 EUR/sqm", 3558.0),
        ("3558 EUR/sqm", 355.0),
        (None, None),
        (None, None),
    ]


def test_parse_monthly_fee(read):
    given = ["€ 70/mese", "€ 1.200/mese", "€ 600/anno", "€ 80", "Nessuna", None, "€ 24 per year", "120 anno o mese"]
    assert [v for _, v in read(N.parse_monthly_fee, given)] == [70.0, 1.0, 50.0, 80.0, None, None, 2.0, 120.0]


def test_parse_surface(read):
    given = ["35 m²", "35.5 m²", "1.200 m²", "35 mq", "0 m²", "m²"]
    assert read(N.parse_surface_int, given) == [
        ("35 sqm", 35.0),
        ("35.5 sqm", 35.0),
        ("1.200 sqm", 1.0),
        (None, None),
        ("0 sqm", 0.0),
        (None, None),
    ]
    given = ["35 m²", "35.5 sqm", "35,5 m²", "1.200 sqm", "abc m²", "35", " 7 sqm "]
    assert read(N.parse_surface_decimal, given) == [35.0, 35.5, 35.5, 1.2, None, None, 7.0]


def test_parse_first_int(read):
    assert read(N.parse_first_int, ["3+", "5 (2 camere)", "molti", None]) == [3, 5, None, None]


def test_parse_yes_no(read):
    given = ["Sì", "si", "No", "Nessuno", "No. classico", "boh", None, "YES"]
    assert read(N.parse_yes_no, given) == [True, True, False, False, True, None, None, True]


def test_parse_concierge(read):
    assert read(N.parse_concierge, ["Portiere mezza giornata", "No", None, ""]) == [True, False, None, None]


def test_parse_energy_class(read):
    assert read(N.parse_energy_class, ["A+", "A4", "AP", "H", None]) == ["A+", "A4", None, None, None]


def test_last_update(read):
    given = ["aggiornato il 5/3/2025", "31/02/2025", "ieri", "1/1/0000", "5/8/2025 poi 6/8/2025", None]
    seconds = read(lambda c: F.unix_seconds(N.last_update(c)), given)
    march = int(datetime(2025, 3, 4, 23, tzinfo=timezone.utc).timestamp())
    august = int(datetime(2025, 8, 4, 22, tzinfo=timezone.utc).timestamp())
    assert seconds == [march, None, None, None, august, None]


def test_urls(read):
    base = "https://www.immobiliare.it/annunci/"
    assert read(U.listing_id, [base + "122443460/", base + "12", base + "12/x", " " + base + "7/ "]) == ["122443460", "12", None, "7"]
    assert read(U.page_number, ["https://x/?pag=7", "https://x/?a=1", "https://x/?zpag=3&pag=4"]) == [7, 1, 3]
    assert read(U.last_segment, [base + "5/", "a", "//a/b//"]) == ["5", "a", "b"]


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://x/p?z=1&z=2&criterio=x", "https://x/p?z=1&criterio=data&ordine=desc&noAste=1"),
        ("https://x/p", "https://x/p?criterio=data&ordine=desc&noAste=1"),
        ("https://x/p?m[]=a&m[]=b&e=&=v&&f#top", "https://x/p?m%5B%5D=a&e=&=v&f=&criterio=data&ordine=desc&noAste=1#top"),
        ("https://x/p?q=a%20b+c~*%zz", "https://x/p?q=a+b+c~%2A%25zz&criterio=data&ordine=desc&noAste=1"),
    ],
)
def test_override_params(read, url, expected):
    assert read(U.override_params, [url]) == [expected]
    from urllib.parse import parse_qs, urlencode, urlsplit, urlunsplit

    parts = urlsplit(url)
    merged = parse_qs(parts.query, keep_blank_values=True)
    for extra in (U.SORT_PARAMS, U.FILTER_PARAMS):
        merged.update(parse_qs(extra, keep_blank_values=True))
    query = urlencode({k: v[0] for k, v in merged.items()})
    assert urlunsplit(parts._replace(query=query)) == expected


def test_override_without_parameters(read):
    assert read(lambda c: U.override_params(c, None, None), ["https://x/p#f", "https://x/p?"]) == ["https://x/p#f", "https://x/p"]


def test_split(read):
    assert read(lambda c: T.split_composite(c, "|"), ["a | b|| c ", " ", None, "|"]) == [["a", "b", "c"], [], [], []]
    assert read(T.split_composite, ["a | b|c"]) == [["a", "b|c"]]
    given = ["Milano/Navigli/Via A", "Milano", "Milano//Via A", "Milano/ /", "M/Z/V/9"]
    assert read(T.split_address, given) == [("Navigli", "Via A"), (None, None), (None, "Via A"), (None, None), ("Z", "V")]


def test_is_auction(read):
    assert read(H.is_auction, ["Da € 100", "€ 100", None]) == [True, False, None]


def test_character_references(spark):
    """Named and numeric references as the standard library reads them, in one pass."""
    texts = [
        "5 &euro; &#8364; &#x20AC; &#X20ac; &#0008364;", "&Egrave; &deg; &hellip; &frac12;", "&amp;lt; &amp;amp;#39; &lt;b&gt;", "it&#39s &#39;", "a & b && &; &# &#; &#x; &nosuch; &",
        "&#128; &#x9F; &#150;", "&#0; &#xD800; &#1114112; &#99999999999999999999; &#xFFFFFFFFFFFFFFFFFF;", "&#128512;&#x1F600;", "", "no reference",
    ]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", H.unescape(F.col("t")).alias("u")).collect()
    assert [r.u for r in rows] == [html.unescape(t) for t in texts] + [None]
