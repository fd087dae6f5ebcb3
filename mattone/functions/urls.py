"""Listing and result-page URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from mattone.functions.text import none_if_empty, strip

# Where the ids and page numbers stand, and the default query parameters.
LISTING_ID = r"/annunci/(\d+)/?$"
PAGE_PARAM = "pag"
SORT_PARAMS = "criterio=data&ordine=desc"
FILTER_PARAMS = "noAste=1"
LISTING_PREFIX = "https://www.immobiliare.it/annunci/"

_PAIRS = "array<struct<k:string,v:string>>"


def listing_id(url: Column) -> Column:
    """Digits after ``/annunci/`` at the end of the URL, else null."""
    return none_if_empty(F.regexp_extract(strip(url), LISTING_ID, 1))


def last_segment(url: Column) -> Column:
    """Last path segment once slashes at both ends are gone."""
    return F.substring_index(F.btrim(url, F.lit("/")), "/", -1)


def page_number(url: Column, param: str = PAGE_PARAM) -> Column:
    """First ``pag=<digits>`` anywhere in the URL; 1 when there is none."""
    found = F.regexp_extract(url, re.escape(param) + r"=(\d+)", 1)
    return F.coalesce(found.try_cast("bigint"), F.lit(1).cast("bigint"))


def _decode(c: Column) -> Column:
    # A percent sign that starts no escape stands for itself.
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(c: Column) -> Column:
    # Form encoding keeps "~" and escapes "*"; Java's encoder does the reverse.
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(query: Column) -> Column:
    """Decoded (k, v) pairs of a query string, blank values kept, first value of a repeated key only."""
    fields = F.filter(F.split(F.coalesce(query, F.lit("")), "&"), lambda f: f != "")
    pairs = F.transform(
        fields,
        lambda f: F.struct(
            _decode(F.substring_index(f, "=", 1)).alias("k"),
            _decode(F.when(f.contains("="), F.substring(f, F.locate("=", f) + 1, F.length(f))).otherwise("")).alias("v"),
        ),
    )
    return _first_of_each(pairs)


def _first_of_each(pairs: Column) -> Column:
    # A fold over one URL's parameters: a short array by the nature of a URL.
    return F.aggregate(
        pairs,
        F.array().cast(_PAIRS),
        lambda kept, p: F.when(F.exists(kept, lambda q: q["k"] == p["k"]), kept).otherwise(F.array_append(kept, p)),
    )


def override_params(url: Column, sort: str | None = SORT_PARAMS, filters: str | None = FILTER_PARAMS) -> Column:
    """The URL with its query rewritten: own parameters first, sort and filter parameters set over them."""
    no_fragment = F.substring_index(url, "#", 1)
    fragment = F.when(url.contains("#"), F.substring(url, F.locate("#", url), F.length(url))).otherwise("")
    base = F.substring_index(no_fragment, "?", 1)
    query = F.when(no_fragment.contains("?"), F.substring(no_fragment, F.locate("?", no_fragment) + 1, F.length(url)))
    merged = query_pairs(query)
    for text in (sort, filters):
        if text:
            merged = _overwrite(merged, query_pairs(F.lit(text)))
    encoded = F.array_join(F.transform(merged, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.concat(base, F.when(encoded == "", "").otherwise(F.concat(F.lit("?"), encoded)), fragment)


def _overwrite(own: Column, over: Column) -> Column:
    """Keys of ``own`` keep their place and take the new value; keys only in ``over`` follow."""
    replaced = F.transform(
        own,
        lambda p: F.coalesce(F.get(F.filter(over, lambda o: o["k"] == p["k"]), F.lit(0)), p),
    )
    added = F.filter(over, lambda o: ~F.exists(own, lambda p: p["k"] == o["k"]))
    return F.concat(replaced, added)
