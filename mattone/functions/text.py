"""Text clean-up and splitting as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character a Unicode-aware strip removes; plain ``trim`` knows only the blank,
# and Java's ``\s`` misses the no-break space and the separators U+001C to U+001F.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
BLANK_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Control characters and every blank but the plain one.
UNCLEAN_CLASS = r"\x00-\x1f\x7f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CONTROL_CLASS = r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f"


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` computed once, however often ``f`` names it.

    A function that names its argument n times, applied to another such function, computes the inner one n times over.
    """
    return F.get(F.transform(F.array(c), lambda value: f(value)), F.lit(0))


def strip(c: Column) -> Column:
    """Blanks removed at both ends.

    Trimming a set of characters costs far more than looking at the two end
    characters, and stored text rarely needs it, so it runs only where it must.
    """
    return F.when(_blank_end(c), F.btrim(c, F.lit(BLANKS))).otherwise(c)


def _blank_end(c: Column) -> Column:
    return _is_blank_char(F.left(c, F.lit(1))) | _is_blank_char(F.right(c, F.lit(1)))


def _is_blank_char(c: Column) -> Column:
    return F.lit(BLANKS).contains(c)


def strip_computed(c: Column) -> Column:
    """The same for text that is itself a long expression, which then stands in the plan once."""
    return F.btrim(c, F.lit(BLANKS))


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only text."""
    starts_blank = _is_blank_char(F.left(c, F.lit(1)))
    return c.isNull() | (c == "") | (starts_blank & (F.btrim(c, F.lit(BLANKS)) == ""))


def normalize_text(c: Column) -> Column:
    """One line: stripped, blanks collapsed, control characters dropped, ``,`` and ``;`` turned into ``.``."""
    # A single plain blank is left alone: most of them are, and each replacement costs.
    run = f"\\x20[{BLANK_CLASS}]+|[{BLANK_CLASS}&&[^\\x20]][{BLANK_CLASS}]*"
    line = F.regexp_replace(F.regexp_replace(strip_computed(c), run, " "), f"[{CONTROL_CLASS}]", "")
    # Most short texts are one clean line already; one look spares them all of this.
    unclean = c.rlike(f"[{UNCLEAN_CLASS}]|\\x20\\x20|^\\x20|\\x20\\z")
    return F.coalesce(F.translate(F.when(unclean, line).otherwise(c), ",;", ".."), F.lit(""))


def split_composite(c: Column, sep: str = " | ") -> Column:
    """Parts between separators, stripped, without the empty ones; blank text gives an empty array."""
    parts = F.transform(F.split(c, re.escape(sep)), strip_computed)
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))


def split_address(c: Column) -> Column:
    """``city/zone/street`` as a struct (zone, street); missing or empty parts are null."""
    parts = F.split(strip(c), "/")

    def part(i: int) -> Column:
        return none_if_empty(strip_computed(F.get(parts, F.lit(i))))

    return F.struct(part(1).alias("zone"), part(2).alias("street"))


def location_fields(parts: Column) -> Column:
    """Location parts as a struct (city, country, address)."""
    return F.struct(
        F.get(parts, F.lit(0)).alias("city"),
        F.lit("IT").alias("country"),
        F.array_join(parts, "/").alias("address"),
    )


def listing_key(source: Column, source_id: Column) -> Column:
    return F.concat_ws(":", source, source_id)
