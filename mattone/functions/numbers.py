"""Numbers, yes/no answers and dates read out of Italian page text.

The readings keep the source tool's own habits, odd ones included: the first
digit run decides, so ``1.200 m²`` reads 1 as a whole number and 1.2 as a decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mattone.functions.text import BLANKS, none_if_empty, strip
from mattone.vocabulary import codes

# The number patterns of the page texts.
DIGITS = r"\d+"
GROUPED_NUMBER = r"\d{1,3}(?:\.\d{3})*(?:,\d+)?"
DECIMAL_NUMBER = r"\d+(?:[.,]\d+)?"
DATE = r"(\d{1,2})/(\d{1,2})/(\d{4})"
FLOAT_TEXT = r"^[+-]?\d+(?:_\d+)*(?:[eE][+-]?\d+(?:_\d+)*)?$"
HOME_ZONE = "Europe/Rome"

LARGEST = 2**31 - 1


def _first(c: Column, pattern: str, kind: str = "double") -> Column:
    """First match of the pattern as a number; null without one."""
    return F.regexp_extract(c, pattern, 0).try_cast(kind)


def _text_value(ok: Column, text: Column, value: Column) -> Column:
    """(text, value), both null unless ``ok``."""
    return F.struct(F.when(ok, text).alias("text"), F.when(ok, value).alias("value"))


def parse_price(c: Column) -> Column:
    """Whole euros: currency sign, blanks and dots dropped; null when the rest is no number."""
    bare = F.translate(c, "€." + BLANKS, "")
    return F.when(bare.rlike(FLOAT_TEXT), F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"))


def parse_price_sqm(c: Column) -> Column:
    value = F.translate(F.regexp_extract(c, GROUPED_NUMBER, 0), ",.", ".").try_cast("double")
    ok = F.endswith(strip(c), F.lit("€/m²")) & value.isNotNull()
    return _text_value(ok, F.replace(c, F.lit("€/m²"), F.lit("EUR/sqm")), value)


def parse_monthly_fee(c: Column) -> Column:
    """Yearly amounts become monthly ones; an unnamed period counts as monthly."""
    amount = _first(c, DIGITS)
    low = F.lower(c)
    monthly = low.contains("mese") | low.contains("month")
    yearly = low.contains("anno") | low.contains("year")
    value = F.when(~monthly & yearly, amount / 12).otherwise(amount)
    return _text_value(amount.isNotNull(), c, value)


def parse_surface_int(c: Column) -> Column:
    """First digit run of a text ending in ``m²``."""
    value = _first(c, DIGITS)
    ok = F.endswith(strip(c), F.lit("m²")) & value.isNotNull()
    return _text_value(ok, F.replace(c, F.lit("m²"), F.lit("sqm")), value)


def parse_surface_decimal(c: Column) -> Column:
    """First number, comma or dot as decimal mark, of a text ending in ``m²`` or ``sqm``."""
    bare = strip(c)
    number = F.translate(F.regexp_extract(bare, DECIMAL_NUMBER, 0), ",", ".")
    return F.when(F.endswith(bare, F.lit("m²")) | F.endswith(bare, F.lit("sqm")), number.try_cast("double"))


def parse_first_int(c: Column) -> Column:
    """First digit run, of any length; beyond 32 bits it is the largest whole number, which no range rule admits."""
    digits = F.ltrim(F.regexp_extract(c, DIGITS, 0), F.lit("0"))
    read = F.least(digits.try_cast("bigint"), F.lit(LARGEST)).cast("int")
    found = F.when(F.length(digits) > 10, LARGEST).when(digits == "", 0).otherwise(read)
    return F.when(c.rlike(DIGITS), found)


def parse_yes_no(c: Column) -> Column:
    """Null is unknown.  ``si`` is looked for first and anywhere, so ``No, classico`` reads true."""
    low = F.lower(c)
    yes = low.contains("sì") | low.contains("si") | low.contains("yes")
    return F.when(yes, True).when(low.contains("no"), False)


def parse_concierge(c: Column) -> Column:
    return F.when(none_if_empty(c).isNotNull(), F.lower(c).contains("portiere"))


def parse_energy_class(c: Column) -> Column:
    return F.when(c.isin(codes("energy")), c)


def last_update(c: Column) -> Column:
    """First day/month/year of the text as midnight in Rome; impossible dates are null."""
    day, month, year = (F.regexp_extract(c, DATE, i).try_cast("int") for i in (1, 2, 3))
    return F.when(
        year >= 1,
        F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0), F.lit(HOME_ZONE)),
    )
