"""Raw page fields to ``listings`` rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.functions import numbers as N
from mattone.functions.text import is_blank, location_fields, none_if_empty
from mattone.functions.urls import LISTING_PREFIX
from mattone.operators.validate import apply_policy, conform, failed_rules
from mattone.schemas import schema_of

# Characteristic labels every listing must carry, and those that are read.
REQUIRED_LABELS = ("Tipologia", "Contratto", "Superficie")
TEXT_LABELS = {
    "condition": "Stato",
    "floor": "Piano",
    "garden": "Giardino",
    "furnished": "Arredato",
    "kitchen": "Cucina",
    "heating_type": "Riscaldamento",
    "air_conditioning": "Climatizzazione",
    "parking_info": "Box, posti auto",
}
NUMBER_LABELS = {
    "rooms": "Locali",
    "total_floors": "Piani edificio",
    "bathrooms": "Bagni",
    "bedrooms": "Camere da letto",
    "build_year": "Anno di costruzione",
}
YES_NO_LABELS = {
    "balcony": "Balcone",
    "terrace": "Terrazzo",
    "elevator": "Ascensore",
    "cellar": "Cantina",
    "is_accessible": "Accesso disabili",
}
CONCIERGE_LABEL = "Servizio portineria"

# Columns that hold only what the parsers let through: digits are never negative, codes always allowed.
# The price may carry a sign and the year any number, so both are checked.
DERIVED = frozenset(
    {
        "fetch_date", "last_updated", "maintenance_fee", "price_sqm", "is_luxury", "surface", "surface_formatted",
        "basement", "energy_class", "country", "concierge", *YES_NO_LABELS,
        "rooms", "total_floors", "bathrooms", "bedrooms",
    }
)


def characteristic(label: str) -> Column:
    return F.try_element_at("characteristics", F.lit(label))


# Every label that is read, and the column that holds its value while a row is built.
READ_LABELS = (*REQUIRED_LABELS, *TEXT_LABELS.values(), *NUMBER_LABELS.values(), *YES_NO_LABELS.values(), CONCIERGE_LABEL)


def _value(label: str) -> Column:
    return F.col(f"_value_{READ_LABELS.index(label)}")


def _with_values(raw: DataFrame) -> DataFrame:
    """The labels' values as columns: what reads one names it several times, and would search the map each time."""
    return raw.withColumns({f"_value_{i}": characteristic(label) for i, label in enumerate(READ_LABELS)})


def require_fields(url_prefix: str = LISTING_PREFIX, value: Callable[[str], Column] = characteristic) -> Column:
    """The first missing input of a raw row, or null; ``value`` gives the text of a label."""
    reason = (
        F.when(~F.startswith("url", F.lit(url_prefix)), "url_prefix")
        .when(is_blank(F.col("price_text")), "no_price")
        .when(F.coalesce(F.size("location_parts"), F.lit(-1)) < 1, "no_location")
        .when(is_blank(F.col("description")), "no_description")
        .when(F.coalesce(F.size("characteristics"), F.lit(-1)) < 1, "no_characteristics")
    )
    for label in REQUIRED_LABELS:
        missing = none_if_empty(value(label)).isNull()
        reason = reason.when(missing, f"no_{label.lower()}")
    return reason


def project_characteristics(value: Callable[[str], Column] = characteristic) -> dict[str, Column]:
    """``listings`` columns read from the characteristics map, or from ``value`` of each label."""
    columns = {c: value(label) for c, label in TEXT_LABELS.items()}
    columns |= {c: N.parse_first_int(value(label)) for c, label in NUMBER_LABELS.items()}
    columns |= {c: N.parse_yes_no(value(label)) for c, label in YES_NO_LABELS.items()}
    columns["concierge"] = N.parse_concierge(value(CONCIERGE_LABEL))
    return columns


def build_details(
    raw: DataFrame, as_of: Column, url_prefix: str = LISTING_PREFIX, errors: str = "quarantine"
) -> DataFrame:
    """``listings`` rows plus ``reject_reason``, null for a good row.

    One narrow pass: every column is an expression over its own row.
    """
    raw = _with_values(raw)
    price = N.parse_price(F.col("price_text"))
    fee = N.parse_monthly_fee(none_if_empty(F.col("fee_text")))
    sqm = N.parse_price_sqm(none_if_empty(F.col("price_sqm_text")))
    surface = N.parse_surface_int(_value("Superficie"))
    place = location_fields(F.col("location_parts"))
    columns = {
        "id": F.col("id"),
        "source": F.col("source"),
        "title": F.col("title"),
        "url": F.col("url"),
        "fetch_date": as_of,
        "last_updated": F.col("last_updated"),
        "formatted_price": F.col("price_text"),
        "price_eur": price,
        "formatted_maintenance_fee": fee["text"],
        "maintenance_fee": fee["value"],
        "formatted_price_sqm": sqm["text"],
        "price_sqm": sqm["value"],
        "type": _value("Tipologia"),
        "contract": _value("Contratto"),
        "is_luxury": F.col("luxury"),
        "surface_formatted": surface["text"],
        "surface": surface["value"],
        "basement": F.lit(None).cast("boolean"),
        "energy_class": N.parse_energy_class(F.col("energy_text")),
        "city": place["city"],
        "country": place["country"],
        "address": place["address"],
        "description_title": F.col("description_title"),
        "description": F.col("description"),
        "other_amenities": F.when(F.size("badges") > 0, F.col("badges")),
        **project_characteristics(_value),
    }
    order = schema_of("listings").names
    upstream = [F.col("page_problem")] if "page_problem" in raw.columns else []
    first = F.coalesce(*upstream, require_fields(url_prefix, _value))
    built = raw.select(*[columns[n].alias(n) for n in order], first.alias("_missing"))
    judged = conform(built, "listings", DERIVED)
    reason = F.coalesce(
        F.col("_missing"),
        F.when(F.col("price_eur").isNull(), "bad_price"),
        # A surface of zero counts as not found.
        F.when(F.coalesce(F.col("surface"), F.lit(0.0)) == 0, "bad_surface"),
        failed_rules("listings", DERIVED),
    )
    rows = judged.withColumn("reject_reason", reason).drop("_missing")
    return apply_policy(rows, "reject_reason", errors)
