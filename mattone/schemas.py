"""Declared schemas of the three layers and the rules their rows must meet."""

from __future__ import annotations

from pyspark.sql import types as T

from mattone.vocabulary import codes, pairs

LAYERS = ("ids", "listings", "records")

_S, _D, _I, _B, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _fields(required: set[str], *typed: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in typed])


# Names, types and required columns of the layers.
IDS = _fields(
    {"source", "source_id", "title", "url", "id"},
    ("source", _S),
    ("source_id", _S),
    ("title", _S),
    ("url", _S),
    ("fetch_date", _TS),
    ("id", _S),
)

LISTINGS = _fields(
    {
        "id", "source", "title", "url", "fetch_date", "formatted_price", "price_eur", "type", "contract",
        "surface_formatted", "city", "country", "description",
    },
    ("id", _S),
    ("source", _S),
    ("title", _S),
    ("url", _S),
    ("fetch_date", _TS),
    ("last_updated", _TS),
    ("formatted_price", _S),
    ("price_eur", _D),
    ("formatted_maintenance_fee", _S),
    ("maintenance_fee", _D),
    ("formatted_price_sqm", _S),
    ("price_sqm", _D),
    ("type", _S),
    ("contract", _S),
    ("condition", _S),
    ("is_luxury", _B),
    ("surface_formatted", _S),
    ("surface", _D),
    ("rooms", _I),
    ("floor", _S),
    ("total_floors", _I),
    ("bathrooms", _I),
    ("bedrooms", _I),
    ("balcony", _B),
    ("terrace", _B),
    ("elevator", _B),
    ("garden", _S),
    ("cellar", _B),
    ("basement", _B),
    ("furnished", _S),
    ("kitchen", _S),
    ("build_year", _I),
    ("concierge", _B),
    ("is_accessible", _B),
    ("heating_type", _S),
    ("air_conditioning", _S),
    ("energy_class", _S),
    ("city", _S),
    ("country", _S),
    ("address", _S),
    ("parking_info", _S),
    ("description_title", _S),
    ("description", _S),
    ("other_amenities", T.ArrayType(_S)),
)

FEATURE_FLAGS = [code for _, code in pairs("feature")]
FEATURE_TEXTS = ["tv_system", "window_glass_type", "window_material", "sun_exposure"]
OTHER_FEATURES = _fields(set(), *[(f, _B) for f in FEATURE_FLAGS], *[(t, _S) for t in FEATURE_TEXTS])

RECORDS = _fields(
    {
        "id", "source", "title", "url", "fetch_date", "etl_date", "price_eur", "property_type", "contract_type",
        "is_rent_to_own_available", "surface", "country", "city", "description",
    },
    ("id", _S),
    ("source", _S),
    ("title", _S),
    ("url", _S),
    ("fetch_date", _TS),
    ("last_updated", _TS),
    ("etl_date", _TS),
    ("price_eur", _D),
    ("maintenance_fee", _D),
    ("price_sqm", _D),
    ("property_type", _S),
    ("ownership_type", _S),
    ("property_class", _S),
    ("contract_type", _S),
    ("is_rent_to_own_available", _B),
    ("current_availability", _S),
    ("condition", _S),
    ("is_luxury", _B),
    ("surface", _D),
    ("rooms", _I),
    ("floor", _S),
    ("total_floors", _I),
    ("bathrooms", _I),
    ("bedrooms", _I),
    ("has_balcony", _B),
    ("has_terrace", _B),
    ("has_elevator", _B),
    ("garden", _S),
    ("has_cellar", _B),
    ("has_basement", _B),
    ("furnished", _S),
    ("kitchen", _S),
    ("build_year", _I),
    ("has_concierge", _B),
    ("is_accessible", _B),
    ("heating_type", _S),
    ("air_conditioning", _S),
    ("energy_class", _S),
    ("country", _S),
    ("city", _S),
    ("zone", _S),
    ("address", _S),
    ("parking_info", _S),
    ("description_title", _S),
    ("description", _S),
    ("other_features", OTHER_FEATURES),
)

SCHEMAS = {"ids": IDS, "listings": LISTINGS, "records": RECORDS}

# Columns that may not be negative, bounds, and closed value sets per layer.
NOT_NEGATIVE = {
    "ids": [],
    "listings": ["price_eur", "maintenance_fee", "price_sqm", "surface", "rooms", "total_floors", "bathrooms", "bedrooms"],
    "records": ["price_eur", "maintenance_fee", "price_sqm", "surface", "rooms", "total_floors", "bathrooms", "bedrooms"],
}
BUILD_YEARS = (1800, 2100)
NOT_EMPTY = {"ids": [], "listings": ["type"], "records": []}
ALLOWED = {
    "ids": {},
    "listings": {"energy_class": codes("energy")},
    "records": {
        "property_type": codes("type"),
        "ownership_type": codes("ownership"),
        "property_class": codes("class"),
        "contract_type": codes("contract"),
        "current_availability": codes("availability"),
        "condition": codes("condition"),
        "garden": codes("garden"),
        "furnished": codes("furnished"),
        "kitchen": codes("kitchen"),
        "energy_class": codes("energy"),
        "other_features.tv_system": codes("tv"),
        "other_features.window_glass_type": codes("window_glass"),
        "other_features.window_material": codes("window_material"),
    },
}


def schema_of(layer: str) -> T.StructType:
    """Schema of a layer; an unknown layer is an error."""
    if layer not in SCHEMAS:
        raise ValueError(f"unknown layer: {layer!r}")
    return SCHEMAS[layer]


def required_of(layer: str) -> list[str]:
    return [f.name for f in schema_of(layer).fields if not f.nullable]


def table_for(root: str, layer: str) -> str:
    """Folder of a layer's table below the store's root."""
    schema_of(layer)
    return f"{root.rstrip('/')}/{layer}"
