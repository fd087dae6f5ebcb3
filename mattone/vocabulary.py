"""Source labels and the codes they stand for, as rows of one long table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (domain, label, code), as they appear on the source's pages.
VOCABULARY = [
    ("furnished", "Sì", "fully_furnished"),
    ("furnished", "Parzialmente Arredato", "partially_furnished"),
    ("furnished", "Solo Cucina Arredata", "only_kitchen"),
    ("furnished", "No", "none"),
    ("garden", "Giardino privato", "private"),
    ("garden", "Giardino comune", "shared"),
    ("garden", "Nessun giardino", "none"),
    ("kitchen", "Cucina abitabile", "habitable"),
    ("kitchen", "Cucina a vista", "open_view"),
    ("kitchen", "Cucina cucinotto", "kitchenette"),
    ("kitchen", "Cucina angolo cottura", "kitchen_corner"),
    ("kitchen", "Cucina semi abitabile", "semi_habitable"),
    ("ownership", "Intera proprietà", "full_ownership"),
    ("ownership", "Nuda proprietà", "bare_ownership"),
    ("ownership", "Diritto di superficie", "surface_right"),
    ("class", "Classe immobile signorile", "upscale"),
    ("class", "Classe immobile media", "medium"),
    ("class", "Classe immobile economica", "economic"),
    ("class", "Immobile di lusso", "luxury"),
    ("condition", "Ottimo / Ristrutturato", "excellent_renovated"),
    ("condition", "Da ristrutturare", "to_renovate"),
    ("condition", "Nuovo / In costruzione", "new_under_construction"),
    ("condition", "Buono / Abitabile", "good_habitable"),
    ("type", "Appartamento", "apartment"),
    ("type", "Attico", "penthouse"),
    ("type", "Loft", "loft"),
    ("type", "Villa bifamiliare", "semi_detached_villa"),
    ("type", "Mansarda", "attic"),
    ("type", "Villa unifamiliare", "detached_villa"),
    ("type", "Open space", "open_space"),
    ("type", "Terratetto unifamiliare", "terraced_house"),
    ("type", "Villa a schiera", "townhouse"),
    ("type", "Appartamento in villa", "villa_apartment"),
    ("type", "Villa plurifamiliare", "multi_family_villa"),
    ("type", "Rustico", "rustic_house"),
    ("tv", "Impianto tv centralizzato", "centralized"),
    ("tv", "Impianto tv con parabola satellitare", "satellite"),
    ("tv", "Impianto tv singolo", "individual"),
    ("window_material", "legno", "wood"),
    ("window_material", "metallo", "metal"),
    ("window_material", "PVC", "pvc"),
    ("window_glass", "triplo vetro", "triple_glass"),
    ("window_glass", "doppio vetro", "double_glass"),
    ("window_glass", "vetro", "single_glass"),
    ("contract", "Vendita", "sale"),
    ("contract", "Affitto", "rent"),
    ("availability", "libero", "available"),
    ("availability", "a reddito", "occupied"),
    ("energy", "A", "A"),
    ("energy", "A+", "A+"),
    ("energy", "A1", "A1"),
    ("energy", "A2", "A2"),
    ("energy", "A3", "A3"),
    ("energy", "A4", "A4"),
    ("energy", "B", "B"),
    ("energy", "C", "C"),
    ("energy", "D", "D"),
    ("energy", "E", "E"),
    ("energy", "F", "F"),
    ("energy", "G", "G"),
    ("feature", "Armadio a muro", "has_built_in_wardrobe"),
    ("feature", "Caminetto", "has_fireplace"),
    ("feature", "Campo da tennis", "has_tennis_court"),
    ("feature", "Cancello elettrico", "has_electric_gate"),
    ("feature", "Cucina", "has_kitchen"),
    ("feature", "Fibra ottica", "has_fiber_optic"),
    ("feature", "Giardino privato e comune", "has_private_or_shared_garden"),
    ("feature", "Idromassaggio", "has_hot_tub"),
    ("feature", "Impianto di allarme", "has_alarm_system"),
    ("feature", "Mansarda", "has_attic"),
    ("feature", "Piscina", "has_pool"),
    ("feature", "Porta blindata", "has_armored_door"),
    ("feature", "Reception", "has_reception"),
    ("feature", "Taverna", "has_tavern"),
    ("feature", "VideoCitofono", "has_video_intercom"),
    # Declared by the source's labels, used by no transformation.
    ("heating", "centralizzato", "central"),
    ("heating", "autonomo", "independent"),
    ("heating", "assenza", "none"),
    ("air_conditioning", "centralizzato", "central"),
    ("air_conditioning", "autonomo", "independent"),
    ("air_conditioning", "assenza", "none"),
    ("availability_label", "disponibile", "available"),
    ("availability_label", "occupato", "occupied"),
    ("region", "urbano", "urban"),
    ("region", "suburbano", "suburban"),
    ("region", "rurale", "rural"),
    ("region", "costiero", "coastal"),
    ("region", "montano", "mountain"),
    ("region", "deserto", "desert"),
]

# A badge holding one of these words carries text instead of a flag.
SUN_WORD = "Esposizione"
TV_WORD = "Impianto tv"
WINDOW_WORD = "Infissi esterni"


def pairs(domain: str) -> list[tuple[str, str]]:
    """(label, code) rows of one domain, in table order."""
    return [(label, code) for d, label, code in VOCABULARY if d == domain]


def codes(domain: str) -> list[str]:
    return [code for _, code in pairs(domain)]


def code_for(label: Column, domain: str, ignore_case: bool = False) -> Column:
    """Code of an exact label, null when the domain has no such label.

    A lookup in a literal map: the domains hold a dozen rows, so this needs no join,
    and the label's own expression stands in the plan once.
    """
    rows = [(text.lower() if ignore_case else text, code) for text, code in pairs(domain)]
    known = F.create_map(*[F.lit(cell) for row in rows for cell in row])
    return F.try_element_at(known, F.lower(label) if ignore_case else label)


def code_within(text: Column, domain: str) -> Column:
    """Code of the first label of the domain that occurs inside the text."""
    return F.coalesce(*[F.when(text.contains(label), F.lit(code)) for label, code in pairs(domain)])
