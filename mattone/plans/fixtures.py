"""Listings, pages and graphs derived from the given tables.

The texts are spelled once as SQL that Spark and DuckDB both read (``k`` is the
order key, ``p`` the whole part of its price), so that both sides of a check start
from the same input.  What is then done with the texts is stated separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mattone.functions import html as H
from mattone.functions.numbers import last_update, parse_first_int
from mattone.sources.tables import spread
from mattone.vocabulary import pairs


# Bytes of orders, as the optimizer estimates them, for one task: some ten thousand rows, each to become a page of kilobytes.
ORDER_BYTES = 1 << 19


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _by(n: int, values: list[str], number: str = "k") -> str:
    """SQL choosing one of the values by ``number % n``; null beyond the last one."""
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {number} % {n} {cases} END"


def _labels(domain: str) -> list[str]:
    return [f"'{label}'" for label, _ in pairs(domain)]


def _chosen(domain: str) -> str:
    """A label of the domain; every ninth row an unknown one, every seventh none."""
    labels = _labels(domain)
    return f"CASE WHEN k % 7 = 0 THEN NULL WHEN k % 9 = 0 THEN 'Altro ' || cast(k % 4 as {{s}}) ELSE {_by(len(labels), labels)} END"


_THOUSANDS = (
    "CASE WHEN p >= 1000 THEN cast(cast(floor(p / 1000) as bigint) as {s}) || '.' || lpad(cast(p % 1000 as {s}), 3, '0') "
    "ELSE cast(p as {s}) END"
)
_OWNER = f"CASE WHEN k % 8 = 1 THEN lower({_by(3, _labels('ownership'))}) ELSE {_by(3, _labels('ownership'))} END"
_CLASS = _by(4, _labels("class"))
_TYPE = _by(12, _labels("type"))

# Text columns over ``orders``; {s} stands for the engine's name of the text type.
TEXTS = {
    "source_id": "cast(k as {s})",
    "id": "'immobiliare:' || cast(k as {s})",
    "title": "'Casa ' || cast(k as {s}) || ' & figli'",
    "url": "'https://www.immobiliare.it/annunci/' || cast(k as {s}) || "
    "CASE WHEN k % 41 = 0 THEN '/x' WHEN k % 40 = 0 THEN '' ELSE '/' END",
    "price_text": f"CASE WHEN k % 50 = 0 THEN 'Prezzo su richiesta' WHEN k % 50 = 1 THEN '€ ' || {_THOUSANDS} || ',50' "
    f"ELSE '€ ' || {_THOUSANDS} END",
    "card_text": f"CASE WHEN k % 13 = 0 THEN 'Da € ' || {_THOUSANDS} ELSE '€ ' || {_THOUSANDS} END",
    "price_sqm_text": "CASE k % 5 WHEN 1 THEN '3558 €/m²' "
    "WHEN 2 THEN cast(k % 9 + 1 as {s}) || '.' || lpad(cast(k % 1000 as {s}), 3, '0') || ' €/m²' "
    "WHEN 3 THEN cast(k % 9 + 1 as {s}) || '.250,50 €/m²' WHEN 4 THEN '2.000 €' END",
    "fee_text": "CASE k % 6 WHEN 1 THEN '€ ' || cast(k % 300 as {s}) || '/mese' WHEN 2 THEN '€ ' || cast(k % 300 as {s}) || '/anno' "
    "WHEN 3 THEN '€ 1.200/mese' WHEN 4 THEN 'Nessuna spesa' WHEN 5 THEN '€ ' || cast(k % 90 as {s}) END",
    "surface_text": "CASE WHEN k % 97 = 0 THEN '120 mq' WHEN k % 89 = 0 THEN '0 m²' WHEN k % 7 = 5 THEN '35.5 m²' "
    "WHEN k % 7 = 6 THEN '1.200 m²' ELSE cast(20 + k % 180 as {s}) || ' m²' END",
    "update_text": "CASE WHEN k % 11 = 0 THEN '31/02/2025' WHEN k % 11 = 1 THEN 'mai' "
    "ELSE 'Annuncio aggiornato il ' || cast(k % 28 + 1 as {s}) || '/' || cast(k % 12 + 1 as {s}) || '/2025' END",
    "type_text": f"CASE WHEN k % 101 = 0 THEN 'Castello' WHEN k % 4 = 0 THEN {_TYPE} WHEN k % 4 = 1 THEN {_TYPE} || ' | ' || {_OWNER} "
    f"WHEN k % 4 = 2 THEN {_TYPE} || ' | ' || {_CLASS} ELSE {_TYPE} || ' | ' || {_OWNER} || '|' || {_CLASS} END",
    "contract_text": "CASE WHEN k % 103 = 0 THEN 'Asta' ELSE "
    + _by(5, ["'Vendita'", "'Affitto'", "'Vendita | Immobile a reddito'", "'Affitto con RISCATTO'", "'Vendita | Libero'"])
    + " END",
    "condition_text": _chosen("condition"),
    "garden_text": _chosen("garden"),
    "furnished_text": _chosen("furnished"),
    "kitchen_text": _chosen("kitchen"),
    "address_text": "CASE k % 6 WHEN 0 THEN 'Milano/Zona ' || cast(k % 20 as {s}) WHEN 1 THEN 'Milano//Via ' || cast(k % 50 as {s}) "
    "WHEN 2 THEN NULL ELSE 'Milano/Zona ' || cast(k % 20 as {s}) || '/ Via ' || cast(k % 50 as {s}) END",
    "badges_text": "nullif(concat_ws(';', CASE WHEN k % 2 = 0 THEN 'Piscina' END, CASE WHEN k % 3 = 0 THEN 'Caminetto' END, "
    "CASE WHEN k % 5 = 0 THEN 'Esposizione sud' END, CASE WHEN k % 4 = 0 THEN 'Impianto tv singolo' END, "
    "CASE WHEN k % 8 = 0 THEN 'Impianto tv boh' END, CASE WHEN k % 6 = 0 THEN 'Infissi esterni in doppio vetro / legno' END, "
    "CASE WHEN k % 18 = 0 THEN 'Infissi esterni in triplo vetro / Ferro' END, CASE WHEN k % 7 = 0 THEN 'Altro' END, "
    + ", ".join(f"CASE WHEN k % {11 + i} = 0 THEN '{label}' END" for i, (label, _) in enumerate(pairs("feature")) if label not in ("Piscina", "Caminetto"))
    + "), '')",
    "year_text": "CASE WHEN k % 60 = 0 THEN '1500' WHEN k % 61 = 0 THEN '20240000000' ELSE cast(1900 + k % 120 as {s}) END",
    "answer_text": _by(6, ["'Sì'", "'No'", "'No. classico'", "'Nessuno'", "NULL", "'boh'"]),
    "porter_text": _by(4, ["'Portiere intera giornata'", "'No'", "NULL", "'Servizio'"]),
    "energy_text": _by(14, [*_labels("energy"), "'Z'", "NULL"]),
    "floor_text": "CASE WHEN k % 3 > 0 THEN 'Piano ' || cast(k % 9 as {s}) END",
    "floors_text": "CASE WHEN k % 5 > 0 THEN cast(k % 12 + 1 as {s}) || ' piani' END",
    "baths_text": "CASE WHEN k % 8 > 0 THEN cast(k % 4 as {s}) || '+' END",
    "beds_text": _by(4, ["'2'", "'nessuna'", "'3 (1 doppia)'"]),
    "terrace_text": _by(3, ["'Sì'", "'No'"]),
    "lift_text": _by(4, ["'Si'", "'No'", "'forse'"]),
    "cellar_text": _by(5, ["'No'", "'Sì'", "'yes'"]),
    "access_text": _by(7, ["'Sì'", "'No'"]),
    "heating_text": _by(3, ["'Autonomo'", "'Centralizzato a metano'"]),
    "cooling_text": _by(6, ["'Autonomo freddo'", "'Assente'"]),
    "parking_text": _by(3, ["'1 in box privato'", "NULL", "'2 in parcheggio comune'"]),
    "rooms_text": _by(5, ["'3+'", "'5 (2 camere)'", "'molti'", "NULL", "cast(k % 10 as {s}) || ' locali'"]),
    "description_text": "CASE WHEN k % 71 = 0 THEN ' ' ELSE 'Luminoso, vicino al parco; ' || o_orderpriority END",
    # What a page shows of it, where every other one goes on in elements of its own.
    "shown_description": "CASE WHEN k % 71 = 0 THEN ' ' ELSE 'Luminoso, vicino al parco; ' || o_orderpriority "
    "|| CASE WHEN k % 2 = 0 THEN ' seconda interno dopo' ELSE '' END END",
}

# Characteristic label -> text column, as a listing page shows them.
CHARACTERISTICS = {
    "Tipologia": "type_text",
    "Contratto": "contract_text",
    "Superficie": "surface_text",
    "Stato": "condition_text",
    "Locali": "rooms_text",
    "Giardino": "garden_text",
    "Arredato": "furnished_text",
    "Cucina": "kitchen_text",
    "Anno di costruzione": "year_text",
    "Balcone": "answer_text",
    "Servizio portineria": "porter_text",
    "Piano": "floor_text",
    "Piani edificio": "floors_text",
    "Bagni": "baths_text",
    "Camere da letto": "beds_text",
    "Terrazzo": "terrace_text",
    "Ascensore": "lift_text",
    "Cantina": "cellar_text",
    "Accesso disabili": "access_text",
    "Riscaldamento": "heating_text",
    "Climatizzazione": "cooling_text",
    "Box, posti auto": "parking_text",
}

# Saved pages leave a fetch time behind; the checks use a fixed one.
FETCHED = "2025-06-01 12:00:00+02:00"


def duck_texts(columns: list[str] | None = None) -> str:
    """The text columns as a DuckDB subquery body over ``orders``."""
    chosen = ", ".join(f"{TEXTS[c].format(s='varchar')} AS {c}" for c in (columns or TEXTS))
    return (
        f"(SELECT k, o_orderstatus, {chosen} FROM (SELECT o_orderkey AS k, "
        "cast(floor(o_totalprice) as bigint) AS p, o_orderstatus, o_orderpriority FROM orders) q)"
    )


def listing_texts(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """One row of raw texts per order."""
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.floor("o_totalprice").cast("bigint").alias("p"),
        "o_orderstatus",
        "o_orderpriority",
    )
    chosen = [F.expr(TEXTS[c].format(s="string")).alias(c) for c in (columns or TEXTS)]
    return spread(orders, ORDER_BYTES).select("k", "o_orderstatus", *chosen)


def fetched_at() -> Column:
    return F.lit(FETCHED).cast("timestamp")


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw page fields as ``build_details`` reads them."""
    t = listing_texts(spark, sf_dir)
    given = F.filter(
        F.array(*[F.struct(F.lit(label).alias("k"), F.col(c).alias("v")) for label, c in CHARACTERISTICS.items()]),
        lambda e: e["v"].isNotNull(),
    )
    return t.select(
        "id",
        F.lit("immobiliare").alias("source"),
        "source_id",
        "title",
        "url",
        "price_text",
        "price_sqm_text",
        "fee_text",
        last_update(F.col("update_text")).alias("last_updated"),
        "energy_text",
        F.lit(None).cast("string").alias("description_title"),
        F.col("description_text").alias("description"),
        F.split("address_text", "/").alias("location_parts"),
        F.split("badges_text", ";").alias("badges"),
        F.when(F.col("k") % 3 == 0, True).alias("luxury"),
        F.map_from_entries(given).alias("characteristics"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``listings`` rows as the records job reads them, not yet checked against the layer's rules."""
    t = listing_texts(spark, sf_dir)
    text_null = F.lit(None).cast("string")
    whole = F.col("k").cast("int")
    return t.select(
        "id",
        F.lit("immobiliare").alias("source"),
        "title",
        "url",
        fetched_at().alias("fetch_date"),
        F.lit(None).cast("timestamp").alias("last_updated"),
        F.col("price_text").alias("formatted_price"),
        F.col("k").cast("double").alias("price_eur"),
        text_null.alias("formatted_maintenance_fee"),
        F.when(F.col("k") % 4 > 0, (F.col("k") % 300).cast("double")).alias("maintenance_fee"),
        text_null.alias("formatted_price_sqm"),
        F.lit(None).cast("double").alias("price_sqm"),
        F.col("type_text").alias("type"),
        F.col("contract_text").alias("contract"),
        F.col("condition_text").alias("condition"),
        F.when(F.col("k") % 3 == 0, True).alias("is_luxury"),
        F.replace("surface_text", F.lit("m²"), F.lit("sqm")).alias("surface_formatted"),
        F.lit(None).cast("double").alias("surface"),
        (whole % 7).alias("rooms"),
        text_null.alias("floor"),
        F.lit(None).cast("int").alias("total_floors"),
        (whole % 3).alias("bathrooms"),
        F.lit(None).cast("int").alias("bedrooms"),
        (F.col("k") % 2 == 0).alias("balcony"),
        F.lit(None).cast("boolean").alias("terrace"),
        F.lit(None).cast("boolean").alias("elevator"),
        F.col("garden_text").alias("garden"),
        F.lit(None).cast("boolean").alias("cellar"),
        F.lit(None).cast("boolean").alias("basement"),
        F.col("furnished_text").alias("furnished"),
        F.col("kitchen_text").alias("kitchen"),
        parse_first_int(F.col("year_text")).alias("build_year"),
        F.lit(None).cast("boolean").alias("concierge"),
        F.lit(None).cast("boolean").alias("is_accessible"),
        text_null.alias("heating_type"),
        text_null.alias("air_conditioning"),
        F.col("energy_text").alias("energy_class"),
        F.lit("Milano").alias("city"),
        F.lit("IT").alias("country"),
        F.col("address_text").alias("address"),
        text_null.alias("parking_info"),
        text_null.alias("description_title"),
        F.col("description_text").alias("description"),
        F.split("badges_text", ";").alias("other_amenities"),
    )


def _tag(node: H.Node, inside: Column) -> Column:
    attr = f' {node.attr}="{node.word}"' if node.attr else ""
    return F.concat(F.lit(f"<{node.tag}{attr}>"), inside, F.lit(f"</{node.tag}>"))


def _nested(path: H.Path, inside: Column) -> Column:
    for node in reversed(path):
        inside = _tag(node, inside)
    return inside


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One saved listing page per order, put together from its texts with the source's markup."""
    page = H.LISTING_PAGE
    t = listing_texts(spark, sf_dir)

    def pair(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"<dt>{label}</dt> <dd>\n "), value, F.lit(" </dd>"))

    def feature(label: str, value: Column) -> Column:
        return _tag(page.characteristic, pair(label, value))

    features = [F.when(F.col(c).isNotNull(), feature(label, F.col(c))) for label, c in CHARACTERISTICS.items()]
    # Every tenth page shows its rooms twice; the last value counts.
    again = F.when(F.col("k") % 10 == 0, feature("Locali", F.lit("9 locali")))
    badge = F.transform(F.split(F.coalesce("badges_text", F.lit("")), ";"), lambda b: _nested(page.badge, b))
    parts = F.transform(F.split(F.coalesce("address_text", F.lit("")), "/"), lambda s: _nested(page.location, s))
    luxury = F.when(
        F.col("k") % 3 == 0,
        _tag(page.features, F.concat(F.lit('<svg><use href="#diamond"></use></svg>'), F.lit("<span>Lusso</span>"))),
    ).otherwise(_tag(page.features, F.lit("<span>Lusso</span>")))
    # Elements of the same names outside their boxes, and text that goes on behind inner elements, must not mislead.
    more = F.when((F.col("k") % 2 == 0) & (F.col("k") % 71 != 0), F.lit("<br>seconda<!-- nota --> <div>interno</div><script>var a;</script> dopo")).otherwise(F.lit(""))
    strays = _nested(page.location, F.lit("Altrove")), _nested(page.badge, F.lit("Estraneo"))
    blocks = [
        F.lit("<html><body>"),
        *strays,
        _nested(page.title, F.replace("title", F.lit("&"), F.lit("&amp;"))),
        _nested(page.price, F.col("price_text")),
        _tag(page.location_box, F.concat(F.lit("<span>in</span>"), F.array_join(parts, " "))),
        _nested(page.update, F.col("update_text")),
        F.when(F.col("energy_text").isNotNull(), F.concat(F.lit('<span data-energy-class=" '), F.lower("energy_text"), F.lit('"></span>'))),
        luxury,
        _nested(page.badge_box, F.array_join(badge, " ")),
        _tag(
            page.description,
            F.concat(_nested(page.description_title, F.lit(" Casa,\n bella ")), _nested(page.description_text, F.concat("description_text", more))),
        ),
        _tag(page.costs, F.concat(pair("Prezzo", F.col("price_text")), F.when(F.col("fee_text").isNotNull(), pair("Spese condominio", F.col("fee_text"))).otherwise(""))),
        _tag(page.price_info, F.when(F.col("price_sqm_text").isNotNull(), pair("Prezzo al m²", F.col("price_sqm_text"))).otherwise("")),
        F.lit("<dl>"),
        *features,
        again,
        F.lit('</dl><footer><svg><use href="#diamond"></use></svg><span>Lusso</span></footer></body></html>'),
    ]
    return t.select("k", "id", F.lit("immobiliare").alias("source"), "title", "url", F.concat_ws("", *blocks).alias("html"))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of three cards per order: a whole one, one without a title, one without a link."""
    t = listing_texts(spark, sf_dir, ["url", "title", "card_text"])
    open_card, href = '<li><div class="styles_in-listingCardPropertyContent__tfu8w">', '<a class="t" href="'
    # Lists and elements inside the card before its price; another price behind the card.
    inner = F.when(F.col("k") % 2 == 0, F.lit("<ul><li>foto</li></ul><div><div>mappa</div></div>")).otherwise(F.lit(""))
    whole = F.concat(
        F.lit(open_card + href), "url", F.lit('" title="'), "title", F.lit('">vedi</a>'), inner, F.lit("<p>"), "card_text", F.lit("</p></div><p>Da € 1</p></li>")
    )
    untitled = F.concat(F.lit(open_card + href), "url", F.lit('"> </a></div></li>'))
    unlinked = F.concat(F.lit(open_card + '<a href="/altro">'), "title", F.lit("</a></div></li>"))
    return t.select("k", F.concat(F.lit("<ul>"), whole, untitled, unlinked, F.lit("</ul>")).alias("html"))


# Similar documents by arithmetic on their ids; {n} is the number of documents.
SIMILAR = {
    "id_ref": "cast(doc_id as {s})",
    "text_ref": "lang || ' ' || source || ' ' || cast(n_chars as {s})",
    "id_similar_1": "cast((doc_id * 7 + 1) % {n} as {s})",
    "text_similar_1": "'copy 1 of ' || cast(doc_id as {s})",
    "sim1": "cast((doc_id * 37) % 100 as double) / 100",
    "id_similar_2": "CASE WHEN doc_id % 10 = 0 THEN NULL ELSE cast((doc_id * 13 + 5) % {n} as {s}) END",
    "text_similar_2": "'copy 2 of ' || cast(doc_id as {s})",
    "sim2": "cast((doc_id * 53) % 100 as double) / 100",
}


def duck_similar() -> str:
    chosen = ", ".join(f"{e.format(s='varchar', n='n')} AS {c}" for c, e in SIMILAR.items())
    return f"(SELECT doc_id, {chosen} FROM (SELECT *, (SELECT count(*) FROM documents) AS n FROM documents) q)"


def similar_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per document naming two similar ones."""
    documents = load(spark, sf_dir, "documents")
    n = documents.count()
    return documents.select("doc_id", *[F.expr(e.format(s="string", n=n)).alias(c) for c, e in SIMILAR.items()])
