"""The registered queries stated again in SQL over the given tables, for a second engine to run."""

from __future__ import annotations

from mattone.plans.fixtures import CHARACTERISTICS, duck_similar, duck_texts
from mattone.functions.elements import VOID
from mattone.plans.queries import BEST, FAR, FARTHEST, MAPPING_SAMPLE, SEED, START, TOP_TERMS
from mattone.vocabulary import VOCABULARY, pairs

_VOCAB = "WITH vocab(domain, label, code) AS (VALUES " + ", ".join(f"('{d}', '{t}', '{c}')" for d, t, c in VOCABULARY) + ") "
_FLAG_LABELS = ", ".join(f"'{label}'" for label, _ in pairs("feature"))
_ENERGY = ", ".join(f"'{code}'" for _, code in pairs("energy"))


def _code(domain: str, label: str) -> str:
    return f"(SELECT v.code FROM vocab v WHERE v.domain = '{domain}' AND v.label = {label})"


def _code_any_case(domain: str, label: str) -> str:
    return f"(SELECT v.code FROM vocab v WHERE v.domain = '{domain}' AND lower(v.label) = lower({label}))"


def _parts(text: str, sep: str) -> str:
    return f"list_filter(list_transform(string_split({text}, '{sep}'), lambda x: trim(x)), lambda x: x <> '')"


def _from(*columns: str) -> str:
    return "FROM " + duck_texts(list(columns) or None) + " t"


# --- the readings of single texts --------------------------------------------------------------

_PRICE = "CASE WHEN regexp_matches(replace(replace(replace(price_text, '€', ''), ' ', ''), '.', ''), '^[0-9]+$') " \
    "THEN cast(replace(replace(replace(price_text, '€', ''), ' ', ''), '.', '') AS double) END"


def _sqm(text: str) -> tuple[str, str]:
    number = f"regexp_extract({text}, '[0-9]{{1,3}}(\\.[0-9]{{3}})*(,[0-9]+)?')"
    shown = f"CASE WHEN ends_with(trim({text}), '€/m²') THEN replace({text}, '€/m²', 'EUR/sqm') END"
    return shown, f"CASE WHEN ends_with(trim({text}), '€/m²') THEN cast(replace(replace({number}, '.', ''), ',', '.') AS double) END"


_DIGITS = "try_cast(nullif(regexp_extract({0}, '[0-9]+'), '') AS {1})"
_YEAR = f"least({_DIGITS.format('year_text', 'bigint')}, 2147483647)"
_FEE_NUMBER = _DIGITS.format("fee_text", "double")
_FEE_TEXT = f"CASE WHEN {_FEE_NUMBER} IS NOT NULL THEN fee_text END"
_FEE = f"CASE WHEN contains(fee_text, 'anno') THEN {_FEE_NUMBER} / 12 ELSE {_FEE_NUMBER} END"
_SURFACE_TEXT = "CASE WHEN ends_with(surface_text, 'm²') THEN replace(surface_text, 'm²', 'sqm') END"
_SURFACE = f"CASE WHEN ends_with(surface_text, 'm²') THEN {_DIGITS.format('surface_text', 'double')} END"
_SURFACE_DECIMAL = "CASE WHEN ends_with(surface_text, 'm²') THEN cast(replace(regexp_extract(surface_text, '[0-9]+([.,][0-9]+)?'), ',', '.') AS double) END"
def _yes(text: str) -> str:
    return f"CASE WHEN regexp_matches(lower({text}), 'sì|si|yes') THEN true WHEN contains(lower({text}), 'no') THEN false END"


_ANSWER = _yes("answer_text")
_PORTER = "CASE WHEN porter_text <> '' THEN contains(lower(porter_text), 'portiere') END"
_ENERGY_CLASS = f"CASE WHEN energy_text IN ({_ENERGY}) THEN energy_text END"
_DAY = "try_strptime(nullif(regexp_extract(update_text, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}'), ''), '%d/%m/%Y')"
# Rome is two hours ahead between the last Sundays of March and October, else one; all dates are in 2025.
_UPDATED = f"cast(epoch({_DAY}) AS bigint) - CASE WHEN {_DAY} > TIMESTAMP '2025-03-30' AND {_DAY} <= TIMESTAMP '2025-10-26' THEN 7200 ELSE 3600 END"


def _line(text: str) -> str:
    return f"translate(trim(regexp_replace({text}, '\\s+', ' ', 'g')), ',;', '..')"


# --- type, contract, badges ---------------------------------------------------------------------

_TYPE = (
    f"{_code('type', 'p[1]')} AS property_type, "
    f"CASE WHEN len(p) = 2 THEN {_code_any_case('ownership', 'p[2]')} WHEN len(p) > 2 THEN {_code('ownership', 'p[2]')} END AS ownership_type, "
    f"CASE WHEN len(p) = 2 AND {_code_any_case('ownership', 'p[2]')} IS NULL THEN {_code('class', 'p[2]')} "
    f"WHEN len(p) > 2 THEN {_code('class', 'p[3]')} END AS property_class"
)
_CONTRACT = (
    "CASE WHEN contains(contract_text, 'Vendita') THEN 'sale' WHEN contains(contract_text, 'Affitto') THEN 'rent' END AS contract_type, "
    "contains(lower(contract_text), 'riscatto') AS is_rent_to_own_available, "
    "CASE WHEN contains(lower(contract_text), 'libero') THEN 'available' WHEN contains(lower(contract_text), 'a reddito') THEN 'occupied' END AS current_availability"
)
_BADGES = "string_split(badges_text, ';')"
_IS_KNOWN = f"(x IN ({_FLAG_LABELS}) OR contains(x, 'Esposizione') OR contains(x, 'Impianto tv') OR contains(x, 'Infissi esterni'))"


def _last(word: str) -> str:
    return f"list_filter(b, lambda x: contains(x, '{word}'))[-1]"


def _glass(text: str) -> str:
    return (
        f"CASE WHEN contains(lower({text}), 'triplo vetro') THEN 'triple_glass' "
        f"WHEN contains(lower({text}), 'doppio vetro') THEN 'double_glass' WHEN contains(lower({text}), 'vetro') THEN 'single_glass' END"
    )


_POOL = "CASE WHEN list_contains(b, 'Piscina') THEN true END AS has_pool"
_FEATURE_TEXT = (
    f"coalesce(len(list_filter(b, lambda x: {_IS_KNOWN})), 0) = 0 AS no_features, "
    f"{_code('tv', _last('Impianto tv'))} AS tv_system, {_glass('w[1]')} AS window_glass_type, "
    f"{_code('window_material', 'w[2]')} AS window_material, {_last('Esposizione')} AS sun_exposure, " + _POOL
)
_WITH_BADGES = f"(SELECT *, {_parts(_last('Infissi esterni'), '/')} AS w FROM (SELECT *, {_BADGES} AS b FROM {{0}}) q1)"


def _place(i: int) -> str:
    return f"nullif(trim(string_split(address_text, '/')[{i}]), '')"


# --- whole rows -----------------------------------------------------------------------------------


def _details(page: bool) -> str:
    """A listing row from the raw texts, or from the page that shows them."""
    sqm_in = _line("price_sqm_text") if page else "price_sqm_text"
    sqm_text, sqm = _sqm(sqm_in)
    rooms = "CASE WHEN k % 10 = 0 THEN 9 ELSE " + _DIGITS.format("rooms_text", "bigint") + " END" if page else _DIGITS.format("rooms_text", "bigint")
    address = "coalesce(array_to_string(list_transform(string_split(address_text, '/'), lambda x: trim(x)), '/'), '')" if page else "address_text"
    city = "coalesce(string_split(address_text, '/')[1], '')" if page else "string_split(address_text, '/')[1]"
    description = _line("shown_description") if page else "trim(description_text)"
    no_location = "" if page else "WHEN address_text IS NULL THEN 'no_location' "
    year = _YEAR
    heading = "CASE WHEN trim(description_text) <> '' THEN 'Casa. bella' END" if page else "NULL::varchar"
    whole = lambda text: _DIGITS.format(text, "bigint")
    return (
        f"SELECT id, 'immobiliare' AS source, title, url, 1748772000::bigint AS fetch_epoch, {_UPDATED} AS updated_epoch, price_text AS formatted_price, {_PRICE} AS price_eur, "
        f"{_FEE_TEXT} AS formatted_maintenance_fee, round({_FEE}, 6) AS maintenance_fee, {sqm_text} AS formatted_price_sqm, {sqm} AS price_sqm, "
        f"type_text AS type, contract_text AS contract, condition_text AS condition, CASE WHEN k % 3 = 0 THEN true END AS is_luxury, "
        f"{_SURFACE_TEXT} AS surface_formatted, {_SURFACE} AS surface, {rooms} AS rooms, floor_text AS floor, {whole('floors_text')} AS total_floors, "
        f"{whole('baths_text')} AS bathrooms, {whole('beds_text')} AS bedrooms, {_ANSWER} AS balcony, {_yes('terrace_text')} AS terrace, {_yes('lift_text')} AS elevator, "
        f"garden_text AS garden, {_yes('cellar_text')} AS cellar, NULL::boolean AS basement, "
        f"furnished_text AS furnished, kitchen_text AS kitchen, {year} AS build_year, {_PORTER} AS concierge, {_yes('access_text')} AS is_accessible, "
        f"heating_text AS heating_type, cooling_text AS air_conditioning, {_ENERGY_CLASS} AS energy_class, "
        f"{city} AS city, 'IT' AS country, {address} AS address, parking_text AS parking_info, {heading} AS description_title, {description} AS description, "
        f"replace(badges_text, ';', '|') AS other_amenities, "
        f"CASE {no_location}WHEN trim(description_text) = '' THEN 'no_description' WHEN {_PRICE} IS NULL THEN 'bad_price' "
        f"WHEN coalesce({_SURFACE}, 0) = 0 THEN 'bad_surface' WHEN {year} NOT BETWEEN 1800 AND 2100 THEN 'build_year_out_of_range' END AS reject_reason "
        f"FROM {duck_texts()} t"
    )


_NOTHING = {"varchar": ("floor", "heating_type", "air_conditioning", "parking_info", "description_title"), "bigint": ("updated_epoch", "total_floors", "bedrooms"), "double": ("price_sqm",)}
_UNKNOWN = ", ".join(f"NULL::{kind} AS {c}" for kind, names in _NOTHING.items() for c in names)
_FLAGS = ", ".join(f"CASE WHEN list_contains(b, '{label}') THEN true END AS {code}" for label, code in pairs("feature"))
_RECORDS = (
    f"SELECT id, 'immobiliare' AS source, title, url, 1748772000::bigint AS fetch_epoch, 1748772000::bigint AS etl_epoch, cast(k AS double) AS price_eur, {_UNKNOWN}, "
    f"CASE WHEN k % 4 > 0 THEN cast(k % 300 AS double) END AS maintenance_fee, {_TYPE}, {_CONTRACT}, "
    f"{_code('condition', 'condition_text')} AS condition, CASE WHEN k % 3 = 0 THEN true END AS is_luxury, {_SURFACE_DECIMAL} AS surface, "
    f"k % 7 AS rooms, k % 3 AS bathrooms, k % 2 = 0 AS has_balcony, "
    + ", ".join(f"NULL::boolean AS {c}" for c in ("has_terrace", "has_elevator", "has_cellar", "has_basement", "has_concierge", "is_accessible"))
    + f", {_code('garden', 'garden_text')} AS garden, {_code('furnished', 'furnished_text')} AS furnished, "
    f"{_code('kitchen', 'kitchen_text')} AS kitchen, least(cast(year_text AS bigint), 2147483647) AS build_year, energy_text AS energy_class, "
    f"'IT' AS country, 'Milano' AS city, {_place(2)} AS zone, {_place(3)} AS address, trim(description_text) AS description, {_FEATURE_TEXT.replace(_POOL, _FLAGS)}, "
    f"o_orderstatus FROM (SELECT *, {_parts('type_text', '|')} AS p FROM {_WITH_BADGES.format(duck_texts() + ' q0')} q2) t"
)
_RECORD_REASON = (
    "CASE WHEN property_type IS NULL THEN 'unknown_type' WHEN contract_type IS NULL THEN 'unknown_contract' WHEN surface IS NULL THEN 'bad_surface' "
    f"ELSE nullif(concat_ws(',', CASE WHEN build_year NOT BETWEEN 1800 AND 2100 THEN 'build_year_out_of_range' END, "
    f"CASE WHEN energy_class NOT IN ({_ENERGY}) THEN 'energy_class_not_allowed' END), '') END"
)

# What a record takes over from its listing as it is.
_KEPT = (
    "id source title url fetch_epoch updated_epoch price_eur maintenance_fee price_sqm is_luxury rooms floor total_floors bathrooms bedrooms build_year is_accessible heating_type air_conditioning energy_class country city parking_info description_title description"
).split()

# --- similarity graph -------------------------------------------------------------------------------

_EDGES = (
    f"wide AS (SELECT * FROM {duck_similar()} s), "
    "slots AS (SELECT doc_id, 1 AS slot, id_ref AS src, id_similar_1 AS dst, sim1 AS score FROM wide "
    "UNION ALL SELECT doc_id, 2, id_ref, id_similar_2, sim2 FROM wide), "
    "edges AS (SELECT src, dst, max(score) AS score FROM slots WHERE dst IS NOT NULL GROUP BY src, dst), "
    "nodes AS (SELECT cast(doc_id AS varchar) AS id, lang || ' ' || source AS text FROM documents), "
    "walk AS (SELECT src AS a, dst AS b, score, src AS via FROM edges UNION ALL SELECT dst, src, score, src FROM edges WHERE src <> dst)"
)
_HOPS = (
    "hops AS (SELECT a AS start, b AS node, 1 AS distance, NULL AS mid, score AS score1, NULL AS score2, via AS via1, NULL AS via2 FROM walk WHERE a <> b "
    "UNION ALL SELECT x.a, y.b, 2, x.b, x.score, y.score, x.via, y.via FROM walk x JOIN walk y ON x.b = y.a WHERE x.a <> y.b)"
)
_WANTED = "(SELECT cast(doc_id AS varchar) FROM labels)"
_NEIGHBOURS = (
    f"WITH {_EDGES}, {_HOPS} SELECT h.start, h.node, n.text, cast(h.distance AS bigint) AS distance, "
    "round(max(CASE h.distance WHEN 1 THEN score1 ELSE score1 + score2 END), 6) AS score "
    "FROM hops h JOIN nodes n ON n.id = h.node {where} GROUP BY h.start, h.node, n.text, h.distance"
)
_EXACT = _NEIGHBOURS.replace("round(max(", "max(").replace("END), 6) AS score", "END) AS score")
_STRONG = (
    f"WITH {_EDGES.replace('FROM edges UNION', 'FROM edges WHERE score > 0.7 UNION').replace('WHERE src <> dst', 'WHERE src <> dst AND score > 0.7')}, {_HOPS}, "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY start, node ORDER BY distance, mid, via1, via2) AS r FROM hops), "
    "best AS (SELECT h.start, h.node, cast(distance AS bigint) AS distance, mid, cast(score1 AS double) AS score1, cast(score2 AS double) AS score2, "
    "s.text AS start_text, n.text AS node_text, m.text AS mid_text FROM ranked h JOIN nodes s ON s.id = h.start "
    "JOIN nodes n ON n.id = h.node LEFT JOIN nodes m ON m.id = h.mid WHERE r = 1) "
)


_SPARSE = ("id", "fee_text", "condition_text", "garden_text", "badges_text")


def _gate(limit: int, pages: int, success: float, crawl: str = "floor(event_id / 5000)", page: str = "floor(event_id / 50)", over: str = "page = last_page", unchanged: str = "false") -> str:
    return (
        f"WITH batches AS (SELECT cast({crawl} AS bigint) AS crawl_id, cast({page} AS bigint) AS page, count(*) AS scraped, "
        "count(*) FILTER (WHERE event_type <> 'error') AS inserted FROM events GROUP BY 1, 2), "
        f"limits AS (SELECT b.crawl_id, min(page) AS end_at FROM batches b JOIN (SELECT crawl_id, min(page) AS first FROM batches GROUP BY crawl_id) f ON f.crawl_id = b.crawl_id WHERE page >= first + {pages} GROUP BY b.crawl_id), "
        "running AS (SELECT *, cast(sum(scraped) OVER w AS bigint) AS total_scraped, cast(sum(inserted) OVER w AS bigint) AS total_inserted, "
        "min(page) OVER (PARTITION BY crawl_id) AS first_page, max(page) OVER (PARTITION BY crawl_id) AS last_page FROM batches WINDOW w AS (PARTITION BY crawl_id ORDER BY page)), "
        "judged AS (SELECT *, total_inserted / total_scraped AS success, "
        f"CASE WHEN total_scraped >= {limit} THEN 'listing_limit' WHEN page >= first_page + {pages} THEN 'max_pages' "
        f"WHEN total_inserted / total_scraped < {success} THEN 'low_success' WHEN {over} THEN 'no_next_page' WHEN {unchanged} THEN 'page_unchanged' END AS stop_reason "
        "FROM running LEFT JOIN limits USING (crawl_id) WHERE page <= coalesce(end_at, page)), "
        "ends AS (SELECT crawl_id, min(page) AS end_page FROM judged WHERE stop_reason IS NOT NULL GROUP BY crawl_id) "
        "SELECT j.crawl_id, j.page, cast(scraped AS bigint) AS scraped, cast(inserted AS bigint) AS inserted, total_scraped, total_inserted, round(success, 6) AS success, stop_reason "
        "FROM judged j LEFT JOIN ends e ON e.crawl_id = j.crawl_id WHERE e.end_page IS NULL OR j.page <= e.end_page"
    )


def _merged(url: str, changes: dict[str, str], added: list[tuple[str, str]]) -> str:
    """Query string with the first value of each key, some values replaced and some pairs added."""
    query = f"string_split(string_split({url}, '#')[1], '?')[2]"
    # Pages with parameters show either page, q, ref, page again and an empty one, or a single source.
    full = "&".join(f"{k}={changes.get(k, v)}" for k, v in [("page", "2"), ("q", "a+b"), ("ref", "x"), ("vuoto", "")])
    more = "&".join(f"{k}={v}" for k, v in added if k not in ("page", "q", "ref", "vuoto"))
    rest = "&".join(f"{k}={v}" for k, v in added)
    base = f"string_split(string_split({url}, '#')[1], '?')[1]"
    fragment = f"CASE WHEN contains({url}, '#') THEN '#' || string_split({url}, '#')[2] ELSE '' END"
    return (
        f"{base} || '?' || CASE WHEN contains({query}, 'ref=x') THEN '{full}&{more}' "
        f"WHEN coalesce({query}, '') <> '' THEN {query} || '&{rest}' ELSE '{rest}' END || {fragment}"
    )


_EDGE = "concat_ws('>', s.via, CASE WHEN s.via = s.a THEN s.b ELSE s.a END)"
_FAR = (
    f"WITH RECURSIVE {_EDGES}, w(start, node, distance, used, total) AS (SELECT '{START}', '{START}', 0, []::VARCHAR[], 0::DOUBLE UNION ALL "
    f"SELECT w.start, s.b, w.distance + 1, list_append(w.used, {_EDGE}), w.total + s.score FROM w JOIN walk s ON s.a = w.node "
    f"WHERE w.distance < {FAR} AND NOT list_contains(w.used, {_EDGE})) "
    "SELECT w.start, w.node, concat_ws(' ', d.lang, d.source) AS text, cast(w.distance AS bigint) AS distance, round(max(w.total), 6) AS score "
    "FROM w JOIN documents d ON cast(d.doc_id AS varchar) = w.node WHERE w.node <> w.start GROUP BY ALL"
)
_STRONG_EDGES = _EDGES.replace("FROM edges UNION", "FROM edges WHERE score > 0.7 UNION").replace("WHERE src <> dst", "WHERE src <> dst AND score > 0.7")
_STRONG_FAR = (
    f"WITH RECURSIVE {_STRONG_EDGES}, r(start, node, distance) AS (SELECT DISTINCT cast(doc_id AS varchar), cast(doc_id AS varchar), 0 FROM labels UNION "
    f"SELECT r.start, s.b, r.distance + 1 FROM r JOIN walk s ON s.a = r.node WHERE r.distance < {FARTHEST}), "
    "d AS MATERIALIZED (SELECT start, node, min(distance) AS distance FROM r GROUP BY ALL), "
    "b AS MATERIALIZED (SELECT start, node, distance, before, score FROM (SELECT y.start, y.node, y.distance, x.node AS before, s.score, "
    "row_number() OVER (PARTITION BY y.start, y.node ORDER BY x.node, s.via) AS k "
    "FROM d y JOIN walk s ON s.b = y.node JOIN d x ON x.start = y.start AND x.node = s.a AND x.distance = y.distance - 1) q WHERE k = 1), "
    "p(start, node, distance, walk, score) AS (SELECT start, node, 0, start, 0::DOUBLE FROM d WHERE distance = 0 UNION ALL "
    "SELECT b.start, b.node, b.distance, p.walk || '>' || b.node, p.score + b.score FROM p JOIN b ON b.start = p.start AND b.before = p.node AND b.distance = p.distance + 1) "
    "SELECT p.start, p.node, cast(p.distance AS bigint) AS distance, p.walk, round(p.score, 6) AS score, concat_ws(' ', n.lang, n.source) AS node_text "
    "FROM p JOIN documents n ON cast(n.doc_id AS varchar) = p.node WHERE p.distance > 0"
)
_VOID = ", ".join(f"'{t}'" for t in VOID)
_ELEMENTS = rf"""
WITH t AS (SELECT page_id, string_split(html, '<') AS w FROM pages),
p AS (SELECT page_id, len(w) AS size, unnest(w) AS piece, unnest(range(0, len(w))) AS pos FROM t),
g AS (SELECT page_id, size, pos, lower(regexp_extract(piece, '^/?([A-Za-z][A-Za-z0-9]*)[\s>/]', 1)) AS tag, starts_with(piece, '/') AS closing,
      regexp_matches(piece, '^[^>]*/>') AS self FROM p WHERE pos > 0),
e AS (SELECT page_id, size, pos, tag, closing FROM g WHERE tag <> '' UNION ALL
      SELECT page_id, size, pos, tag, true FROM g WHERE tag <> '' AND NOT closing AND (self OR tag IN ({_VOID}))),
r AS (SELECT *, sum(CASE WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, tag ORDER BY pos, closing ROWS UNBOUNDED PRECEDING) AS after,
      sum(CASE WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY pos, closing ROWS UNBOUNDED PRECEDING) AS depth FROM e),
m AS (SELECT *, lead(pos) OVER k AS next_pos, lead(closing) OVER k AS next_closing
      FROM (SELECT *, CASE WHEN closing THEN after + 1 ELSE after END AS level FROM r) WINDOW k AS (PARTITION BY page_id, tag, level ORDER BY pos, closing)),
x AS MATERIALIZED (SELECT page_id, size, tag, depth, pos AS "begin", CASE WHEN next_closing THEN next_pos ELSE size END AS stop FROM m WHERE NOT closing)
"""


def oracle_sql() -> dict[str, str]:
    sqm_text, sqm = _sqm("price_sqm_text")
    not_finished = f"FROM {duck_texts()} t WHERE o_orderstatus"
    records_todo = f"SELECT id, type_text AS type, contract_text AS contract {not_finished} = 'P'"
    first_documents = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS r FROM documents) q WHERE r = 1"
    owner = "trim(string_split(type_text, '|')[2])"
    n_orders = "(SELECT count(*) FROM orders)"
    n_finished = "(SELECT count(*) FROM orders WHERE o_orderstatus = 'F')"
    known_title = "CASE WHEN o_orderstatus = 'F' THEN 'known ' || title ELSE title END AS title"
    three_cards = (
        "SELECT k, 0::bigint AS position, url AS link, title, card_text, url FROM t UNION ALL SELECT k, 1, url, NULL, '', url FROM t "
        "UNION ALL SELECT k, 2, NULL, NULL, '', url FROM t"
    )
    source_id = "nullif(regexp_extract(link, '/annunci/([0-9]+)/?$', 1), '')"
    sql = {
        "parse_price": f"SELECT k, price_text, {_PRICE} AS price_eur {_from('price_text')}",
        "parse_price_sqm": f"SELECT k, {sqm_text} AS text, {sqm} AS value {_from('price_sqm_text')}",
        "parse_monthly_fee": f"SELECT k, {_FEE_TEXT} AS text, {_FEE} AS value {_from('fee_text')}",
        "parse_surface_int": f"SELECT k, {_SURFACE_TEXT} AS text, {_SURFACE} AS value {_from('surface_text')}",
        "parse_surface_decimal": f"SELECT k, {_SURFACE_DECIMAL} AS raw_m2, {_SURFACE_DECIMAL} AS formatted_sqm {_from('surface_text')}",
        "parse_first_int": f"SELECT k, {_DIGITS.format('rooms_text', 'bigint')} AS rooms, {_YEAR} AS build_year "
        + _from("rooms_text", "year_text"),
        "parse_yes_no": f"SELECT k, {_ANSWER} AS answer {_from('answer_text')}",
        "parse_concierge": f"SELECT k, {_PORTER} AS concierge {_from('porter_text')}",
        "parse_energy_class": f"SELECT k, {_ENERGY_CLASS} AS energy_class {_from('energy_text')}",
        "parse_update_date": f"SELECT k, {_UPDATED} AS updated_epoch {_from('update_text')}",
        "url_listing_id": f"SELECT k, nullif(regexp_extract(trim(url), '/annunci/([0-9]+)/?$', 1), '') AS listing_id {_from('url')}",
        "url_last_segment": f"SELECT k, string_split(trim(url, '/'), '/')[-1] AS segment {_from('url')}",
        "listing_key": "SELECT o_orderkey AS k, 'immobiliare:' || o_orderkey AS id FROM orders",
        "url_page_number": "SELECT page_id, coalesce(try_cast(regexp_extract(url, 'page=([0-9]+)', 1) AS bigint), 1) AS page FROM pages",
        "url_params": "SELECT page_id, "
        + _merged("url", {}, [("criterio", "data"), ("ordine", "desc"), ("noAste", "1")])
        + " AS with_defaults, "
        + _merged("url", {"ref": "z"}, [("ref", "z"), ("ordine", "desc")])
        + " AS with_ref FROM pages",
        "normalize_text": f"SELECT doc_id, length(line) AS n_line, md5(line) AS line_md5 FROM (SELECT doc_id, {_line('text')} AS line FROM documents) q",
        "split_composite": f"SELECT k, array_to_string(p, '+') AS parts, len(p) AS n_parts, array_to_string(s, '+') AS spaced_parts FROM "
        f"(SELECT k, {_parts('type_text', '|')} AS p, {_parts('type_text', ' | ')} AS s {_from('type_text')}) q",
        "split_address": f"SELECT k, {_place(2)} AS zone, {_place(3)} AS street {_from('address_text')}",
        "location_fields": f"SELECT k, string_split(address_text, '/')[1] AS city, 'IT' AS country, address_text AS address {_from('address_text')}",
        "vocab_lookup": _VOCAB
        + f"SELECT k, {_code('condition', 'condition_text')} AS condition, {_code('garden', 'garden_text')} AS garden, "
        f"{_code('furnished', 'furnished_text')} AS furnished, {_code('kitchen', 'kitchen_text')} AS kitchen, "
        f"{_code('ownership', owner)} AS owner_exact, {_code_any_case('ownership', owner)} AS owner_any_case "
        + _from("condition_text", "garden_text", "furnished_text", "kitchen_text", "type_text"),
        "type_triple": _VOCAB + f"SELECT k, {_TYPE} FROM (SELECT k, {_parts('type_text', '|')} AS p {_from('type_text')}) q",
        "contract_triple": f"SELECT k, {_CONTRACT} {_from('contract_text')}",
        "window_pair": _VOCAB
        + f"SELECT k, badge, {_glass('w[1]')} AS window_glass_type, {_code('window_material', 'w[2]')} AS window_material FROM "
        f"(SELECT k, badge, {_parts('badge', '/')} AS w FROM (SELECT k, unnest({_BADGES}) AS badge {_from('badges_text')}) q) q2",
        "feature_flags": f"SELECT k, {_FLAGS} FROM (SELECT k, {_BADGES} AS b {_from('badges_text')}) q",
        "feature_text": _VOCAB + f"SELECT k, {_FEATURE_TEXT} FROM {_WITH_BADGES.format(duck_texts(['badges_text']) + ' q0')} t",
        "unknown_terms": _VOCAB
        + f", base AS (SELECT *, {_parts('type_text', '|')} AS p FROM {duck_texts()} q), "
        f"badge AS (SELECT unnest({_BADGES}) AS x FROM base), pane AS (SELECT {_parts('x', '/')} AS w FROM badge WHERE contains(x, 'Infissi esterni')), "
        f"terms AS (SELECT 'property_type' AS field, p[1] AS term FROM base WHERE {_code('type', 'p[1]')} IS NULL "
        f"UNION ALL SELECT 'ownership_type', p[2] FROM base WHERE len(p) > 2 AND {_code('ownership', 'p[2]')} IS NULL AND {_code('type', 'p[1]')} IS NOT NULL "
        f"UNION ALL SELECT 'property_class', p[3] FROM base WHERE len(p) > 2 AND {_code('class', 'p[3]')} IS NULL AND {_code('type', 'p[1]')} IS NOT NULL "
        f"UNION ALL SELECT 'property_class', p[2] FROM base WHERE len(p) = 2 AND {_code_any_case('ownership', 'p[2]')} IS NULL AND {_code('class', 'p[2]')} IS NULL AND {_code('type', 'p[1]')} IS NOT NULL "
        + "".join(
            f"UNION ALL SELECT '{c}', {c}_text FROM base WHERE {c}_text IS NOT NULL AND {_code(c, c + '_text')} IS NULL "
            for c in ("condition", "garden", "furnished", "kitchen")
        )
        + f"UNION ALL SELECT 'other_amenities', x FROM badge WHERE NOT {_IS_KNOWN} "
        f"UNION ALL SELECT 'tv_system', x FROM badge WHERE contains(x, 'Impianto tv') AND {_code('tv', 'x')} IS NULL "
        f"UNION ALL SELECT 'window_glass_type', w[1] FROM pane WHERE {_glass('w[1]')} IS NULL "
        f"UNION ALL SELECT 'window_material', w[2] FROM pane WHERE w[2] IS NOT NULL AND {_code('window_material', 'w[2]')} IS NULL) "
        "SELECT field, term, count(*) AS n FROM terms GROUP BY field, term",
        "harvest_links": "SELECT page_id, position, link, nullif(title, '') AS title, NULL::varchar AS source_id, CASE WHEN title = '' THEN 'no_title' ELSE 'no_id' END AS skip_reason FROM (SELECT page_id, "
        "unnest(range(len(links))) AS position, unnest(links) AS link, unnest(titles) AS title FROM (SELECT page_id, "
        "regexp_extract_all(html, '<li><a href=\"([^\"]*)\">([^<]*)</a></li>', 1) AS links, "
        "regexp_extract_all(html, '<li><a href=\"([^\"]*)\">([^<]*)</a></li>', 2) AS titles FROM pages) q) q2",
        "harvest_cards": f"WITH t AS (SELECT * {_from('url', 'title', 'card_text')}), cards AS ({three_cards}) SELECT k, position, link, title, {source_id} AS source_id, "
        f"CASE WHEN link IS NULL THEN 'no_link' WHEN title IS NULL THEN 'no_title' WHEN {source_id} IS NULL THEN 'no_id' "
        "WHEN contains(lower(card_text), 'da €') THEN 'auction' END AS skip_reason FROM cards",
        "auction_filter": f"SELECT k, card_text {_from('card_text')} WHERE NOT contains(lower(card_text), 'da €')",
        "dtdd_map": "SELECT k, " + " + ".join(f"({c} IS NOT NULL)::bigint" for c in CHARACTERISTICS.values())
        + " + (rooms_text IS NULL AND k % 10 = 0)::bigint AS n_pairs, type_text AS kind, contract_text AS contract, surface_text AS surface, "
        "CASE WHEN k % 10 = 0 THEN '9 locali' ELSE rooms_text END AS rooms, garden_text AS garden " + _from(*CHARACTERISTICS.values()),
        "dtdd_lookup": f"SELECT k, {_line('fee_text')} AS fee, {_line('price_sqm_text')} AS price_sqm {_from('fee_text', 'price_sqm_text')}",
        "badge_array": f"SELECT k, coalesce(len({_BADGES}), 0) AS n_badges, coalesce(array_to_string({_BADGES}, '|'), '') AS badges {_from('badges_text')}",
        "luxury_flag": f"SELECT k, CASE WHEN k % 3 = 0 THEN true END AS luxury, energy_text AS energy {_from('energy_text')}",
        "page_fields": f"SELECT k, title AS page_title, price_text, "
        "coalesce(array_to_string(list_transform(string_split(address_text, '/'), lambda x: trim(x)), '/'), '') AS location, "
        f"CASE WHEN trim(description_text) <> '' THEN 'Casa. bella' END AS description_title, {_line('shown_description')} AS description, "
        f"NULL::varchar AS page_problem {_from('title', 'price_text', 'address_text', 'description_text', 'shown_description')}",
        "crawl_gate": _gate(2000, 80, 0.3),
        "crawl_gate_pages": _gate(1_000_000, 30, 0.1),
        "crawl_gate_success": _gate(1_000_000, 80, 0.8),
        "crawl_gate_moves": _gate(1_000_000, 80, 0.1, over="page % 23 = 0", unchanged="page % 17 = 0"),
        "crawl_gate_hot": _gate(1_000_000, 1500, 0.1, "CASE WHEN event_id % 3 = 0 THEN -1 ELSE floor(event_id / 5000) END", "floor(event_id / 10)"),
        "crawl_gate_unbounded": _gate(1_000_000, 10**9, 0.1, "CASE WHEN event_id % 3 = 0 THEN -1 ELSE floor(event_id / 5000) END", "floor(event_id / 10)"),
        "require_fields": "SELECT id, CASE WHEN address_text IS NULL THEN 'no_location' WHEN trim(description_text) = '' THEN 'no_description' END AS reason "
        + _from("id", "address_text", "description_text"),
        "build_details": _details(page=False),
        "page_details": _details(page=True),
        "etl_listing_records": _VOCAB + f"SELECT * EXCLUDE (o_orderstatus) FROM ({_RECORDS}) r WHERE o_orderstatus <> 'F' AND {_RECORD_REASON} IS NULL",
        "record_rejects": _VOCAB + f"SELECT * EXCLUDE (o_orderstatus), {_RECORD_REASON} AS reject_reason FROM ({_RECORDS}) r WHERE {_RECORD_REASON} IS NOT NULL",
        "validate_listings": "SELECT id, nullif(concat_ws(',', CASE WHEN k % 110 = 0 THEN 'title_missing' END, "
        "CASE WHEN k % 70 <> 0 AND (k % 75 = 0 OR k % 77 = 0) THEN 'price_eur_not_finite' END, CASE WHEN k % 70 = 0 THEN 'price_eur_negative' END, "
        "CASE WHEN k % 30 = 0 THEN 'type_empty' END, CASE WHEN cast(year_text AS bigint) NOT BETWEEN 1800 AND 2100 THEN 'build_year_out_of_range' END, "
        f"CASE WHEN energy_text NOT IN ({_ENERGY}) THEN 'energy_class_not_allowed' END), '') AS failed_rules {_from('id', 'year_text', 'energy_text')}",
        "validate_ids": "SELECT id, nullif(concat_ws(',', CASE WHEN k % 30 = 0 THEN 'title_missing' END, CASE WHEN k % 45 = 0 THEN 'url_missing' END), '') AS failed_rules " + _from("id"),
        "load_or_fail": "SELECT id, title, NULL::varchar AS failed_rules " + _from("id", "title"),
        "page_articles": "SELECT page_id, nullif(trim(replace(replace(regexp_extract(html, '<h1>([^<]*)', 1), '&quot;', '\"'), '&amp;', '&')), '') AS heading, "
        "len(string_split(html, '<p>')) - 1 AS n_paragraphs FROM pages",
        "head_documents": "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5",
        "three_layers": _VOCAB
        + f", listing AS ({_details(page=True)}), record AS ({_RECORDS.replace('o_orderstatus FROM', 'card_text, FROM')}) "
        f"SELECT {', '.join('l.' + c for c in _KEPT)}, l.balcony AS has_balcony, l.terrace AS has_terrace, l.elevator AS has_elevator, l.cellar AS has_cellar, "
        f"l.basement AS has_basement, l.concierge AS has_concierge, r.* EXCLUDE ({', '.join(_KEPT)}, has_balcony, has_terrace, has_elevator, has_cellar, has_basement, has_concierge, card_text) "
        "FROM listing l JOIN record r ON r.id = l.id "
        "WHERE l.reject_reason IS NULL AND r.property_type IS NOT NULL AND r.contract_type IS NOT NULL "
        "AND regexp_matches(l.url, '/annunci/[0-9]+/?$') AND NOT contains(lower(r.card_text), 'da €')",
        "pending_bucketed": f"SELECT id, url {_from('id', 'url')} WHERE o_orderstatus <> 'F'",
        "pending_details": f"SELECT id, url {_from('id', 'url')} WHERE o_orderstatus <> 'F'",
        "pending_records": records_todo,
        "sample_pending": f"SELECT * FROM ({records_todo}) q ORDER BY md5('{SEED}' || id), id LIMIT {MAPPING_SAMPLE}",
        "lookup_array": "SELECT c_custkey, count(o_orderkey) AS n_matches FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
        "lookup_matches": "SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
        "dedupe_content": "SELECT min(doc_id) AS doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents GROUP BY text, lang, source, n_chars",
        "dedupe_key": f"SELECT lang, source, doc_id, n_chars, md5(text) AS text_md5 FROM ({first_documents}) q",
        "find_nested": f"SELECT source, doc_id FROM ({first_documents}) q WHERE lang = 'en'",
        "replace_table": f"SELECT lang, source, doc_id FROM ({first_documents}) q",
        "count_docs": "SELECT 'all' AS question, count(*) AS n FROM documents UNION ALL SELECT 'lang=en', count(*) FROM documents WHERE lang = 'en'",
        "find_eq": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'fr'",
        "find_one": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 1",
        "find_by_key": "SELECT asked_by, c_custkey, c_name FROM customer, (VALUES ('number'), ('converted')) a(asked_by) WHERE c_custkey = 42",
        "range_sorted": "SELECT user_id, event_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00' ORDER BY user_id NULLS FIRST, event_id",
        "union_sparse": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::double AS balance FROM customer "
        "UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier",
        "sparse_json": "SELECT '{' || concat_ws(',', '\"k\":' || k, " + ", ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in _SPARSE) + ") || '}' AS json " + _from(*_SPARSE),
        "insert_ignore": f"SELECT id, {known_title}, {n_orders} - {n_finished} AS inserted, 2 * {n_orders} - ({n_orders} - {n_finished}) AS skipped, "
        f"0::bigint AS inserted_again {_from('id', 'title')}",
        "stream_insert_ignore": f"SELECT id, {known_title}, url {_from('id', 'title', 'url')}",
        "csv_roundtrip": "SELECT id, 'immobiliare' AS source, title, url, 1748772000::bigint AS fetch_epoch, NULL::bigint AS updated_epoch, price_text AS formatted_price, "
        "cast(k AS double) AS price_eur, CASE WHEN k % 4 > 0 THEN cast(k % 300 AS double) END AS maintenance_fee, type_text AS type, contract_text AS contract, "
        "condition_text AS condition, CASE WHEN k % 3 = 0 THEN true END AS is_luxury, replace(surface_text, 'm²', 'sqm') AS surface_formatted, k % 7 AS rooms, k % 3 AS bathrooms, "
        "k % 2 = 0 AS balcony, garden_text AS garden, furnished_text AS furnished, kitchen_text AS kitchen, least(cast(year_text AS bigint), 2147483647) AS build_year, "
        "energy_text AS energy_class, 'Milano' AS city, 'IT' AS country, address_text AS address, trim(description_text) AS description, replace(badges_text, ';', '|') AS other_amenities, "
        + ", ".join(
            f"NULL::{kind} AS {c}"
            for kind, names in {
                "varchar": "formatted_maintenance_fee formatted_price_sqm floor heating_type air_conditioning parking_info description_title",
                "double": "price_sqm surface",
                "bigint": "total_floors bedrooms",
                "boolean": "terrace elevator cellar basement concierge is_accessible",
            }.items()
            for c in names.split()
        )
        + ", nullif(concat_ws(',', CASE WHEN cast(year_text AS bigint) NOT BETWEEN 1800 AND 2100 THEN 'build_year_out_of_range' END, "
        f"CASE WHEN energy_text NOT IN ({_ENERGY}) THEN 'energy_class_not_allowed' END), '') AS failed_rules {_from()}",
        "csv_append": f"SELECT id, source_id, title, 2 * {n_orders} AS n_appended {_from('id', 'source_id', 'title')}, (VALUES (1), (2)) twice(i)",
        "wide_to_edges": f"WITH {_EDGES} SELECT src, dst, score, slot::bigint AS slot FROM slots WHERE dst IS NOT NULL",
        "merge_nodes": f"WITH {_EDGES}, named AS (SELECT doc_id, 0 AS slot, id_ref AS id, text_ref AS text FROM wide UNION ALL "
        "SELECT doc_id, 1, id_similar_1, text_similar_1 FROM wide UNION ALL SELECT doc_id, 2, id_similar_2, text_similar_2 FROM wide), "
        "known AS (SELECT cast(doc_id AS varchar) AS id, 'label ' || quality AS text FROM labels), "
        "firsts AS (SELECT id, text, row_number() OVER (PARTITION BY id ORDER BY doc_id, slot) AS r FROM named WHERE id IS NOT NULL) "
        "SELECT id, text FROM known UNION ALL SELECT id, text FROM firsts WHERE r = 1 AND id NOT IN (SELECT id FROM known)",
        "merge_edges": f"WITH {_EDGES}, tagged AS (SELECT s.*, d.lang FROM slots s JOIN documents d USING (doc_id) WHERE dst IS NOT NULL), "
        "written AS (SELECT src, dst, max(score) + 10 AS score, 0 AS pass, 0 AS doc_id, 0 AS slot FROM tagged WHERE lang = 'en' GROUP BY src, dst UNION ALL "
        "SELECT src, dst, score, pass, doc_id, slot FROM (SELECT src, dst, score, 1 AS pass, doc_id, slot FROM tagged UNION ALL "
        "SELECT src, dst, 1 - score, 2, doc_id, slot FROM tagged WHERE lang = 'fr') n "
        "WHERE src IN (SELECT cast(doc_id AS varchar) FROM labels) AND dst IN (SELECT cast(doc_id AS varchar) FROM labels)) "
        "SELECT src, dst, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY pass DESC, doc_id DESC, slot DESC) AS r "
        "FROM written) q WHERE r = 1",
        "strong_paths": _STRONG + f"SELECT * EXCLUDE (start_text) FROM best WHERE start = '{START}'",
        "strong_paths_all": _STRONG + f"SELECT * EXCLUDE (start_text) FROM best WHERE start IN {_WANTED}",
        "neighbourhood": _NEIGHBOURS.format(where=f"WHERE h.start = '{START}'"),
        "neighbourhood_all": _NEIGHBOURS.format(where=f"WHERE h.start IN {_WANTED}"),
        "neighbourhood_far": _FAR,
        "best_neighbours": "SELECT start, node, text, distance, round(score, 6) AS score, place FROM ("
        "SELECT *, row_number() OVER (PARTITION BY start ORDER BY distance, score DESC NULLS FIRST, node) AS place FROM ("
        + _EXACT.format(where=f"WHERE h.start IN {_WANTED}") + f") q) r WHERE place <= {BEST}",
        "strong_walks_far": _STRONG_FAR,
        "page_elements": _ELEMENTS + 'SELECT page_id, tag, count(*) AS n, max(depth)::BIGINT AS deepest, count(*) FILTER (stop = size) AS unclosed, '
        'min("begin")::BIGINT AS first, sum(stop - "begin")::BIGINT AS span FROM x GROUP BY page_id, tag',
        "element_path": _ELEMENTS + "SELECT page_id, first::BIGINT AS \"begin\", md5(regexp_replace(w[first + 1], '^[^>]*>', '') || "
        "CASE WHEN stop - first > 1 THEN '<' || array_to_string(w[first + 2:stop], '<') ELSE '' END) AS html_md5 "
        "FROM (SELECT page_id, x.\"begin\" AS first, stop FROM x WHERE tag = 'p' AND EXISTS (SELECT 1 FROM x a WHERE a.page_id = x.page_id AND a.tag = 'article' "
        "AND a.\"begin\" < x.\"begin\" AND x.stop <= a.stop)) q JOIN t USING (page_id)",
        "paths_json": _STRONG + "SELECT concat_ws('>', start, mid, node) AS walk, concat_ws('>', start_text, mid_text, node_text) AS texts, "
        f"round(score1 + coalesce(score2, 0), 6) AS score FROM best WHERE start IN {_WANTED}",
        "neighbours_csv": "SELECT start, text AS \"feedbackText\", distance, score FROM (" + _NEIGHBOURS.format(where=f"WHERE h.start IN {_WANTED}") + ") q",
    }
    sql["upsert_edges"] = sql["merge_edges"]
    sql["top_unknown_terms"] = (
        f"SELECT * FROM (SELECT field, term, n, row_number() OVER (PARTITION BY field ORDER BY n DESC, term) AS place FROM ({sql['unknown_terms']}) u) q WHERE place <= {TOP_TERMS}"
    )
    return sql
