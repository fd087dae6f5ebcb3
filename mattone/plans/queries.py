"""The registered queries: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mattone.functions import elements as E
from mattone.functions import html as H
from mattone.functions import numbers as N
from mattone.functions import text as T
from mattone.functions import urls as U
from mattone.operators import crawl, dedupe, details, docquery, graph, harvest, joins, records, validate
from mattone.plans import fixtures as X
from mattone.plans import jobs
from mattone.schemas import schema_of
from mattone.session import work_folder
from mattone.sources import bucketed, files, merged, tables
from mattone.streaming.layers import stream_layer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The start node of the single-start graph queries, the loaded batch sizes and the seed of the draws.
START = "7"
MAPPING_SAMPLE = 3000
SEED = "42"
# Hops of the longer graph queries.
FAR, FARTHEST = 4, 6
BEST = 3
TOP_TERMS = 5
LAYER_BUCKETS = 16
LINK_LIST = H.CardLayout(card=H.Node("li"), href_word="")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _text_query(name: str, columns: list[str], out: Callable[[], list[tuple[str, Column]]]) -> None:
    """Register expressions over the raw texts of every order; they are built when the query runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return X.listing_texts(spark, sf_dir, columns).select("k", *[c.alias(n) for n, c in out()])

    run.__name__ = name
    query(run)


def _flat(struct: Column, *fields: str) -> list[tuple[str, Column]]:
    return [(f, struct[f]) for f in fields]


def _epoch(c: Column) -> Column:
    return F.unix_seconds(c)


# --- numbers, answers, dates -------------------------------------------------------------------

_text_query(
    "parse_price",
    ["price_text"],
    lambda: [
        ("price_text", F.col("price_text")),
        ("price_eur", N.parse_price(F.col("price_text"))),
    ],
)
_text_query(
    "parse_price_sqm",
    ["price_sqm_text"],
    lambda: [
        *_flat(N.parse_price_sqm(F.col("price_sqm_text")), "text", "value"),
    ],
)
_text_query(
    "parse_monthly_fee",
    ["fee_text"],
    lambda: [
        *_flat(N.parse_monthly_fee(F.col("fee_text")), "text", "value"),
    ],
)
_text_query(
    "parse_surface_int",
    ["surface_text"],
    lambda: [
        *_flat(N.parse_surface_int(F.col("surface_text")), "text", "value"),
    ],
)
_text_query(
    "parse_surface_decimal",
    ["surface_text"],
    lambda: [
        ("raw_m2", N.parse_surface_decimal(F.col("surface_text"))),
        ("formatted_sqm", N.parse_surface_decimal(F.replace("surface_text", F.lit("m²"), F.lit("sqm")))),
    ],
)
_text_query(
    "parse_first_int",
    ["rooms_text", "year_text"],
    lambda: [
        ("rooms", N.parse_first_int(F.col("rooms_text")).cast("bigint")),
        ("build_year", N.parse_first_int(F.col("year_text")).cast("bigint")),
    ],
)
_text_query(
    "parse_yes_no",
    ["answer_text"],
    lambda: [
        ("answer", N.parse_yes_no(F.col("answer_text"))),
    ],
)
_text_query(
    "parse_concierge",
    ["porter_text"],
    lambda: [
        ("concierge", N.parse_concierge(F.col("porter_text"))),
    ],
)
_text_query(
    "parse_energy_class",
    ["energy_text"],
    lambda: [
        ("energy_class", N.parse_energy_class(F.col("energy_text"))),
    ],
)
_text_query(
    "parse_update_date",
    ["update_text"],
    lambda: [
        ("updated_epoch", _epoch(N.last_update(F.col("update_text")))),
    ],
)

# --- urls ------------------------------------------------------------------------------------

_text_query(
    "url_listing_id",
    ["url"],
    lambda: [
        ("listing_id", U.listing_id(F.col("url"))),
    ],
)
_text_query(
    "url_last_segment",
    ["url"],
    lambda: [
        ("segment", U.last_segment(F.col("url"))),
    ],
)
_text_query(
    "listing_key",
    ["source_id"],
    lambda: [
        ("id", T.listing_key(F.lit("immobiliare"), F.col("source_id"))),
    ],
)


@query
def url_page_number(spark, sf_dir):
    return X.load(spark, sf_dir, "pages").select("page_id", U.page_number(F.col("url"), "page").alias("page"))


@query
def url_params(spark, sf_dir):
    # A repeated parameter and an escaped blank ride along on the pages that have parameters.
    url = F.replace("url", F.lit("ref=x"), F.lit("q=a%20b&ref=x&page=9&vuoto="))
    return X.load(spark, sf_dir, "pages").select(
        "page_id",
        U.override_params(url).alias("with_defaults"),
        U.override_params(url, "ref=z&ordine=desc", None).alias("with_ref"),
    )


# --- text ------------------------------------------------------------------------------------


@query
def normalize_text(spark, sf_dir):
    line = T.normalize_text(F.col("text"))
    return X.load(spark, sf_dir, "documents").select(
        "doc_id", F.length(line).cast("bigint").alias("n_line"), F.md5(line).alias("line_md5")
    )


_text_query(
    "split_composite",
    ["type_text"],
    lambda: [
        ("parts", F.array_join(T.split_composite(F.col("type_text"), "|"), "+")),
        ("n_parts", F.size(T.split_composite(F.col("type_text"), "|")).cast("bigint")),
        ("spaced_parts", F.array_join(T.split_composite(F.col("type_text")), "+")),
    ],
)
_text_query(
    "split_address",
    ["address_text"],
    lambda: [
        *_flat(T.split_address(F.col("address_text")), "zone", "street"),
    ],
)
_text_query(
    "location_fields",
    ["address_text"],
    lambda: [
        *_flat(T.location_fields(F.split("address_text", "/")), "city", "country", "address"),
    ],
)

# --- vocabulary ------------------------------------------------------------------------------

_text_query(
    "vocab_lookup",
    ["condition_text", "garden_text", "furnished_text", "kitchen_text", "type_text"],
    lambda: [
        ("condition", records.vocab_lookup(F.col("condition_text"), "condition")),
        ("garden", records.garden_code(F.col("garden_text"))),
        ("furnished", records.vocab_lookup(F.col("furnished_text"), "furnished")),
        ("kitchen", records.vocab_lookup(F.col("kitchen_text"), "kitchen")),
        ("owner_exact", records.vocab_lookup(F.get(F.split("type_text", "[|]"), F.lit(1)), "ownership")),
        ("owner_any_case", records.vocab_lookup(F.get(F.split("type_text", "[|]"), F.lit(1)), "ownership", strict=False)),
    ],
)
_text_query(
    "type_triple",
    ["type_text"],
    lambda: [
        *_flat(records.type_triple(F.col("type_text")), "property_type", "ownership_type", "property_class"),
    ],
)
_text_query(
    "contract_triple",
    ["contract_text"],
    lambda: [
        *_flat(records.contract_triple(F.col("contract_text")), "contract_type", "is_rent_to_own_available", "current_availability"),
    ],
)


@query
def window_pair(spark, sf_dir):
    badges = X.listing_texts(spark, sf_dir, ["badges_text"]).select("k", F.explode(F.split("badges_text", ";")).alias("badge"))
    pair = records.window_pair(F.col("badge"))
    return badges.select("k", "badge", pair["window_glass_type"].alias("window_glass_type"), pair["window_material"].alias("window_material"))


def _badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = X.listing_texts(spark, sf_dir, ["badges_text"])
    return texts.select("k", records.clean_badges(F.split("badges_text", ";")).alias("badges"))


@query
def feature_flags(spark, sf_dir):
    return _badges(spark, sf_dir).select("k", *records.feature_flags(F.col("badges")))


@query
def feature_text(spark, sf_dir):
    whole = _badges(spark, sf_dir).select("k", records.features_or_null(F.col("badges")).alias("f"))
    return whole.select(
        "k",
        F.col("f").isNull().alias("no_features"),
        *[F.col(f"f.{c}").alias(c) for c in ("tv_system", "window_glass_type", "window_material", "sun_exposure", "has_pool")],
    )


@query
def unknown_terms(spark, sf_dir):
    return records.unknown_terms(X.details(spark, sf_dir))


@query
def top_unknown_terms(spark, sf_dir):
    """The terms that each field was met with most often, from sketches, counted exactly."""
    return records.top_unknown_terms(X.details(spark, sf_dir), TOP_TERMS).withColumn("place", F.col("place").cast("bigint"))


# --- pages -----------------------------------------------------------------------------------


@query
def harvest_links(spark, sf_dir):
    cards = harvest.harvest_cards(tables.read_pages(spark, f"{sf_dir}/pages.parquet"), LINK_LIST)
    return cards.select("page_id", F.col("position").cast("bigint").alias("position"), "link", "title", "source_id", "skip_reason")


@query
def page_articles(spark, sf_dir):
    """Heading and paragraphs of the saved pages as they are."""
    pages = tables.read_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", H.first_text(F.col("html"), (H.Node("h1"),)).alias("heading"), (F.size(F.split("html", "<p>")) - 1).cast("bigint").alias("n_paragraphs"))


@query
def page_elements(spark, sf_dir):
    """Elements of the saved pages per tag: how many, how deep, how many never closed, and the pieces they span."""
    table = E.with_elements(tables.read_pages(spark, f"{sf_dir}/pages.parquet"))
    each = E.listed(table.withColumn("size", F.size("pieces")), ["page_id", "size"])
    return each.groupBy("page_id", "tag").agg(
        F.count("*").alias("n"),
        F.max("depth").cast("bigint").alias("deepest"),
        F.count_if(F.col("end") == F.col("size")).alias("unclosed"),
        F.min("begin").cast("bigint").alias("first"),
        F.sum(F.col("end") - F.col("begin")).alias("span"),
    )


@query
def element_path(spark, sf_dir):
    """Markup inside every paragraph of an article, by containment."""
    table = E.with_elements(tables.read_pages(spark, f"{sf_dir}/pages.parquet"))
    found = E.select_path(table, (H.Node("article"), H.Node("p")), "found")
    shown = found.withColumn("found", F.transform("found", lambda e: F.struct(e["begin"].alias("begin"), E.inside(e).alias("html"))))
    return E.listed(shown, ["page_id"], "found").select("page_id", F.col("begin").cast("bigint").alias("begin"), F.md5("html").alias("html_md5"))


@query
def harvest_cards(spark, sf_dir):
    cards = harvest.harvest_cards(X.result_pages(spark, sf_dir))
    return cards.select("k", F.col("position").cast("bigint").alias("position"), "link", "title", "source_id", "skip_reason")


@query
def auction_filter(spark, sf_dir):
    return X.listing_texts(spark, sf_dir, ["card_text"]).where(~H.is_auction(F.col("card_text"))).select("k", "card_text")


@query
def dtdd_map(spark, sf_dir):
    pages = X.listing_pages(spark, sf_dir).select("k", "html")
    mapped = H.with_characteristics(pages)
    named = [("kind", "Tipologia"), ("contract", "Contratto"), ("surface", "Superficie"), ("rooms", "Locali"), ("garden", "Giardino")]
    return mapped.select(
        "k",
        F.size("characteristics").cast("bigint").alias("n_pairs"),
        *[F.try_element_at("characteristics", F.lit(label)).alias(c) for c, label in named],
    )


@query
def dtdd_lookup(spark, sf_dir):
    html = F.col("html")
    return X.listing_pages(spark, sf_dir).select(
        "k",
        H.labelled_value(html, H.FEE_LABEL, H.LISTING_PAGE.costs).alias("fee"),
        H.labelled_value(html, H.SQM_LABEL, H.LISTING_PAGE.price_info).alias("price_sqm"),
    )


@query
def badge_array(spark, sf_dir):
    found = X.listing_pages(spark, sf_dir).select("k", H.badges(F.col("html")).alias("badges"))
    return found.select("k", F.size("badges").cast("bigint").alias("n_badges"), F.array_join("badges", "|").alias("badges"))


@query
def luxury_flag(spark, sf_dir):
    html = F.col("html")
    return X.listing_pages(spark, sf_dir).select("k", H.luxury_flag(html).alias("luxury"), H.energy_attr(html).alias("energy"))


@query
def page_fields(spark, sf_dir):
    read = harvest.read_listing_pages(X.listing_pages(spark, sf_dir).select("k", "html"))
    return read.select(
        "k",
        "page_title",
        "price_text",
        F.array_join("location_parts", "/").alias("location"),
        "description_title",
        "description",
        "page_problem",
    )


@query
def crawl_gate(spark, sf_dir):
    return _gate(spark, sf_dir, 2000, 80, 0.3)


@query
def crawl_gate_pages(spark, sf_dir):
    return _gate(spark, sf_dir, 1_000_000, 30, 0.1)


@query
def crawl_gate_success(spark, sf_dir):
    return _gate(spark, sf_dir, 1_000_000, 80, 0.8)


@query
def crawl_gate_moves(spark, sf_dir):
    """Every 17th page stays where it is, every 23rd has no next one."""
    page = F.col("page")
    moved = F.when(page % 23 == 0, None).when(page % 17 == 0, page).otherwise(page + 1)
    gated = crawl.crawl_gate(_visits(spark, sf_dir).withColumn("to", moved), 1_000_000, 80, 0.1, next_page="to")
    return gated.withColumn("success", F.round("success", 6))


@query
def crawl_gate_hot(spark, sf_dir):
    """A third of all events are one crawl of many pages, each saved many times."""
    return crawl.crawl_gate(_hot_visits(spark, sf_dir), 1_000_000, 1500, 0.1).withColumn("success", F.round("success", 6))


@query
def crawl_gate_unbounded(spark, sf_dir):
    """The same crawls without a bound on their pages."""
    return crawl.crawl_gate(_hot_visits(spark, sf_dir), 1_000_000, None, 0.1).withColumn("success", F.round("success", 6))


def _hot_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    return _visits(spark, sf_dir).withColumns({"crawl_id": F.when(n % 3 == 0, -1).otherwise(F.col("crawl_id")), "page": F.floor(n / 10)})


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty events make a page, a hundred pages a crawl; an event that is no error was inserted."""
    page = F.floor(F.col("event_id") / 50)
    return X.load(spark, sf_dir, "events").select(
        "event_id", F.floor(page / 100).alias("crawl_id"), page.alias("page"), F.lit(1).alias("scraped"), (F.col("event_type") != "error").cast("int").alias("inserted")
    )


def _gate(spark: SparkSession, sf_dir: str, limit: int, pages: int, success: float) -> DataFrame:
    return crawl.crawl_gate(_visits(spark, sf_dir), limit, pages, success).withColumn("success", F.round("success", 6))


# --- the layers ------------------------------------------------------------------------------


@query
def require_fields(spark, sf_dir):
    return X.raw_listings(spark, sf_dir).select("id", details.require_fields().alias("reason"))


def _shown(rows: DataFrame, layer: str, *more: str) -> DataFrame:
    """All columns of a layer, in types that any engine prints alike, and some others."""
    out = []
    for f in schema_of(layer).fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if kind.startswith("struct"):
            out += [c.isNull().alias("no_features"), *[c[g.name].alias(g.name) for g in f.dataType.fields]]
        elif kind == "timestamp":
            out.append(_epoch(c).alias(f.name.replace("_date", "").replace("last_", "") + "_epoch"))
        elif kind.startswith("array"):
            out.append(F.array_join(c, "|").alias(f.name))
        else:
            out.append((c.cast("bigint") if kind == "int" else F.round(c, 6) if kind == "double" else c).alias(f.name))
    return rows.select(*out, *more)


def _details_out(built: DataFrame) -> DataFrame:
    return _shown(built, "listings", "reject_reason")


@query
def build_details(spark, sf_dir):
    return _details_out(details.build_details(X.raw_listings(spark, sf_dir), X.fetched_at()))


@query
def page_details(spark, sf_dir):
    raw = harvest.read_listing_pages(X.listing_pages(spark, sf_dir))
    return _details_out(details.build_details(raw, X.fetched_at()))


@query
def etl_listing_records(spark, sf_dir):
    """Listings without a record, normalised, checked and without the rejected ones."""
    done = X.listing_texts(spark, sf_dir, ["id"]).where("o_orderstatus = 'F'")
    todo = joins.pending(X.details(spark, sf_dir), done)
    good, _ = validate.split_rejects(records.normalise(todo, X.fetched_at()), "reject_reason")
    return _shown(good, "records")


@query
def record_rejects(spark, sf_dir):
    _, bad = validate.split_rejects(records.normalise(X.details(spark, sf_dir), X.fetched_at()), "reject_reason")
    return _shown(bad, "records", "reject_reason")


@query
def validate_listings(spark, sf_dir):
    k = F.substring_index("id", ":", -1).cast("bigint")
    price = F.when(k % 70 == 0, -1.0).when(k % 75 == 0, float("nan")).when(k % 77 == 0, float("inf")).otherwise(F.col("price_eur"))
    rows = X.details(spark, sf_dir).withColumn("price_eur", price).withColumn("type", F.when(k % 30 == 0, " ").otherwise(F.col("type")))
    checked = validate.validate(rows.withColumn("title", F.when(k % 110 > 0, F.col("title"))), "listings")
    return checked.select("id", "failed_rules")


@query
def validate_ids(spark, sf_dir):
    """Ids loaded from their table, some stored without a title or an address."""
    k = F.substring_index("id", ":", -1).cast("bigint")
    broken = _ids_layer(spark, sf_dir).drop("o_orderstatus").withColumns(
        {"title": F.when(k % 30 > 0, F.col("title")), "url": F.when(k % 45 > 0, F.col("url"))}
    )
    path = work_folder(spark, "ids")
    tables.insert_ignore(broken, path)
    return tables.read_layer_table(spark, path, "ids", errors="quarantine").select("id", "failed_rules")


@query
def load_or_fail(spark, sf_dir):
    """Ids that meet all rules, loaded so that the first one that did not would end the job."""
    path = work_folder(spark, "ids")
    tables.insert_ignore(_ids_layer(spark, sf_dir).drop("o_orderstatus"), path)
    return tables.read_layer_table(spark, path, "ids", errors="fail").select("id", "title", "failed_rules")


@query
def three_layers(spark, sf_dir):
    """Result pages to ids, pages of those ids to listings, listings to records."""
    root = work_folder(spark, "layers")
    jobs.store_ids(X.result_pages(spark, sf_dir), root, X.fetched_at(), ["k"])
    jobs.store_listings(X.listing_pages(spark, sf_dir).select("url", "html"), root, X.fetched_at())
    jobs.store_records(spark, root, X.fetched_at())
    stored = tables.read_layer_table(spark, f"{root}/records", "records")
    return _shown(stored, "records")


# --- joins, samples, duplicates, documents ----------------------------------------------------


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.listing_texts(spark, sf_dir, ["id", "source_id", "title", "url"])


@query
def pending_details(spark, sf_dir):
    ids = _ids(spark, sf_dir)
    return joins.pending(ids.select("id", "url"), ids.where("o_orderstatus = 'F'"))


@query
def pending_bucketed(spark, sf_dir):
    """The same from two stored layers that Spark knows as bucketed alike: neither is shuffled."""
    ids = _ids(spark, sf_dir).select("id", "url", "o_orderstatus")
    layers = []
    for layer, rows in (("ids", ids.select("id", "url")), ("listings", ids.where("o_orderstatus = 'F'").select("id", "url"))):
        path = work_folder(spark, layer)
        table = bucketed.open_bucketed(spark, path.rsplit("/", 1)[1].replace("-", "_"), path, rows.schema, buckets=LAYER_BUCKETS)
        bucketed.insert_ignore_bucketed(rows, table)
        layers.append(table.read())
    return joins.pending(*layers)


@query
def pending_records(spark, sf_dir):
    done = X.listing_texts(spark, sf_dir, ["id"]).where("o_orderstatus <> 'P'")
    return joins.pending(X.details(spark, sf_dir), done).select("id", "type", "contract")


@query
def sample_pending(spark, sf_dir):
    return joins.sample_n(pending_records(spark, sf_dir), MAPPING_SAMPLE, seed=SEED)


@query
def lookup_array(spark, sf_dir):
    customer, orders = X.load(spark, sf_dir, "customer"), X.load(spark, sf_dir, "orders")
    return joins.lookup_count(customer, orders, "c_custkey", "o_custkey").select("c_custkey", "n_matches")


@query
def lookup_matches(spark, sf_dir):
    customer = X.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = X.load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    found = joins.lookup(customer, orders, "c_custkey", "o_custkey")
    return found.select("c_custkey", "c_name", F.col("match.o_orderkey").alias("o_orderkey"), F.col("match.o_totalprice").alias("o_totalprice"))


@query
def dedupe_content(spark, sf_dir):
    kept = dedupe.dedupe_by_content(X.load(spark, sf_dir, "documents"), ["doc_id"])
    return kept.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


def _by_lang_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_by_key(X.load(spark, sf_dir, "documents"), ["lang", "source"], ["doc_id"])


@query
def dedupe_key(spark, sf_dir):
    first = _by_lang_source(spark, sf_dir)
    return first.select("key.lang", "key.source", "doc_id", "n_chars", F.md5("text").alias("text_md5"))


@query
def find_nested(spark, sf_dir):
    found = docquery.find_eq(_by_lang_source(spark, sf_dir), "key.lang", "en")
    return found.select(F.col("key.source").alias("source"), "doc_id")


@query
def replace_table(spark, sf_dir):
    whole = tables.replace_table(_by_lang_source(spark, sf_dir), work_folder(spark, "deduplicated"))
    return whole.select("key.lang", "key.source", "doc_id")


@query
def count_docs(spark, sf_dir):
    counts = docquery.count_questions(X.load(spark, sf_dir, "documents"), {"all": F.lit(True), "lang=en": F.col("lang") == "en"})
    return counts.select("question", "n")


@query
def find_eq(spark, sf_dir):
    return docquery.find_eq(X.load(spark, sf_dir, "documents"), "lang", "fr").select("doc_id", "source", "n_chars")


@query
def find_one(spark, sf_dir):
    return docquery.find_one(X.load(spark, sf_dir, "documents"), "lang", "de", ["doc_id"]).select("doc_id", "source", "n_chars")


@query
def find_by_key(spark, sf_dir):
    customer = X.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    asked = [
        ("number", docquery.find_by_key(customer, "c_custkey", 42)),
        ("text", docquery.find_by_key(customer, "c_custkey", "42")),
        ("converted", docquery.find_by_key_text(customer, "c_custkey", "42")),
        ("no_key", docquery.find_by_key_text(customer, "c_custkey", "42x")),
    ]
    return docquery.union_sparse(*[found.select(F.lit(how).alias("asked_by"), "*") for how, found in asked])


@query
def range_sorted(spark, sf_dir):
    found = docquery.find_range_sorted(X.load(spark, sf_dir, "events"), "ts", "2024-01-10 00:00:00", ["user_id", "event_id"])
    return found.select("user_id", "event_id", "event_type", "value")


@query
def head_documents(spark, sf_dir):
    return docquery.head(X.load(spark, sf_dir, "documents").orderBy("doc_id"), 5).select("doc_id", "lang", "source")


@query
def union_sparse(spark, sf_dir):
    customer = X.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    supplier = X.load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return docquery.union_sparse(customer, supplier)


@query
def sparse_json(spark, sf_dir):
    texts = X.listing_texts(spark, sf_dir, ["id", "fee_text", "condition_text", "garden_text", "badges_text"])
    return docquery.to_sparse_json(texts.drop("o_orderstatus")).select("json")


# --- tables and files -------------------------------------------------------------------------


def _ids_layer(spark: SparkSession, sf_dir: str, title: str = "title") -> DataFrame:
    return _ids(spark, sf_dir).select(
        F.lit("immobiliare").alias("source"),
        "source_id",
        F.expr(title).alias("title"),
        "url",
        X.fetched_at().alias("fetch_date"),
        "id",
        "o_orderstatus",
    )


@query
def insert_ignore(spark, sf_dir):
    """A table of the finished orders, then every order twice under other titles, then the same again."""
    path = work_folder(spark, "ids")
    known = _ids_layer(spark, sf_dir, "'known ' || title").where("o_orderstatus = 'F'").drop("o_orderstatus")
    tables.insert_ignore(known, path)
    rows = _ids_layer(spark, sf_dir).drop("o_orderstatus")
    twice = rows.withColumn("pass", F.lit(1)).unionByName(rows.withColumns({"pass": F.lit(2), "title": F.lit("late")}))
    stored = known.columns
    counts = tables.insert_ignore(twice, path, order=["pass"], columns=stored)
    again = tables.insert_ignore(twice, path, order=["pass"], columns=stored)
    return tables.read_layer_table(spark, path, "ids").select(
        "id",
        "title",
        F.lit(counts.inserted).cast("bigint").alias("inserted"),
        F.lit(counts.skipped).cast("bigint").alias("skipped"),
        F.lit(again.inserted).cast("bigint").alias("inserted_again"),
    )


@query
def stream_insert_ignore(spark, sf_dir):
    """The same through a stream: every order arrives in two files, the finished ones are known before."""
    path, landing = work_folder(spark, "ids"), work_folder(spark, "landing")
    known = _ids_layer(spark, sf_dir, "'known ' || title").where("o_orderstatus = 'F'").drop("o_orderstatus")
    tables.insert_ignore(known, path, batch_id="before")
    arriving = _ids_layer(spark, sf_dir).drop("o_orderstatus")
    for copy in ("a", "b"):
        arriving.withColumn("copy", F.lit(copy)).coalesce(1).write.mode("append").parquet(landing)
    source = (
        spark.readStream.schema(arriving.select("*", F.lit("").alias("copy")).schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(landing)
    )
    stream_layer(source, lambda rows: rows.drop("copy"), path, work_folder(spark, "offsets")).awaitTermination()
    return tables.read_layer_table(spark, path, "ids").select("id", "title", "url")


@query
def csv_roundtrip(spark, sf_dir):
    path = work_folder(spark, "listings-csv")
    files.append_csv(X.details(spark, sf_dir), path, "listings")
    good, bad = files.read_layer_checked(spark, path, "listings")
    return _shown(good.withColumn("failed_rules", F.lit(None).cast("string")).unionByName(bad.drop(files.CORRUPT)), "listings", "failed_rules")


@query
def csv_append(spark, sf_dir):
    path = work_folder(spark, "ids-csv")
    rows = _ids_layer(spark, sf_dir).drop("o_orderstatus")
    n = files.append_csv(rows, path, "ids") + files.append_csv(rows, path, "ids")
    return files.read_layer(spark, path, "ids").select("id", "source_id", "title", F.lit(n).cast("bigint").alias("n_appended"))


# --- similarity graph -------------------------------------------------------------------------


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = X.load(spark, sf_dir, "documents")
    nodes = documents.select(F.col("doc_id").cast("string").alias("id"), F.concat_ws(" ", "lang", "source").alias("text"))
    edges = graph.wide_to_edges(X.similar_wide(spark, sf_dir)).groupBy("src", "dst").agg(F.max("score").alias("score"))
    # Walks read the merged edges several times.
    return nodes, tables.replace_table(edges, work_folder(spark, "edges"))


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents as a table of starts."""
    return X.load(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id")).distinct()


def _start(nodes: DataFrame) -> DataFrame:
    return docquery.find_by_key(nodes, "id", START).select("id")


@query
def wide_to_edges(spark, sf_dir):
    edges = graph.wide_to_edges(X.similar_wide(spark, sf_dir))
    return edges.select("src", "dst", "score", F.col("slot").cast("bigint").alias("slot"))


@query
def merge_nodes(spark, sf_dir):
    """Labelled documents are nodes already; all wide rows are loaded on top."""
    labelled = X.load(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("label "), "quality").alias("text"))
    new = graph.wide_to_nodes(X.similar_wide(spark, sf_dir), ["doc_id"])
    return graph.merge_nodes(labelled, new, ["doc_id", "slot"])


def _written_edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """(existing edges, written ones, nodes, the order of writing): English documents' edges are there already; all are written, then some again with the reverse score."""
    wide = X.similar_wide(spark, sf_dir)
    languages = X.load(spark, sf_dir, "documents").select("doc_id", "lang")
    nodes = X.load(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    english = wide.join(languages.where("lang = 'en'"), "doc_id", "left_semi")
    existing = graph.wide_to_edges(english).groupBy("src", "dst").agg((F.max("score") + 10).alias("score"))
    written = graph.wide_to_edges(wide, ["doc_id"]).withColumn("pass", F.lit(1))
    french = wide.join(languages.where("lang = 'fr'"), "doc_id", "left_semi")
    again = graph.wide_to_edges(french, ["doc_id"]).withColumns({"pass": F.lit(2), "score": 1 - F.col("score")})
    return existing, written.unionByName(again), nodes, ["pass", "doc_id", "slot"]


@query
def merge_edges(spark, sf_dir):
    return graph.merge_edges(*_written_edges(spark, sf_dir)).select("src", "dst", F.round("score", 6).alias("score"))


@query
def upsert_edges(spark, sf_dir):
    """The same in a stored table: a folded base, two batches after it, merged when read."""
    existing, written, nodes, order = _written_edges(spark, sf_dir)
    path, keys, schema = work_folder(spark, "edges"), ["src", "dst"], existing.schema
    merged.upsert(existing, path, keys, batch_id="0")
    merged.fold(spark, path, schema, keys)
    for number in (1, 2):
        merged.upsert(graph.latest_edges(written.where(F.col("pass") == number), nodes, order), path, keys, batch_id=str(number))
    return merged.read_merged(spark, path, schema, keys).select("src", "dst", F.round("score", 6).alias("score"))


def _paths_out(paths: DataFrame) -> DataFrame:
    return paths.select(
        "start", "node", F.col("distance").cast("bigint").alias("distance"), "mid", "score1", "score2", "node_text", "mid_text"
    )


@query
def strong_paths(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return _paths_out(graph.strong_shortest_paths(nodes, edges, _start(nodes)))


@query
def strong_paths_all(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return _paths_out(graph.strong_shortest_paths(nodes, edges, _wanted(spark, sf_dir)))


def _neighbours_out(found: DataFrame) -> DataFrame:
    return found.select("start", "node", "text", F.col("distance").cast("bigint").alias("distance"), F.round("score", 6).alias("score"))


@query
def neighbourhood(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return _neighbours_out(graph.rank_neighbours(graph.neighbourhood(nodes, edges, _start(nodes))))


@query
def neighbourhood_all(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return _neighbours_out(graph.neighbourhood(nodes, edges, _wanted(spark, sf_dir)))


@query
def neighbourhood_far(spark, sf_dir):
    """Walks of up to four hops from one start."""
    nodes, edges = _graph(spark, sf_dir)
    return _neighbours_out(graph.neighbourhood(nodes, edges, _start(nodes), most=FAR))


@query
def best_neighbours(spark, sf_dir):
    """The first rows of every wanted start's ranking, walked no further than they need."""
    nodes, edges = _graph(spark, sf_dir)
    found = graph.best_neighbours(nodes, edges, _wanted(spark, sf_dir), BEST)
    ranked = found.withColumns({"distance": F.col("distance").cast("bigint"), "score": F.round("score", 6), "place": F.col("place").cast("bigint")})
    return ranked.select("start", "node", "text", "distance", "score", "place")


@query
def strong_walks_far(spark, sf_dir):
    """Shortest strong walks of up to six hops from every wanted start."""
    nodes, edges = _graph(spark, sf_dir)
    found = graph.strong_walks(nodes, edges, _wanted(spark, sf_dir), most=FARTHEST)
    total = F.round(F.aggregate("scores", F.lit(0.0), lambda sum_, x: sum_ + x), 6)
    return found.select("start", "node", F.col("distance").cast("bigint").alias("distance"), F.array_join("walk", ">").alias("walk"), total.alias("score"), "node_text")


@query
def paths_json(spark, sf_dir):
    """Strong paths of the wanted starts, written as JSON and read back."""
    nodes, edges = _graph(spark, sf_dir)
    path = work_folder(spark, "paths-json")
    files.write_paths_json(graph.as_paths(graph.strong_shortest_paths(nodes, edges, _wanted(spark, sf_dir))), path)
    shape = "nodes array<struct<id string, text string>>, relationships array<struct<score double>>"
    back = spark.read.schema(shape).json(path)
    return back.select(
        F.array_join(F.col("nodes.id"), ">").alias("walk"),
        F.array_join(F.col("nodes.text"), ">").alias("texts"),
        F.round(F.aggregate("relationships", F.lit(0.0), lambda s, r: s + r["score"]), 6).alias("score"),
    )


@query
def neighbours_csv(spark, sf_dir):
    """Ranked neighbours of the wanted starts, written as CSV and read back."""
    nodes, edges = _graph(spark, sf_dir)
    path = work_folder(spark, "neighbours-csv")
    found = graph.neighbourhood(nodes, edges, _wanted(spark, sf_dir))
    files.write_neighbours_csv(graph.rank_neighbours(found), path, one_start=False)
    back = spark.read.schema("start string, feedbackText string, distance bigint, score double").option("header", True).csv(path)
    return back.select("start", "feedbackText", "distance", F.round("score", 6).alias("score"))
