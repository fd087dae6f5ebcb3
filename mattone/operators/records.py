"""``listings`` rows to normalised ``records`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.functions.numbers import parse_surface_decimal
from mattone.functions.text import is_blank, split_address, split_composite, strip, strip_computed
from mattone.operators.joins import best_per_key
from mattone.operators.validate import apply_policy, conform, failed_rules
from mattone.schemas import OTHER_FEATURES, schema_of
from mattone.session import work_folder
from mattone.sources.tables import replace_table
from mattone.vocabulary import SUN_WORD, TV_WORD, WINDOW_WORD, code_for, code_within, pairs

# Layer-3 name of a layer-2 column that only changes its name.
RENAMED = {
    "has_balcony": "balcony",
    "has_terrace": "terrace",
    "has_elevator": "elevator",
    "has_cellar": "cellar",
    "has_concierge": "concierge",
}


def vocab_lookup(c: Column, domain: str, strict: bool = True) -> Column:
    """Code of a label; without ``strict`` a label that differs only in case also counts."""
    return _code(strip(c), domain, strict)


def _code(label: Column, domain: str, strict: bool = True) -> Column:
    """The same for a label that is stripped already."""
    exact = code_for(label, domain)
    return exact if strict else F.coalesce(exact, code_for(label, domain, ignore_case=True))


def garden_code(c: Column) -> Column:
    return vocab_lookup(c, "garden")


def type_triple(c: Column) -> Column:
    """``type | ownership | class`` as a struct; an unknown type leaves ``property_type`` null.

    With two parts the second is an ownership in any case, else a class.
    """
    parts = split_composite(c, "|")
    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))
    n = F.size(parts)
    alone = _code(second, "ownership", strict=False)
    ownership = F.when(n == 2, alone).when(n > 2, _code(second, "ownership"))
    # No ownership label, in any case, is a class label: a second part is looked up as both.
    kind = F.when(n == 2, _code(second, "class")).when(n > 2, _code(third, "class"))
    return F.struct(
        _code(first, "type").alias("property_type"),
        ownership.alias("ownership_type"),
        kind.alias("property_class"),
    )


def contract_triple(c: Column) -> Column:
    """Contract text as a struct; without a known contract word ``contract_type`` is null."""
    low = F.lower(c)
    return F.struct(
        code_within(c, "contract").alias("contract_type"),
        F.coalesce(low.contains("riscatto"), F.lit(False)).alias("is_rent_to_own_available"),
        code_within(low, "availability").alias("current_availability"),
    )


def window_pair(c: Column) -> Column:
    """``... glass / material`` as a struct (window_glass_type, window_material)."""
    parts = split_composite(c, "/")
    return F.struct(
        code_within(F.lower(F.get(parts, F.lit(0))), "window_glass").alias("window_glass_type"),
        _code(F.get(parts, F.lit(1)), "window_material").alias("window_material"),
    )


def clean_badges(badges: Column) -> Column:
    return F.filter(F.transform(badges, strip_computed), lambda b: b != "")


def feature_flags(badges: Column) -> list[Column]:
    """One column per flag: true when its badge is there, else null.  No explode, no pivot, no shuffle."""
    return [F.when(F.array_contains(badges, label), True).alias(code) for label, code in pairs("feature")]


def feature_text(badges: Column) -> list[Column]:
    """Text features.  The last badge of a kind decides, also when it has no known code."""

    def last(test) -> Column:
        return F.try_element_at(F.filter(badges, test), F.lit(-1))

    tv = last(lambda b: b.contains(TV_WORD) & ~b.contains(SUN_WORD))
    window = last(lambda b: b.contains(WINDOW_WORD) & ~b.contains(SUN_WORD) & ~b.contains(TV_WORD))
    panes = window_pair(window)
    return [
        _code(tv, "tv").alias("tv_system"),
        panes["window_glass_type"].alias("window_glass_type"),
        panes["window_material"].alias("window_material"),
        last(lambda b: b.contains(SUN_WORD)).alias("sun_exposure"),
    ]


def is_recognised(badge: Column) -> Column:
    flag = badge.isin([label for label, _ in pairs("feature")])
    return flag | badge.contains(SUN_WORD) | badge.contains(TV_WORD) | badge.contains(WINDOW_WORD)


def features_or_null(badges: Column) -> Column:
    """The struct of all features, null when no badge is recognised."""
    whole = F.struct(*feature_flags(badges), *feature_text(badges))
    return F.when(F.exists(badges, is_recognised), whole).cast(OTHER_FEATURES)


def normalise(details: DataFrame, as_of: Column, errors: str = "quarantine") -> DataFrame:
    """``records`` rows plus ``reject_reason``, null for a good row.  One narrow pass."""
    prepared = details.withColumn("_badges", clean_badges(F.col("other_amenities")))
    kind = type_triple(F.col("type"))
    deal = contract_triple(F.col("contract"))
    place = split_address(F.col("address"))
    columns = {
        "etl_date": as_of,
        "property_type": kind["property_type"],
        "ownership_type": kind["ownership_type"],
        "property_class": kind["property_class"],
        "contract_type": deal["contract_type"],
        "is_rent_to_own_available": deal["is_rent_to_own_available"],
        "current_availability": deal["current_availability"],
        "condition": vocab_lookup(F.col("condition"), "condition"),
        "surface": parse_surface_decimal(F.col("surface_formatted")),
        "garden": garden_code(F.col("garden")),
        "has_basement": F.lit(None).cast("boolean"),
        "furnished": vocab_lookup(F.col("furnished"), "furnished"),
        "kitchen": vocab_lookup(F.col("kitchen"), "kitchen"),
        "zone": place["zone"],
        "address": place["street"],
        "other_features": features_or_null(F.col("_badges")),
        **{new: F.col(old) for new, old in RENAMED.items()},
    }
    order = schema_of("records").names
    derived = frozenset(columns) - frozenset(RENAMED)
    missing = (
        F.when(is_blank(F.col("type")), "no_type")
        .when(is_blank(F.col("contract")), "no_contract")
        .when(is_blank(F.col("surface_formatted")), "no_surface")
    )
    built = prepared.select(*[columns.get(n, F.col(n)).alias(n) for n in order], missing.alias("_missing"))
    reason = F.coalesce(
        F.col("_missing"),
        F.when(F.col("property_type").isNull(), "unknown_type"),
        F.when(F.col("contract_type").isNull(), "unknown_contract"),
        F.when(F.col("surface").isNull(), "bad_surface"),
        failed_rules("records", derived),
    )
    rows = conform(built, "records", derived).withColumn("reject_reason", reason).drop("_missing")
    return apply_policy(rows, "reject_reason", errors)


def unknown_terms(details: DataFrame) -> DataFrame:
    """How often each text was met that the vocabulary does not hold, per field.

    The raw texts are counted first, inside each task before the shuffle, and only
    the distinct ones are then looked up.
    """
    counted = _met_texts(details).groupBy("field", "text").agg(F.count("*").alias("n"))
    return _unknown(counted).groupBy("field", "term").agg(F.sum("n").alias("n"))


# Terms that a sketch tracks per field, and the greatest share of a field's texts that a term outside the sketch's answer can have:
# its map holds the next power of two of entries, its error is 3.5 texts in as many, and an answer leaves out what may lie within twice that.
TRACKED = 12_000
UNSEEN_SHARE = 7 / (1 << 14)


def top_unknown_terms(details: DataFrame, k: int) -> DataFrame:
    """(field, term, n, place): the k unknown terms that each field was met with most often, ties to the smaller term.

    Most terms of a large corpus occur once and are not worth a shuffle.  A mergeable frequent-items sketch per field names candidates, which
    alone are counted exactly.  The answer of a field stands if its candidates make up all its texts, or if the k-th of them occurs more often than any
    term outside the sketch's answer can; the terms of other fields are counted as a whole, so the result is exact for any input.
    """
    spark = details.sparkSession
    terms = _unknown(_met_texts(details).withColumn("n", F.lit(1).cast("bigint"))).select("field", "term")
    sketched = terms.groupBy("field").agg(F.count("*").alias("total"), F.expr(f"approx_top_k(term, {TRACKED}, {TRACKED})").alias("items"))
    named = replace_table(sketched, work_folder(spark, "sketches"))
    candidates = named.select("field", F.explode(F.col("items.item")).alias("term"))
    counts = replace_table(terms.join(candidates, ["field", "term"], "left_semi").groupBy("field", "term").agg(F.count("*").alias("n")), work_folder(spark, "candidates"))
    order = [F.col("n").desc(), F.col("term")]
    best = best_per_key(counts, "field", order, k, "place")
    seen = counts.groupBy("field").agg(F.sum("n").alias("counted"))
    least = best.where(F.col("place") == k).select("field", F.col("n").alias("kth"))
    sure = (F.col("counted") == F.col("total")) | (F.col("kth") > F.col("total") * UNSEEN_SHARE)
    # A row for each of the fixed fields at most.
    judged = named.select("field", "total").join(seen, "field", "left").join(least, "field", "left")
    unsure = [r.field for r in judged.where(~F.coalesce(sure, F.lit(False))).select("field").collect()]
    if not unsure:
        return best
    whole = terms.where(F.col("field").isin(unsure)).groupBy("field", "term").agg(F.count("*").alias("n"))
    return best.where(~F.col("field").isin(unsure)).unionByName(best_per_key(whole, "field", order, k, "place"))


_SIMPLE = ("type", "condition", "garden", "furnished", "kitchen")


def _met_texts(details: DataFrame) -> DataFrame:
    """(field, text) of every text that the vocabulary is asked for, null ones left out."""

    def met(field: str, text: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), text.alias("text"))

    badges = F.coalesce("other_amenities", F.array().cast("array<string>"))
    texts = details.select(
        F.inline(
            F.concat(F.array(*[met(c, F.col(c)) for c in _SIMPLE]), F.transform(badges, lambda b: met("badge", b)))
        )
    )
    return texts.where(F.col("text").isNotNull())


def _unknown(counted: DataFrame) -> DataFrame:
    """(n, field, term): the terms of ``counted(field, text, n)`` that the vocabulary does not hold."""
    read = counted.select(
        "field",
        "n",
        strip(F.col("text")).alias("text"),
        split_composite(F.col("text"), "|").alias("parts"),
        split_composite(F.col("text"), "/").alias("panes"),
    )
    parts, panes, text = F.col("parts"), F.col("panes"), F.col("text")

    def term(name: str, applies: Column, label: Column, code: Column) -> Column:
        unknown = applies & (label != "") & code.isNull()
        return F.when(unknown, F.struct(F.lit(name).alias("field"), label.alias("term")))

    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))
    n = F.size(parts)
    is_type, is_badge = F.col("field") == "type", F.col("field") == "badge"
    typed = is_type & _code(first, "type").isNotNull()
    is_sun, is_tv, is_window = (text.contains(w) for w in (SUN_WORD, TV_WORD, WINDOW_WORD))
    pane = is_badge & is_window & ~is_tv & ~is_sun
    glass = code_within(F.lower(F.get(panes, F.lit(0))), "window_glass")
    owner = _code(second, "ownership", strict=False)
    terms = [
        term("property_type", is_type, first, _code(first, "type")),
        term("ownership_type", typed & (n > 2), second, _code(second, "ownership")),
        term("property_class", typed & (n == 2) & owner.isNull(), second, _code(second, "class")),
        term("property_class", typed & (n > 2), third, _code(third, "class")),
        *[term(c, F.col("field") == c, text, _code(text, c)) for c in _SIMPLE[1:]],
        term("other_amenities", is_badge, text, F.when(is_recognised(text), "known")),
        term("tv_system", is_badge & is_tv & ~is_sun, text, _code(text, "tv")),
        term("window_glass_type", pane, F.get(panes, F.lit(0)), glass),
        term("window_material", pane, F.get(panes, F.lit(1)), _code(F.get(panes, F.lit(1)), "window_material")),
    ]
    return read.select("n", F.inline(F.array_compact(F.array(*terms))))
