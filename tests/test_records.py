"""Layer 2 to layer 3, the row rules, and the counts of unknown terms."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mattone import schemas
from mattone.operators import records, validate
from mattone.plans import fixtures as X
from conftest import SMALL


def test_vocab_lookup(read):
    assert read(lambda c: records.vocab_lookup(c, "garden"), [" Giardino privato ", "giardino privato", "", None]) == ["private", None, None, None]
    assert read(lambda c: records.vocab_lookup(c, "ownership", strict=False), ["nuda PROPRIETÀ"]) == ["bare_ownership"]


def test_type_triple(read):
    given = {
        "Appartamento": ("apartment", None, None),
        "Attico | intera PROPRIETÀ": ("penthouse", "full_ownership", None),
        "Loft | Immobile di lusso": ("loft", None, "luxury"),
        "Loft | immobile di lusso": ("loft", None, None),
        "Loft | Nuda proprietà | Classe immobile media": ("loft", "bare_ownership", "medium"),
        "Loft | nuda proprietà | Classe immobile media | x": ("loft", None, "medium"),
        "Loft |  | Nuda proprietà": ("loft", "bare_ownership", None),
        "appartamento": (None, None, None),
        "": (None, None, None),
        "Mansarda": ("attic", None, None),
    }
    assert read(records.type_triple, list(given)) == list(given.values())


def test_no_ownership_is_a_class():
    from mattone.vocabulary import pairs

    owners = {label.lower() for label, _ in pairs("ownership")}
    assert not owners & {label.lower() for label, _ in pairs("class")}


def test_contract_triple(read):
    given = {
        "Vendita": ("sale", False, None),
        "Affitto con RISCATTO": ("rent", True, None),
        "Vendita | Libero": ("sale", False, "available"),
        "Affitto | a reddito": ("rent", False, "occupied"),
        "Affitto Vendita": ("sale", False, None),
        "vendita": (None, False, None),
    }
    assert read(records.contract_triple, list(given)) == list(given.values())


def test_window_pair(read):
    given = {
        "Infissi esterni in triplo vetro / PVC": ("triple_glass", "pvc"),
        "Infissi esterni in vetro / Legno": ("single_glass", None),
        "Infissi esterni": (None, None),
        None: (None, None),
    }
    assert read(records.window_pair, list(given)) == list(given.values())


def features(spark, badges):
    df = spark.createDataFrame([(badges,)], "b array<string>").select(records.clean_badges(F.col("b")).alias("b"))
    found = df.select(records.features_or_null(F.col("b")).alias("f")).first().f
    return None if found is None else {k: v for k, v in found.asDict().items() if v is not None}


@pytest.mark.parametrize(
    ("badges", "expected"),
    [
        (["Piscina", "Altro"], {"has_pool": True}),
        (["Altro"], None),
        ([], None),
        (None, None),
        (["Impianto tv boh"], {}),
        (["Impianto tv singolo", "Impianto tv boh"], {}),
        (["Impianto tv boh", "Impianto tv singolo"], {"tv_system": "individual"}),
        (["Esposizione sud"], {"sun_exposure": "Esposizione sud"}),
        (["Esposizione Impianto tv singolo"], {"sun_exposure": "Esposizione Impianto tv singolo"}),
        ([" Mansarda ", "Infissi esterni in doppio vetro / legno"], {"has_attic": True, "window_glass_type": "double_glass", "window_material": "wood"}),
        (["Infissi esterni in vetro / legno", "Infissi esterni"], {}),
    ],
)
def test_features(spark, badges, expected):
    assert features(spark, badges) == expected


def test_records_have_the_declared_schema(spark):
    rows = records.normalise(X.details(spark, SMALL), X.fetched_at())
    good, bad = validate.split_rejects(rows, "reject_reason")
    assert good.columns == schemas.RECORDS.names
    assert [f.dataType for f in good.schema] == [f.dataType for f in schemas.RECORDS]
    assert good.count() + bad.count() == rows.count() == 1500


def test_fail_policy(spark):
    rows = records.normalise(X.details(spark, SMALL), X.fetched_at(), errors="fail")
    with pytest.raises(PySparkException, match="row rejected"):
        rows.collect()
    with pytest.raises(ValueError):
        records.normalise(X.details(spark, SMALL), X.fetched_at(), errors="ignore")


def broken(spark, **changes):
    row = X.details(spark, SMALL).where("id = 'immobiliare:2'")
    for name, value in changes.items():
        row = row.withColumn(name, F.lit(value))
    return validate.validate(row, "listings").first().failed_rules


def test_row_rules(spark):
    assert broken(spark) is None
    assert broken(spark, build_year=1500) == "build_year_out_of_range"
    assert broken(spark, price_eur=-1.0) == "price_eur_negative"
    assert broken(spark, price_eur=float("nan")) == "price_eur_not_finite"
    assert broken(spark, type="  ", energy_class="Z") == "type_empty,energy_class_not_allowed"
    assert broken(spark, build_year=1800) is None and broken(spark, build_year=2100) is None
    with pytest.raises(ValueError, match="surprise"):
        broken(spark, surprise="x")


def test_missing_required_column_rejects(spark):
    rows = X.details(spark, SMALL).drop("contract", "kitchen")
    assert validate.validate(rows, "listings").where("failed_rules like '%contract_missing%'").count() == 1500


def test_unknown_layer():
    with pytest.raises(ValueError):
        schemas.table_for("/x", "houses")
    assert [len(schemas.schema_of(n)) for n in schemas.LAYERS] == [6, 44, 46]


def test_unknown_terms_count_every_badge(spark):
    one = X.details(spark, SMALL).where("id = 'immobiliare:2'")
    rows = one.withColumn("other_amenities", F.lit(["Altro", " Altro", "Infissi esterni / Ferro", "Impianto tv boh"])).withColumn("type", F.lit("Loft | boh"))
    found = {(r.field, r.term): r.n for r in records.unknown_terms(rows).collect()}
    assert found == {
        ("other_amenities", "Altro"): 2,
        ("window_glass_type", "Infissi esterni"): 1,
        ("window_material", "Ferro"): 1,
        ("tv_system", "Impianto tv boh"): 1,
        ("property_class", "boh"): 1,
    }


def badges_of(spark, many):
    rows = X.details(spark, SMALL).limit(1).select([c for c in X.details(spark, SMALL).columns if c != "other_amenities"])
    return rows.crossJoin(spark.createDataFrame([(list(b),) for b in many], "other_amenities array<string>"))


@pytest.mark.parametrize("seen", [records.UNSEEN_SHARE, 1.0])
def test_top_terms_are_exact_whether_the_sketch_suffices_or_not(spark, monkeypatch, seen):
    """With a share of 1 no sketch can prove an answer unless it holds all texts."""
    monkeypatch.setattr(records, "UNSEEN_SHARE", seen)
    monkeypatch.setattr(records, "TRACKED", 50)
    often = [("common %d" % (i % 7), "rare %d" % i) for i in range(3000)]
    rows = badges_of(spark, often)
    whole = records.unknown_terms(rows).collect()
    expected = sorted((r.field, p + 1, r.term, r.n) for f in {r.field for r in whole} for p, r in enumerate(sorted((r for r in whole if r.field == f), key=lambda r: (-r.n, r.term))[:9]))
    found = sorted((r.field, r.place, r.term, r.n) for r in records.top_unknown_terms(rows, 9).collect())
    assert found == expected
    assert sum(f == "other_amenities" for f, *_ in found) == 9


def test_top_terms_of_nothing(spark):
    assert records.top_unknown_terms(X.details(spark, SMALL).limit(0), 3).collect() == []
