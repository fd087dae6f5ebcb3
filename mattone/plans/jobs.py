"""The three staged jobs, each reading only what the stage before has and the next one lacks.

Every job writes what it parsed once, rejected rows included, to a work folder.
The good rows go to the layer's table, the others to ``rejected/<layer>``, once each: a
rejected input is not parsed again as long as it stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattone.functions import html as H
from mattone.functions.urls import LISTING_PREFIX
from mattone.operators.details import build_details
from mattone.operators.harvest import harvest_cards, ids_of, read_listing_pages
from mattone.operators.joins import first_per_key, pending, row_digest, sample_n, shuffled
from mattone.operators.records import normalise
from mattone.operators.validate import failed_rules, split_rejects, stage_checked
from mattone.schemas import schema_of, table_for
from mattone.session import work_folder
from mattone.sources.tables import BATCH, InsertCounts, insert_ignore, read_layer_table, read_table

REJECT_KEY, DIGEST = "reject_key", "input_digest"


def store_ids(result_pages: DataFrame, root: str, as_of: Column, page_order: list[str]) -> InsertCounts:
    """Result pages to ``ids``: the first card of an id wins.

    Skipped cards are kept with their reason in ``rejected/ids``, rows that break a rule of the layer in ``rejected/ids_rules``.
    """
    good, skipped = stage_checked(harvest_cards(result_pages), "skip_reason", work_folder(result_pages.sparkSession, "cards"))
    card = F.md5(F.to_json(F.struct(*[c for c in skipped.columns])))
    insert_ignore(skipped.withColumn(REJECT_KEY, card), f"{root}/rejected/ids", REJECT_KEY)
    order = [*page_order, "position"]
    rows = ids_of(good, as_of, keep=order)
    sound, broken = split_rejects(rows.withColumn("failed_rules", failed_rules("ids")), "failed_rules")
    insert_ignore(broken.withColumn(REJECT_KEY, F.md5(F.to_json(F.struct("title", "url", "failed_rules")))), f"{root}/rejected/ids_rules", REJECT_KEY)
    return _insert(sound, root, "ids", order)


def store_listings(
    listing_pages: DataFrame,
    root: str,
    as_of: Column,
    prefer: list[Column] | None = None,
    layout: H.PageLayout = H.LISTING_PAGE,
) -> InsertCounts:
    """Saved pages of ids without a listing to ``listings``; pages are matched by url.

    Of several copies of a page the first by ``prefer`` is read.  The others are dropped
    before anything is parsed, so a page saved over and over costs one parse.
    """
    spark = listing_pages.sparkSession
    todo = pending_ids(spark, root)
    # The copy is chosen on its digest; the html joins once, when it is known.
    saved = listing_pages.withColumn(DIGEST, F.xxhash64("html"))
    wanted = saved.drop("html").join(shuffled(todo.select("url")), "url", "left_semi")
    chosen = first_per_key(wanted, "url", prefer or []).select("url", DIGEST)
    fresh = _not_rejected(todo.join(shuffled(chosen), "url"), root, "listings")
    raw = read_listing_pages(shuffled(fresh).join(saved.select("url", DIGEST, "html"), ["url", DIGEST]).drop(DIGEST), layout=layout)
    return _stage_and_insert(build_details(raw, as_of, LISTING_PREFIX), fresh, root, "listings")


def store_records(spark: SparkSession, root: str, as_of: Column, sample: int | None = None, seed: str = "0") -> InsertCounts:
    """Listings without a record to ``records``; with ``sample`` only that many of them."""
    todo = pending(
        read_layer_table(spark, table_for(root, "listings"), "listings"),
        read_layer_table(spark, table_for(root, "records"), "records"),
    )
    todo = _not_rejected(todo.withColumn(DIGEST, row_digest(todo)), root, "records")
    if sample is not None:
        todo = sample_n(todo, sample, seed=seed)
    return _stage_and_insert(normalise(todo.drop(DIGEST), as_of), todo, root, "records")


def pending_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids that have no listing yet."""
    return pending(
        read_layer_table(spark, table_for(root, "ids"), "ids"),
        read_layer_table(spark, table_for(root, "listings"), "listings"),
    )


def _not_rejected(rows: DataFrame, root: str, layer: str) -> DataFrame:
    """``rows(id, input_digest, ...)`` less those rejected before with the same input."""
    shape = T.StructType([T.StructField("id", T.StringType()), T.StructField(DIGEST, T.LongType())])
    before = read_table(rows.sparkSession, f"{root}/rejected/{layer}", shape).drop(BATCH)
    return rows.join(shuffled(before), ["id", DIGEST], "left_anti")


def _stage_and_insert(checked: DataFrame, inputs: DataFrame, root: str, layer: str) -> InsertCounts:
    good, bad = stage_checked(checked, "reject_reason", work_folder(checked.sparkSession, layer))
    named = shuffled(bad).join(shuffled(inputs.select("id", DIGEST)), "id").withColumn(REJECT_KEY, F.concat_ws("|", "id", "reject_reason", DIGEST))
    insert_ignore(named, f"{root}/rejected/{layer}", REJECT_KEY)
    return _insert(good, root, layer, ["url"])


def _insert(rows: DataFrame, root: str, layer: str, order: list[str]) -> InsertCounts:
    return insert_ignore(rows, table_for(root, layer), "id", order, columns=schema_of(layer).names)
