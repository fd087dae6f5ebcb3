"""Where a crawl should have stopped, judged from its per-page counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The stop rule's defaults.
LISTING_LIMIT = 2000
MAX_PAGES = 80
MIN_SUCCESS = 0.3
# Pages of a block are 2^BLOCK page numbers, and so many blocks make a part.
BLOCK = 10


def running_sums(rows: DataFrame, key: str, at: str, totals: dict[str, str]) -> DataFrame:
    """The rows with running sums per key in the order of ``at``, a whole number that is unique within its key and never null.

    ``totals`` names the new columns and what each adds up. A key may hold any number of rows: sums are taken per block of
    numbers, the blocks' within a part and the parts' within the key, so no window holds more than 2^BLOCK rows as
    long as the numbers are of 32 bits (2^(32 - 2 * BLOCK) parts). As in a plain window, a sum over nulls alone is null.
    """
    block, part = F.shiftright(F.col(at).cast("bigint"), BLOCK), F.shiftright(F.col(at).cast("bigint"), 2 * BLOCK)
    placed = rows.withColumns({"_part": part, "_block": block})
    blocks = placed.groupBy(key, "_part", "_block").agg(*[F.sum(c).alias(f"_{t}") for t, c in totals.items()])
    parts = blocks.groupBy(key, "_part").agg(*[F.sum(f"_{t}").alias(f"_{t}") for t in totals])

    def before(sums: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return sums.select(*keys, order, *[F.sum(f"_{t}").over(earlier).alias(f"_{name}_{t}") for t in totals])

    def both(a: Column, b: Column) -> Column:
        return F.coalesce(a + b, a, b)

    of_parts = before(parts, [key], "_part", "part")
    of_blocks = before(blocks, [key, "_part"], "_block", "block").join(of_parts, [key, "_part"])
    offsets = of_blocks.select(key, "_part", "_block", *[both(F.col(f"_part_{t}"), F.col(f"_block_{t}")).alias(f"_before_{t}") for t in totals])
    so_far = Window.partitionBy(key, "_part", "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = placed.withColumns({t: F.sum(c).over(so_far) for t, c in totals.items()})
    whole = within.join(offsets, [key, "_part", "_block"])
    return whole.select(*rows.columns, *[both(F.col(f"_before_{t}"), F.col(t)).alias(t) for t in totals])


def crawl_gate(
    batches: DataFrame,
    listing_limit: int = LISTING_LIMIT,
    max_pages: int | None = MAX_PAGES,
    min_success: float = MIN_SUCCESS,
    crawl: str = "crawl_id",
    next_page: str | None = None,
) -> DataFrame:
    """Pages of each crawl up to and including the one that ends it, with running counts and the reason.

    ``batches`` holds rows (crawl, page, scraped, inserted); several rows of a page, saved
    or retried, are added up.  ``next_page`` names the column with the page the crawl came to from this one,
    null if there was none; without it a crawl goes on to its next page in the table.

    No crawl runs more than ``max_pages`` pages beyond its first, so a window holds at most
    ``max_pages + 1`` rows.  Counts and first pages are aggregates with a part inside each task: one crawl may hold any
    share of the table.  With ``max_pages`` null a crawl may run to any length; its totals are then ``running_sums`` by blocks of pages.
    """
    moved = [F.max(next_page).alias("_next")] if next_page else []
    pages = batches.groupBy(crawl, "page").agg(F.sum("scraped").alias("scraped"), F.sum("inserted").alias("inserted"), *moved)
    ends = pages.groupBy(crawl).agg(F.min("page").alias("_start"), F.max("page").alias("_last"))
    placed = pages.join(ends, crawl)
    if max_pages is None:
        running = running_sums(placed.where(F.col("page").isNotNull()), crawl, "page", {"total_scraped": "scraped", "total_inserted": "inserted"})
    else:
        # The first page at the limit or beyond it is still read; a crawl may jump there.
        limit = placed.where(F.col("page") >= F.col("_start") + max_pages).groupBy(crawl).agg(F.min("page").alias("_limit"))
        reachable = placed.join(limit, crawl, "left").where(F.col("page") <= F.coalesce("_limit", "page"))
        by_page = Window.partitionBy(crawl).orderBy("page")
        so_far = by_page.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = reachable.withColumns({"total_scraped": F.sum("scraped").over(so_far), "total_inserted": F.sum("inserted").over(so_far)})
    success = F.try_divide(F.col("total_inserted").cast("double"), F.col("total_scraped").cast("double"))
    over = F.col("_next").isNull() if next_page else F.col("page") == F.col("_last")
    reason = (
        F.when(F.col("total_scraped") >= listing_limit, "listing_limit")
        .when(F.lit(False) if max_pages is None else F.col("page") >= F.col("_start") + max_pages, "max_pages")
        .when((F.col("total_scraped") == 0) | (F.col("success") < min_success), "low_success")
        .when(over, "no_next_page")
    )
    if next_page:
        reason = reason.when(F.col("_next") == F.col("page"), "page_unchanged")
    judged = running.withColumn("success", success).withColumn("stop_reason", reason)
    if max_pages is None:
        stops = judged.where(F.col("stop_reason").isNotNull()).groupBy(crawl).agg(F.min("page").alias("_stop"))
        kept = judged.join(stops, crawl, "left").where(F.col("page") <= F.coalesce("_stop", "page"))
        return kept.select(crawl, "page", "scraped", "inserted", "total_scraped", "total_inserted", "success", "stop_reason")
    earlier = by_page.rowsBetween(Window.unboundedPreceding, -1)
    kept = judged.withColumn("_stopped", F.count("stop_reason").over(earlier)).where(F.col("_stopped") == 0)
    return kept.select(crawl, "page", "scraped", "inserted", "total_scraped", "total_inserted", "success", "stop_reason")
