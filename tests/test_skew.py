"""One key, text or crawl that holds a third of all rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from mattone.operators import crawl, dedupe, joins
from mattone.session import work_folder
from mattone.sources import tables

N = 60_000


def third(spark):
    """Rows whose key is "hot" for every third, their own number otherwise."""
    n = F.col("id")
    return spark.range(N).select(F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("id"), n.alias("n"))


def test_insert_ignore(spark):
    counts = tables.insert_ignore(third(spark), work_folder(spark, "t"), order=["n"])
    assert counts == tables.InsertCounts(2 * N // 3 + 1, N // 3 - 1)


def test_first_rows_shrink_before_the_shuffle(spark):
    firsts = joins.first_per_key(third(spark).repartition(8), "id", ["n"])
    assert {r.id: r.n for r in firsts.where("id in ('hot', '1')").collect()} == {"hot": 0, "1": 1}
    hot = joins.first_per_key(third(spark).where("id = 'hot'").repartition(8), "id", ["n"])
    assert hot.count() == 1


def test_copies(spark):
    rows = third(spark).select(F.col("n").alias("key"), F.col("id").alias("text"))
    kept = dedupe.dedupe_by_content(rows, ["key"])
    assert kept.count() == 2 * N // 3 + 1 and kept.where("text = 'hot'").first().key == 0


def test_lookup(spark):
    keys = spark.createDataFrame([("hot",), ("1",), ("none",)], "id string")
    counts = {r.id: r.n_matches for r in joins.lookup_count(keys, third(spark), "id", "id").collect()}
    assert counts == {"hot": N // 3, "1": 1, "none": 0}
    rows = joins.lookup(keys, third(spark), "id", "id").groupBy("id").agg(F.count("match").alias("n")).collect()
    assert {r.id: r.n for r in rows} == {"hot": N // 3, "1": 1, "none": 0}


def test_a_long_crawl_keeps_its_first_pages(spark):
    pages = third(spark).select(
        F.col("id").alias("crawl_id"), F.col("n").alias("page"), F.lit(1).alias("scraped"), F.lit(1).alias("inserted")
    )
    gated = crawl.crawl_gate(pages.union(pages), max_pages=30)
    hot = gated.where("crawl_id = 'hot'").orderBy("page").collect()
    assert [r.page for r in hot] == list(range(0, 33, 3))[: len(hot)] and hot[-1].stop_reason == "max_pages"
    assert gated.count() == 2 * N // 3 + len(hot)


def test_a_crawl_without_a_bound(spark):
    """Running sums by blocks equal a plain window, negative and far pages and nulls included; a hot crawl is dealt over tasks."""
    pages = [("hot", n, n % 7 if n % 5 else None, n % 3) for n in range(-3000, 6000)]
    pages += [("far", 3 * 10**6 * n, 1, 1) for n in range(-40, 700)] + [("nulls", n, None, None) for n in range(3)]
    df = spark.createDataFrame(pages, "crawl_id string, page int, scraped long, inserted long").repartition(4)
    summed = crawl.running_sums(df, "crawl_id", "page", {"a": "scraped", "b": "inserted"})
    plain = Window.partitionBy("crawl_id").orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumns({"a": F.sum("scraped").over(plain), "b": F.sum("inserted").over(plain)})
    assert sorted(map(str, summed.collect())) == sorted(map(str, want.collect()))
    plan = summed._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_block" in line or "_part" in line for line in windows)


def test_a_crawl_without_a_bound_stops_as_a_bounded_one(spark):
    rows = [("long", n, 10, 9) for n in range(1, 5001)] + [("weak", n, 10, 0 if n > 30 else 6) for n in range(1, 3001)] + [("short", 4, 0, 0), ("short", 5, 1, 1)]
    df = spark.createDataFrame(rows, "crawl_id string, page int, scraped long, inserted long")
    for limit in (200, 10**6):
        free, bound = (crawl.crawl_gate(df, limit, pages).collect() for pages in (None, 10**6))
        assert sorted(map(str, free)) == sorted(map(str, bound))
        assert {r.crawl_id: r.stop_reason for r in free if r.stop_reason}["short"] == "low_success"
