"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from mattone.operators import crawl, joins
from mattone.plans import checks
from mattone.plans.queries import QUERIES
from conftest import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from compare import connect, difference  # noqa: E402

SQL = checks.oracle_sql()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), SQL[name], duck) == ""


@pytest.mark.parametrize("name", ["etl_listing_records", "build_details", "page_fields", "harvest_cards", "neighbourhood_all", "normalize_text"])
def test_no_python_workers(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["build_details", "page_details", "harvest_cards", "parse_price", "validate_listings"])
def test_parsing_needs_no_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SMALL))


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]" in plan_of(QUERIES["find_eq"](spark, SMALL))
    assert "LessThan(ts" in plan_of(QUERIES["range_sorted"](spark, SMALL))


def test_unread_columns_stay_unread(spark):
    up = spark.read.parquet(f"{SMALL}/customer.parquet").withColumnRenamed("c_custkey", "id")
    down = spark.read.parquet(f"{SMALL}/documents.parquet").withColumnRenamed("doc_id", "id")
    plan = plan_of(joins.pending(up, down))
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "LeftAnti" in plan


def test_crawls_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], "crawl_id int, page long, scraped long, inserted long")
    plan = plan_of(crawl.crawl_gate(df, max_pages=1500))
    assert "partial_sum" in plan and "partial_min" in plan and "Cartesian" not in plan


def test_first_rows_are_found_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("id"), F.col("id").alias("n"))
    assert "partial_min_by" in plan_of(joins.first_per_key(df, "id", ["n"]))


def test_sample_sorts_no_whole_table(spark):
    assert "TakeOrderedAndProject" in plan_of(joins.sample_n(spark.range(10), 3))
