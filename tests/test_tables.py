"""Insert-ignore, duplicates, files, joins and the stream."""

import pytest
from pyspark.sql import functions as F

from mattone.operators import dedupe, docquery, joins
from mattone.plans import fixtures as X
from mattone.plans import jobs
from mattone.session import work_folder
from mattone.sources import bucketed, files, merged, tables
from mattone.sources.tables import InsertCounts
from mattone.streaming.layers import stream_layer
from conftest import SMALL

SHAPE = "id string, n int, v string"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SHAPE)


def content(spark, path):
    schema = batch(spark).schema
    return sorted(tuple(r) for r in tables.read_table(spark, path, schema).drop("batch_id").collect())


def test_insert_ignore(spark):
    path = work_folder(spark, "t")
    put = dict(order=["n"])
    assert tables.insert_ignore(batch(spark, ("a", 0, "old")), path, **put) == InsertCounts(1, 0)
    new = batch(spark, ("a", 1, "new"), ("b", 2, "b2"), ("b", 1, "b1"), ("c", 1, "c"))
    assert tables.insert_ignore(new, path, **put) == InsertCounts(2, 2)
    assert tables.insert_ignore(new, path, **put) == InsertCounts(0, 4)
    assert tables.insert_ignore(batch(spark), path, **put) == InsertCounts(0, 0)
    assert content(spark, path) == [("a", 0, "old"), ("b", 1, "b1"), ("c", 1, "c")]


def test_rows_without_a_key_are_rejected(spark):
    path = work_folder(spark, "t")
    new = batch(spark, (None, 1, "x"), ("a", 1, "y"), (None, 2, "z"))
    assert tables.insert_ignore(new, path) == InsertCounts(1, 0, 2)
    assert tables.insert_ignore(new, path) == InsertCounts(0, 1, 2)
    assert tables.insert_ignore(batch(spark, (None, 1, "x")), path) == InsertCounts(0, 0, 1)
    assert content(spark, path) == [("a", 1, "y")]


def test_a_batch_reads_only_the_buckets_it_touches(spark):
    path = work_folder(spark, "t")
    tables.insert_ignore(batch(spark, *[(str(i), i, "x") for i in range(500)]), path)
    own = [r.b for r in batch(spark, ("7", 1, "x")).select(tables.bucket_of("id").alias("b")).collect()]
    known = tables.read_table(spark, path, batch(spark).schema, own)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or f"(bucket#" in plan and "PartitionFilters: []" not in plan
    assert 0 < known.count() < 100


def test_a_batch_run_again_replaces_itself(spark):
    path = work_folder(spark, "t")
    new = batch(spark, ("a", 1, "x"), ("b", 1, "y"))
    assert tables.insert_ignore(new, path, batch_id="7") == InsertCounts(2, 0)
    assert tables.insert_ignore(new, path, batch_id="7") == InsertCounts(2, 0)
    assert len(content(spark, path)) == 2


def test_equal_order_is_settled_the_same_way_however_the_rows_lie(spark):
    rows = [("a", 1, str(i)) for i in range(50)]
    one = joins.first_per_key(batch(spark, *rows).repartition(7), "id", ["n"]).collect()
    two = joins.first_per_key(batch(spark, *reversed(rows)).coalesce(1), "id", ["n"]).collect()
    assert one == two and len(one) == 1


def test_compact(spark):
    path, out = work_folder(spark, "t"), work_folder(spark, "t2")
    for writer in ("1", "2"):
        tables.write_batch(batch(spark, ("a", int(writer), "x")), path, "id", F.lit(writer))
    tables.compact(spark, path, batch(spark).schema, "id", out)
    assert content(spark, out) == [("a", 1, "x")]


def test_missing_tables_have_no_rows(spark):
    path = work_folder(spark, "nothing")
    assert tables.read_layer_table(spark, path, "records").count() == 0
    assert files.read_layer(spark, path, "ids").count() == 0


def test_csv_keeps_awkward_texts(spark):
    path = work_folder(spark, "csv")
    rows = X.details(spark, SMALL).where("id = 'immobiliare:2'").withColumns(
        {
            "title": F.lit('semi;colon "quoted"\nsecond line \\ end'),
            "description": F.lit(""),
            "other_amenities": F.lit(["a;b", 'c"d', ""]),
        }
    )
    assert files.append_csv(rows, path, "listings") == 1
    assert files.append_csv(rows.limit(0), path, "listings") == 0
    back = files.read_layer(spark, path, "listings")
    assert back.collect() == rows.collect()
    assert back.schema.simpleString() == rows.select(back.columns).schema.simpleString()


def test_pending_keeps_only_unprocessed_rows(spark):
    up = batch(spark, ("a", 1, ""), ("b", 1, ""), ("c", 1, ""))
    assert [r.id for r in joins.pending(up, batch(spark, ("b", 9, ""))).orderBy("id").collect()] == ["a", "c"]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("id", F.col("id").cast("string"))
    draw = [joins.sample_n(df.repartition(n), 10, seed="s").orderBy("id").collect() for n in (1, 7)]
    assert draw[0] == draw[1] and len(draw[0]) == 10
    assert joins.sample_n(df, 10, seed="other").orderBy("id").collect() != draw[0]
    assert joins.sample_random(df, 5, 1).count() == 5


def test_lookup(spark):
    left, right = batch(spark, ("a", 1, ""), ("b", 1, "")), batch(spark, ("a", 5, "x"), ("a", 6, "y"), ("z", 7, "z"))
    found = joins.lookup(left, right, "id", "id").orderBy("id", "match.n").collect()
    assert [(r.id, r.match and r.match.n) for r in found] == [("a", 5), ("a", 6), ("b", None)]
    counts = joins.lookup_count(left, right, "id", "id").orderBy("id").collect()
    assert [(r.id, r.n_matches) for r in counts] == [("a", 2), ("b", 0)]


def test_dedupe(spark):
    rows = batch(spark, ("1", 5, "x"), ("2", 5, "x"), ("3", None, "x"), ("4", 6, None), ("5", 6, None))
    assert [r.id for r in dedupe.dedupe_by_content(rows, ["id"]).orderBy("id").collect()] == ["1", "3", "4"]
    firsts = dedupe.dedupe_by_key(rows, ["v"], ["id"]).orderBy("id").collect()
    assert [(r.key.v, r.id, r.n) for r in firsts] == [("x", "1", 5), (None, "4", 6)]


def test_document_queries(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, 5), (3, "b", 7)], "id int, author string, date int")
    assert docquery.find_by_key(rows, "id", "1").count() == 0
    assert docquery.find_by_key(rows, "id", 1).count() == 1
    assert docquery.find_by_key_text(rows, "id", "1").count() == 1
    assert docquery.find_by_key_text(rows, "id", "x").count() == 0
    assert [r.id for r in docquery.find_range_sorted(rows, "date", 9, ["author", "id"]).collect()] == [2, 3]
    assert docquery.find_one(rows, "author", "nobody", ["id"]).collect() == []
    assert docquery.to_sparse_json(rows).first().json == '{"id":1,"author":"a"}'
    assert docquery.head(rows, 2).count() == 2


def test_stream_equals_batch_and_survives_a_restart(spark):
    landing, path, offsets = (work_folder(spark, n) for n in ("landing", "t", "offsets"))
    shape = batch(spark).schema

    def poll():
        source = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_layer(source, lambda rows: rows.where("v <> 'bad'"), path, offsets, order=["n"]).awaitTermination()

    batch(spark, ("a", 1, "x"), ("b", 1, "bad")).coalesce(1).write.mode("append").parquet(landing)
    poll()
    batch(spark, ("a", 2, "late"), ("c", 1, "z")).coalesce(1).write.mode("append").parquet(landing)
    poll()
    poll()
    assert content(spark, path) == [("a", 1, "x"), ("c", 1, "z")]


def test_streams_into_one_table_keep_their_rows(spark):
    """Epochs of another stream, and of one with a renewed checkpoint, start at 0 and overwrite nothing."""
    path, shape = work_folder(spark, "t"), batch(spark).schema

    def poll(landing, offsets):
        source = spark.readStream.schema(shape).parquet(landing)
        stream_layer(source, lambda rows: rows, path, offsets, order=["n"]).awaitTermination()

    lands = [work_folder(spark, "landing") for _ in "ab"]
    for landing, name in zip(lands, ("one", "two")):
        batch(spark, (f"{name}0", 1, "x"), (f"{name}1", 1, "x")).write.parquet(landing)
        poll(landing, work_folder(spark, "offsets"))
    expected = [("one0", 1, "x"), ("one1", 1, "x"), ("two0", 1, "x"), ("two1", 1, "x")]
    assert content(spark, path) == expected
    batch(spark, ("one2", 1, "x")).write.mode("append").parquet(lands[0])
    poll(lands[0], work_folder(spark, "renewed"))
    assert content(spark, path) == sorted([*expected, ("one2", 1, "x")])


def test_rejects_are_kept_once(spark):
    root = work_folder(spark, "layers")
    as_of = X.fetched_at()
    rows = X.details(spark, SMALL).limit(200)
    tables.insert_ignore(rows, f"{root}/listings")
    counts = []
    for _ in range(3):
        jobs.store_records(spark, root, as_of)
        counts.append(spark.read.parquet(f"{root}/rejected/records").count())
    assert counts[0] > 0 and len(set(counts)) == 1
    done = tables.read_layer_table(spark, f"{root}/records", "records").count()
    assert done + counts[0] == 200


def test_csv_rows_that_do_not_fit(spark, tmp_path):
    """A file in another column order is refused, a short row is kept apart with its reason."""
    path = work_folder(spark, "csv")
    rows = _ids_rows(spark)
    assert files.append_csv(rows, path, "ids") == 3
    names = ";".join(files.schema_of("ids").names)
    (tmp_path / "short.csv").write_text(f"{names}\nimmobiliare;9\n")
    good, bad = files.read_layer_checked(spark, f"file://{tmp_path}", "ids")
    assert good.count() == 0 and [r.failed_rules for r in bad.collect()] == ["corrupt_row"]
    swapped = tmp_path / "swapped"
    swapped.mkdir()
    (swapped / "a.csv").write_text(";".join(reversed(names.split(";"))) + "\n" + ";".join("x" for _ in names.split(";")) + "\n")
    with pytest.raises(Exception, match="header"):
        files.read_layer(spark, f"file://{swapped}", "ids").collect()
    assert files.read_layer(spark, path, "ids").count() == 3


def _ids_rows(spark):
    return jobs.ids_of(jobs.harvest_cards(X.result_pages(spark, SMALL)), X.fetched_at()).limit(3)


def test_three_jobs_chain_and_run_again(spark):
    root = work_folder(spark, "layers")
    as_of = X.fetched_at()
    first = jobs.store_ids(X.result_pages(spark, SMALL), root, as_of, ["k"])
    assert first.inserted > 0 and jobs.store_ids(X.result_pages(spark, SMALL), root, as_of, ["k"]).inserted == 0
    saved = X.listing_pages(spark, SMALL).select("url", "html")
    copies = saved.withColumn("age", F.lit(1)).unionByName(saved.withColumns({"age": F.lit(2), "html": F.lit("stale")}))
    listings = jobs.store_listings(copies, root, as_of, prefer=[F.col("age")])
    assert 0 < listings.inserted < first.inserted
    drawn = jobs.store_records(spark, root, as_of, sample=100)
    rest = jobs.store_records(spark, root, as_of)
    again = jobs.store_records(spark, root, as_of)
    assert drawn.inserted <= 100 and rest.inserted > 0 and again.inserted == 0
    stored = tables.read_layer_table(spark, f"{root}/records", "records")
    assert stored.count() == stored.select("id").distinct().count() == drawn.inserted + rest.inserted
    bad = spark.read.parquet(f"{root}/rejected/listings")
    assert listings.inserted + bad.count() == first.inserted


def test_a_large_batch_is_written_by_more_tasks_than_buckets(spark, monkeypatch):
    path = work_folder(spark, "t")
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"), F.md5(F.col("id").cast("string")).alias("v")).repartition(64)
    monkeypatch.setattr(tables, "PIECE_BYTES", 4096)
    assert tables.insert_ignore(rows, path) == InsertCounts(20_000, 0)
    stored = tables.read_table(spark, path, rows.schema)
    assert len(stored.inputFiles()) > 2 * tables.BUCKETS
    assert stored.select("id").distinct().count() == 20_000
    assert tables.insert_ignore(rows, path) == InsertCounts(0, 20_000)
    out = work_folder(spark, "t2")
    tables.compact(spark, path, rows.schema, "id", out)
    assert len(tables.read_table(spark, out, rows.schema).inputFiles()) > 2 * tables.BUCKETS
    assert tables.read_table(spark, out, rows.schema).count() == 20_000


@pytest.fixture
def layers(spark):
    """Two bucketed layer tables, opened by any number of buckets."""

    def opened(layer, buckets=8):
        table = bucketed.open_bucketed(spark, f"{layer}_{tag}", f"{root}/{layer}", batch(spark).schema, buckets=buckets)
        names.append(table.name)
        return table

    root, names = work_folder(spark, "bucketed"), []
    tag = root.rsplit("-", 1)[1]
    yield opened
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def held(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_bucketed_insert_ignore(spark, layers):
    table, put = layers("ids"), bucketed.insert_ignore_bucketed
    assert put(batch(spark), table) == InsertCounts(0, 0)
    assert put(batch(spark, ("a", 0, "old"), (None, 1, "x")), table, ["n"], "1") == InsertCounts(1, 0, 1)
    new = batch(spark, ("a", 1, "new"), ("b", 2, "b2"), ("b", 1, "b1"), ("c", 1, "c"))
    assert put(new, table, ["n"], "2") == InsertCounts(2, 2)
    assert held(table) == [("a", 0, "old"), ("b", 1, "b1"), ("c", 1, "c")]
    assert put(new, table, ["n"], "2") == InsertCounts(2, 2)
    assert put(new, table, ["n"], "3") == InsertCounts(0, 4)
    assert held(table) == [("a", 0, "old"), ("b", 1, "b1"), ("c", 1, "c")]


def test_a_bucketed_table_keeps_its_number_of_buckets(spark, layers):
    table = layers("ids", 8)
    bucketed.insert_ignore_bucketed(batch(spark, ("a", 0, "x")), table)
    spark.sql(f"DROP TABLE {table.name}")
    again = layers("ids", 16)
    assert again.buckets == 8 and held(again) == [("a", 0, "x")]
    with pytest.raises(ValueError):
        bucketed.open_bucketed(spark, table.name, work_folder(spark, "other"), batch(spark).schema)


def test_pending_of_bucketed_layers_shuffles_nothing(spark, layers):
    ids, listings = layers("ids"), layers("listings")
    for start in (0, 300):
        bucketed.insert_ignore_bucketed(batch(spark, *[(str(i), i, "x") for i in range(start, start + 300)]), ids)
        bucketed.insert_ignore_bucketed(batch(spark, *[(str(i), i, "y") for i in range(start, start + 300, 3)]), listings)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = joins.pending(ids.read(), listings.read())
        assert todo.count() == 400
        plan = todo._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


EDGE = "src string, dst string, score double"


def edges_in(spark, path, **some):
    rows = merged.read_merged(spark, path, spark.createDataFrame([], EDGE).schema, ["src", "dst"], **some)
    return {(r.src, r.dst): r.score for r in rows.collect()}


def test_upserts_are_merged_when_read(spark):
    path, keys = work_folder(spark, "edges"), ["src", "dst"]
    schema = spark.createDataFrame([], EDGE).schema
    assert edges_in(spark, path) == {}
    put = lambda rows, name: merged.upsert(spark.createDataFrame(rows, EDGE), path, keys, ["score"], name)
    put([("a", "b", 1.0), ("a", "c", 1.0), ("a", "c", 2.0), (None, "c", 3.0), ("a", None, 3.0)], "1")
    assert edges_in(spark, path) == {("a", "b"): 1.0, ("a", "c"): 2.0}
    for _ in range(2):
        put([("a", "b", None), ("d", "e", 5.0)], "2")
        assert edges_in(spark, path) == {("a", "b"): None, ("a", "c"): 2.0, ("d", "e"): 5.0}
    whole = edges_in(spark, path)
    assert merged.fold(spark, path, schema, keys) and edges_in(spark, path) == whole
    assert merged.fold(spark, path, schema, keys) == [] and edges_in(spark, path) == whole
    # A batch that the base holds, run again late, does not come back to life.
    put([("a", "b", 9.0)], "1")
    assert edges_in(spark, path) == whole
    put([("a", "b", 7.0)], "3")
    put([], "4")
    assert edges_in(spark, path) == {**whole, ("a", "b"): 7.0}
    with pytest.raises(ValueError):
        put([], "~1")


def test_a_fold_cut_short_changes_nothing(spark, monkeypatch):
    """New bases are written, the older folders are still there."""
    path, keys, schema = work_folder(spark, "edges"), ["src", "dst"], spark.createDataFrame([], EDGE).schema
    for name, score in (("1", 1.0), ("2", 2.0)):
        merged.upsert(spark.createDataFrame([(str(i), "x", score) for i in range(int(name) * 20)], EDGE), path, keys, batch_id=name)
    whole = edges_in(spark, path)
    with monkeypatch.context() as m:
        m.setattr(merged, "_remove_older", lambda *_: None)
        merged.fold(spark, path, schema, keys)
    assert edges_in(spark, path) == whole and set(whole.values()) == {2.0} and len(whole) == 40
    merged.upsert(spark.createDataFrame([("3", "x", 5.0)], EDGE), path, keys, batch_id="3")
    assert len(merged.fold(spark, path, schema, keys)) == 1
    assert edges_in(spark, path) == {**whole, ("3", "x"): 5.0}


def test_a_small_upsert_touches_its_buckets_alone(spark):
    path, keys, schema = work_folder(spark, "edges"), ["src", "dst"], spark.createDataFrame([], EDGE).schema
    merged.upsert(spark.range(2000).selectExpr("cast(id as string) src", "'x' dst", "0.5D score"), path, keys, batch_id="1")
    assert len(merged.fold(spark, path, schema, keys)) == tables.BUCKETS
    before = set(tables.read_table(spark, path, schema).inputFiles())
    merged.upsert(spark.createDataFrame([("7", "x", 1.0)], EDGE), path, keys, batch_id="2")
    rows = merged.read_merged(spark, path, schema, keys)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and rows.where("score = 1").count() == 1 and rows.count() == 2000
    touched = merged.fold(spark, path, schema, keys)
    after = set(tables.read_table(spark, path, schema).inputFiles())
    assert len(touched) == 1 and len(before - after) == 1 and len(after - before) == 1
    assert len(edges_in(spark, path, buckets=touched)) < 200
