from pyspark.sql import functions as F

from motorlake.operators import ingest
from motorlake.plans import adapters, listings
from motorlake.session import new_folder, shared_root
from motorlake.streaming import landing


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_shared_folder_is_the_named_one(spark):
    assert new_folder(spark, "x").startswith(shared_root(spark) + "/x-")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_streamed_cards_equal_batch_cards(spark, sf, tmp_path):
    pages = adapters.category_pages(adapters.items(spark, sf))
    land, log, check = (str(tmp_path / n) for n in ("land", "log", "check"))
    ordered = pages.repartitionByRange(3, "page_id").sortWithinPartitions("page_id")
    ordered.write.parquet(land)

    def run():
        stream = landing.read_landing(spark, land, pages.schema, files_per_batch=1)
        landing.stream_extract_upsert(stream, log, check).awaitTermination()

    run()
    batch = listings.items_from_pages(pages).drop("ingest_seq")
    assert as_set(landing.upserted_cards(spark, log)) == as_set(batch)
    assert spark.read.parquet(log).select("batch_id").distinct().count() >= 2

    # A later page with the same item wins; old files are not read again.
    late = spark.createDataFrame(
        [(999_999, '<div class="gl"><a href="/item/5"><div class="p">late</div></a></div>')], pages.schema
    )
    late.write.mode("append").parquet(land)
    run()
    got = landing.upserted_cards(spark, log)
    assert got.where("id = '5'").first()["p_text"] == "late"
    assert got.count() == batch.count()

    landing.compact_log(spark, log, str(tmp_path / "compact"))
    assert spark.read.parquet(str(tmp_path / "compact")).count() == batch.count()


def test_first_value_wins_over_batches(spark, tmp_path):
    land, log, check = (str(tmp_path / n) for n in ("land", "log", "check"))
    schema = "car_id string, attribute string, value string, seq long"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(land)
        stream = landing.read_landing(spark, land, spark.read.parquet(land).schema)
        landing.stream_first_wins(stream, log, check).awaitTermination()

    add(("1", "a", "second", 9), ("1", "a", "first", 8))
    add(("1", "a", "late", 1), ("1", "b", "x", 2))
    want = [("1", "a", "first"), ("1", "b", "x")]
    assert as_set(landing.first_tags(spark, log)) == want
    target = spark.createDataFrame([("1", "a", "first", 8)], schema)
    batch = spark.createDataFrame([("1", "a", "late", 1), ("1", "b", "x", 2)], schema)
    merged = ingest.insert_ignore_tags(target, batch)
    assert as_set(merged.select("car_id", "attribute", "value")) == want


def test_stateful_first_value(spark, tmp_path):
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    rows = spark.createDataFrame([("1", "a", "x"), ("1", "a", "x"), ("2", "a", "y")], "car_id string, attribute string, value string")
    rows.write.parquet(land)
    first = landing.first_tags_stateful(landing.read_landing(spark, land, rows.schema))
    query = (
        first.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert as_set(spark.read.parquet(out)) == [("1", "a", "x"), ("2", "a", "y")]


def test_progress_counts_grow(spark, tmp_path):
    land, target, check = (str(tmp_path / n) for n in ("land", "target", "check"))
    rows = spark.createDataFrame([(1, "ok"), (1, "ok"), (2, "gone")], "range_id int, outcome string")
    for times in (1, 2):
        rows.coalesce(1).write.mode("append").parquet(land)
        stream = landing.read_landing(spark, land, rows.schema)
        landing.stream_progress(stream, ["range_id", "outcome"], target, check).awaitTermination()
        got = as_set(landing.progress_counts(spark, target))
        assert got == [(1, "ok", 2 * times), (2, "gone", times)]


def test_default_timestamp(spark):
    got = ingest.default_timestamp(spark.range(2)).select(F.current_timestamp() >= F.col("scraped_at"))
    assert all(r[0] for r in got.collect())


def test_progress_log_holds_changed_keys_only(spark, tmp_path):
    land, log, check = (str(tmp_path / n) for n in ("land", "log", "check"))
    schema, keys = "range_id int, outcome string", ["range_id", "outcome"]
    batches = [[(1, "ok"), (2, "gone"), (None, "ok")], [(1, "ok")], [(3, None), (3, None), (1, "ok")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        stream = landing.read_landing(spark, land, spark.createDataFrame([], schema).schema)
        landing.stream_progress_changes(stream, keys, log, check).awaitTermination()
    sizes = sorted(tuple(r) for r in spark.read.parquet(log).groupBy("batch_id").count().collect())
    assert [n for _, n in sizes] == [3, 1, 2]
    got = {tuple(r) for r in landing.progress_totals(spark, log, keys).collect()}
    assert got == {(1, "ok", 3), (2, "gone", 1), (None, "ok", 1), (3, None, 2)}


def test_fresh_tags_are_kept_for_a_time_only(spark, tmp_path):
    """Repeats inside that time are not written, later ones are, and the first value stays."""
    land, log, check = (str(tmp_path / n) for n in ("land", "log", "check"))
    schema = "car_id string, attribute string, value string, seq long"
    state = []

    def run(rows, kept):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        stream = landing.read_landing(spark, land, spark.createDataFrame([], schema).schema)
        query = landing.stream_fresh_tags(stream, log, check, kept)
        query.awaitTermination()
        state.append(query.lastProgress.stateOperators[0].numRowsTotal)

    first = [(str(i), "a", f"v{i}", 1) for i in range(100)]
    run(first, "1 day")
    run(first + [("5", "a", "changed", 0)], "1 day")
    assert state[-1] == 101
    assert spark.read.parquet(log).count() == 101  # the repeats were not written
    for k in range(4):
        run([(f"n{k}-{i}", "a", "x", 1) for i in range(10)] + first[:1], "0 seconds")
    want = {(c, a, v) for c, a, v, _ in first} | {(f"n{k}-{i}", "a", "x") for k in range(4) for i in range(10)}
    assert {tuple(r) for r in landing.first_tags(spark, log).collect()} == want
    assert state[-1] < 101 + 4 * 10


def test_fresh_tags_are_told_apart_on_disk_by_every_value_and_null(spark, tmp_path):
    """Short keys in RocksDB: tags that differ by where a null stands are different tags."""
    land, log, check = (str(tmp_path / n) for n in ("land", "log", "check"))
    schema = "car_id string, attribute string, value string, seq struct<a: long, b: long, c: struct<d: string>>"
    rows = [
        ("1", "a", "v", (1, None, ("x",))), ("1", "b", "v", (1, None, ("x",))), ("1", "c", None, (1, 1, None)),
        ("v", "d", None, None), ("v", "e", "d", (None, None, (None,))),
    ]
    again = [
        ("1", "a", "v", (None, 1, ("x",))), ("1", "b", None, (1, None, ("x",))), ("1", "c", None, (1, 1, (None,))),
        ("v", "d", None, (None, None, None)), ("v", "e", "d", (None, None, None)),
    ]
    before = dict(spark.conf.getAll)
    for landed in (rows, rows + again):
        spark.createDataFrame(landed, schema).coalesce(1).write.mode("append").parquet(land)
        stream = landing.read_landing(spark, land, spark.read.parquet(land).schema)
        query = landing.stream_fresh_tags(stream, log, check)
        query.awaitTermination()
    state = query.lastProgress.stateOperators[0]
    assert state.numRowsTotal == 10 and any(name.startswith("rocksdb") for name in state.customMetrics)
    assert spark.read.parquet(log).count() == 10
    assert {tuple(r) for r in landing.first_tags(spark, log).collect()} == {row[:3] for row in rows}
    assert dict(spark.conf.getAll) == before


def test_more_rows_land_in_more_files_of_as_many_batches(spark, sf, monkeypatch):
    from motorlake.plans import ingest_queries

    monkeypatch.setattr(ingest_queries, "FILE_PAGES", 100)
    orders = adapters.table(spark, sf, "orders")
    made = []

    def pages_of(rows):
        made.append(rows.rdd.getNumPartitions())
        return adapters.offer_pages(adapters.cars_of(rows))

    stream = ingest_queries._landed(spark, orders, pages_of)
    assert made == [3 * -(-orders.count() // 300)] and made[0] > 3 and stream.isStreaming


def test_a_batch_of_many_splits_is_dealt_into_more_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(100).coalesce(1), spark.range(100).repartition(3 * cores)
    assert landing._dealt(few).rdd.getNumPartitions() == max(cores, landing.TASKS_A_SPLIT)
    assert landing._dealt(many).rdd.getNumPartitions() == landing.TASKS_A_SPLIT * 3 * cores


def test_landed_detail_pages_of_many_files_give_every_tag(spark, sf, monkeypatch):
    from motorlake.plans import ingest_queries, price_model

    monkeypatch.setattr(ingest_queries, "FILE_PAGES", 100)
    got = ingest_queries.stream_detail_tags(spark, sf)
    pages = adapters.detail_pages(adapters.cars(spark, sf))
    want = price_model.tags_from_pages(pages).select("car_id", "attribute", "value")
    assert as_set(got) == as_set(want)
