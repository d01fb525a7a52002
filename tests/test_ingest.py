import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from motorlake.operators import ingest
from motorlake.plans import adapters

ITEM = "id string, image_src string, p_text string, l_text string, at_text string, ingest_seq long"


def items(spark, *rows):
    full = [(k, "i", p, l, "a", seq) for k, p, l, seq in rows]
    return spark.createDataFrame(full, ITEM)


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_whole_rows(spark):
    target = items(spark, ("1", "$1", "one", 1), ("2", "$2", "two", 2))
    batch = items(spark, ("2", "$3", None, 3), ("2", None, "new", 4), ("3", "$5", "x", 5), (None, "$6", "y", 6))
    got = ingest.upsert_latest_items(target, batch)
    assert as_set(got.select("id", "p_text", "l_text")) == [
        ("1", "$1", "one"), ("2", None, "new"), ("3", "$5", "x"),
    ]
    again = ingest.upsert_latest_items(got, batch)
    assert as_set(again.select("id", "p_text")) == as_set(got.select("id", "p_text"))
    empty = ingest.upsert_latest_items(target, batch.where("false"))
    assert as_set(empty) == as_set(target)
    assert as_set(ingest.null_key_rows(batch, ["id"]).select("p_text")) == [("$6",)]


def test_upsert_against_brute_force(spark):
    rng = random.Random(7)
    # One key holds a third of the batch.
    rows = [("hot" if rng.random() < 0.33 else str(rng.randrange(50)), f"${i}", "t", i) for i in range(600)]
    want = {}
    for key, price, _, _ in rows:
        want[key] = price
    got = ingest.upsert_latest_items(items(spark, ("hot", "old", "t", -1), ("z", "old", "t", -2)), items(spark, *rows))
    assert dict(as_set(got.select("id", "p_text"))) == {**want, "z": "old"}


def test_cars_get_a_new_timestamp(spark, sf):
    cars = adapters.cars(spark, sf).where("id < '2'")
    batch = cars.drop("scraped_at").withColumn("pos", F.lit(1))
    now = F.lit("2030-01-01").cast("timestamp")
    got = ingest.upsert_latest_cars(cars, batch, "pos", now)
    assert got.columns == cars.columns
    assert {str(r[0]) for r in got.select("scraped_at").distinct().collect()} == {"2030-01-01 00:00:00"}


def tags(spark, *rows):
    return spark.createDataFrame(list(rows), "car_id string, attribute string, value string, seq long")


def test_insert_ignore_keeps_the_first(spark):
    target = tags(spark, ("1", "a", "old", 1))
    batch = tags(spark, ("1", "a", "new", 2), ("1", "b", "x", 3), ("1", "b", "y", 4), ("2", "a", None, 5),
                 ("2", "a", "late", 6), (None, "a", "n", 7), ("1", None, "n", 8))
    got = ingest.insert_ignore_tags(target, batch)
    want = [("1", "a", "old"), ("1", "b", "x"), ("2", "a", None)]
    shown = got.select("car_id", "attribute", "value")
    assert as_set(shown) == want
    assert as_set(ingest.insert_ignore_tags(got, batch).select("car_id", "attribute", "value")) == want


def test_conflict_rules_combine_before_the_shuffle(spark, sf):
    rows = adapters.tags(spark, sf)
    plan = plan_of(ingest.first_wins(rows, ["car_id", "attribute"], F.col("seq")))
    assert "partial_min" in plan and "Window" not in plan


def test_pending_matches_set_difference(spark, sf):
    cars, raw = adapters.cars(spark, sf), adapters.tags(spark, sf)
    some = raw.where("car_id > '3'")
    pending = as_set(ingest.pending_ids(cars, some))
    assert pending == as_set(ingest.set_difference_ids(cars.select("id"), some.select("car_id")))
    counts = ingest.pending_counts(cars, some).first()
    assert counts.pending == len(pending) and counts.total == cars.count()


def test_pending_counts_orphans_and_nulls(spark):
    cars = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string")
    got = ingest.pending_counts(cars, tags(spark, ("2", "a", "b", 1), ("9", "a", "b", 2), (None, "a", "b", 3)))
    assert tuple(got.first()) == (2, 2, 1)
    assert tuple(ingest.pending_counts(cars.where("false"), tags(spark, ("9", "a", "b", 2)).where("false")).first()) == (0, 0, 0)


def test_outcomes(spark):
    pages = [(404, True), (500, True), (None, True), (200, None), (200, True), (200, True)]
    rows = spark.createDataFrame(pages, "status int, has_table boolean")
    assert as_set(ingest.outcome_summary(rows)) == [("gone", 1), ("no_table", 1), ("ok", 2), ("retry", 2)]


def test_quarantine(spark):
    raw = spark.createDataFrame(
        [("1", "12500", "\n2015\n"), ("2", "12,500", "2015"), ("3", "1", "2015 թ."), ("4", "", "2015"), (None, "1", "2"), ("5", None, None)],
        "id string, price string, year string",
    )
    good, bad = ingest.quarantine_bad_rows(raw)
    assert as_set(good.select("id", "price", "year").where("id = '1'")) == [("1", 12500.0, 2015)]
    assert good.count() == 2
    for text, price in ((" .5 ", 0.5), ("1e3", 1000.0), ("NaN", None), ("1d", None), ("Infinity", None), ("1 2", None)):
        one = spark.createDataFrame([("1", text, "2015.0")], raw.schema)
        assert ingest.coerce_cars(one).select("price", "year").first() == (price, 2015)
    assert ingest.coerce_cars(spark.createDataFrame([("1", "1", "2015.5")], raw.schema)).first()["error"] == "year"
    assert sorted((r.id or "", r.error, r.price_raw) for r in bad.collect()) == [
        ("", "id", "1"), ("2", "price", "12,500"), ("3", "year", "1"), ("4", "price", ""),
    ]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_running_total_in_blocks(spark, block):
    rng = random.Random(block)
    rows = [(g, p, rng.randrange(9)) for g in (1, 2) for p in range(1, 41) if rng.random() < 0.8]
    want, sums = [], {}
    for g, p, v in sorted(rows):
        sums[g] = sums.get(g, 0) + v
        want.append((g, p, v, sums[g]))
    frame = spark.createDataFrame(rows, "g int, p int, v int")
    assert as_set(ingest.running_total(frame, "g", "p", "v", "t", block)) == want


def test_frontier_in_blocks(spark):
    ranges = spark.createDataFrame([(1, 5, 7), (5, 9, 4), (9, 12, 0)], "range_lo int, range_hi int, pages int")
    want = [(1, 5, p) for p in range(1, 8)] + [(5, 9, p) for p in range(1, 5)]
    for block in (1, 2, 4, 100):
        assert as_set(ingest.crawl_frontier(ranges, block=block)) == want
    frontier = ingest.crawl_frontier(ranges)
    landed = frontier.where("page <> 3")
    assert as_set(ingest.frontier_pending(frontier, landed.union(landed), ["range_lo", "page"])) == [(1, 5, 3), (5, 9, 3)]
    urls = spark.createDataFrame([(1,), (2,)], "page int").select(ingest.category_url("b", F.col("page"))).collect()
    assert [u[0] for u in urls] == ["b", "b/2"]


def test_boundary_price_falls_in_both_ranges(spark):
    cars = spark.createDataFrame([("a", 20000.0), ("b", 0.5), ("c", 1.0), ("d", None)], "id string, price double")
    assert as_set(ingest.price_range_assign(cars).select("id", "lo")) == [("a", 1.0), ("a", 20000.0), ("c", 1.0)]
    assert "Join" not in plan_of(ingest.price_range_assign(cars))


def test_batch_log_replay(spark, tmp_path):
    log = str(tmp_path / "log")
    ingest.append_batch(items(spark, ("1", "$1", "a", 1)), log, 0)
    ingest.append_batch(items(spark, ("1", "$2", "a", 2), ("2", "$3", "b", 3)), log, 1)
    want = [("1", "$2"), ("2", "$3")]
    for _ in range(2):
        got = ingest.current_items(spark.read.parquet(log))
        assert as_set(got.select("id", "p_text")) == want
        ingest.append_batch(items(spark, ("1", "$2", "a", 2), ("2", "$3", "b", 3)), log, 1)


def test_upsert_in_place_touches_only_its_buckets(spark, tmp_path):
    path = tmp_path / "t"
    rows = [(str(i), f"${i}", "old", i) for i in range(200)]
    ingest.store_in_buckets(items(spark, *rows), str(path), ["id"], 32)

    def files():
        return {p.relative_to(path / "data") for p in (path / "data").rglob("*.parquet")}

    before = files()
    batch = items(spark, ("7", "$a", "new", 300), ("7", "$b", "new", 301), ("new", "$c", "new", 302))
    for turn in (1, 2):
        ingest.upsert_in_place(str(path), batch, ["id"], "ingest_seq", 32)
        got = {r["id"]: r["p_text"] for r in ingest.bucket_table(spark, str(path)).collect()}
        assert got == {**{k: p for k, p, _, _ in rows}, "7": "$b", "new": "$c"}
        fresh = {f.parts[1] for f in files() if f.parts[0] == f"version={turn}"}
        assert before <= files() and 1 <= len(fresh) <= 2
    # A run that was lost before it published its buckets changes nothing.
    items(spark, ("7", "$z", "lost", 999)).withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(
        str(path / "data" / "version=3"))
    assert {r["id"]: r["p_text"] for r in ingest.bucket_table(spark, str(path)).collect()} == got


def test_listing_tables_are_created_once(spark, tmp_path):
    from motorlake.sources import tables

    try:
        for _ in range(2):
            tables.ensure_listing_tables(spark, str(tmp_path))
            items(spark, ("1", "$1", "a", 1)).write.insertInto("items")
        assert tables.scan_table(spark, "items").count() == 2
        assert tables.scan_table(spark, "cars").schema["taxed"].dataType.simpleString() == "boolean"
        assert tables.scan_table(spark, "tags").count() == 0
        tables.write_replace(items(spark, ("2", "$1", "a", 1)), str(tmp_path / "again"))
        assert tables.scan_table(spark, str(tmp_path / "again")).first()["id"] == "2"
    finally:
        for name in ("items", "cars", "tags"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_null_orders_lose_to_known_ones(spark):
    rows = spark.createDataFrame(
        [("1", "x", None), ("2", "a", None), ("2", "b", 3), ("2", "c", 9), ("3", "y", 4), ("3", "z", 4)],
        "k string, v string, seq long",
    )
    for parts in (1, 5):
        dealt = rows.repartition(parts)
        last = {r.k: r.v for r in ingest.last_wins(dealt, ["k"], F.col("seq")).collect()}
        first = {r.k: r.v for r in ingest.first_wins(dealt, ["k"], F.col("seq")).collect()}
        assert last == {"1": "x", "2": "c", "3": "z"} and first == {"1": "x", "2": "b", "3": "y"}


def test_pages_without_a_range_have_totals_too(spark):
    pages = spark.createDataFrame([(None, 1, 5), (None, 2, 6), (1, 1, 7)], "range_id long, page long, n_rows long")
    got = sorted((r.range_id or 0, r.page, r.running_rows) for r in ingest.range_page_totals(pages).collect())
    assert got == [(0, 1, 5), (0, 2, 11), (1, 1, 7)]
