"""Title index, positions, facets kept by change and ordered statistics, against plain forms."""

import random

import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F

from motorlake.operators import (
    facet_views,
    facets,
    ordered_stats,
    positions,
    ranges,
    resume_ledger,
    search,
    title_index,
    unify,
    validated_model,
)
from motorlake.plans import adapters
from motorlake.session import new_folder

SCHEMA = "id string, l_text string, ingest_seq long"
TITLES = [
    "2015 Toyota Camry, XLE", "TOYOTA toyota", "to", "", None, "aaaa", "aaab", "100% \\ new_car", "Škoda Éclair", "škoda",
    "naïve 漢字漢字 title", "İstanbul", "a b c d", "Toyota Camry", "camry Toyota", "xle, camry toy",
]
PATTERNS = [
    "toyota", "TOYOTA", "camry", "to", "", "%", "_", "t_yota", "toy%cam", "cam%toy", "aaa", "aaaa", "aab", "\\", "100%", "new_car",
    "šKODA", "Škoda", "éclair", "漢字漢", "xyz", "toyota camry, xle", "a b", "___", "i̇stanbul", "İst", "car%", "%%toy__a%%",
]


def items(spark, copies=1):
    rows = [(f"{k}-{i}", t, None if i % 5 == 4 else k * 100 + i) for k in range(copies) for i, t in enumerate(TITLES)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def index(spark):
    rows = items(spark, 20)
    path = new_folder(spark, "title-index")
    title_index.build(rows, path, buckets=8, block=16)
    return rows, path


@pytest.mark.parametrize("wanted", PATTERNS)
def test_index_finds_what_a_scan_finds(spark, index, wanted):
    rows, path = index
    found = title_index.find(spark, path, wanted)
    assert found.columns == rows.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, search.filter_title_like(rows, wanted).collect()))


def test_index_opens_only_the_buckets_of_its_trigrams(spark, index):
    _, path = index
    plan = plan_of(title_index.candidates(spark, path, {"toy", "oyo"}))
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    lists = spark.read.parquet(f"{path}/lists")
    assert lists.agg(F.max(F.size("places"))).first()[0] <= 16
    assert lists.groupBy("gram", "page_part", "block").count().where("count > 1").count() == 0


def test_index_of_nothing(spark):
    path = new_folder(spark, "title-index")
    title_index.build(items(spark).limit(0), path)
    assert title_index.find(spark, path, "toyota").collect() == [] == title_index.find(spark, path, "").collect()


def test_slices_are_pages(spark):
    rows = items(spark, 9)
    path = new_folder(spark, "pages")
    positions.store_in_order(rows, path, [F.col("ingest_seq").asc_nulls_first(), F.col("id")])
    total = rows.count()
    assert positions.total(spark, path) == total
    every = positions.with_positions(spark, path).collect()
    assert sorted(r.position for r in every) == list(range(total))
    for page in (1, 2, 4, total // 24 + 1, total // 24 + 2, 1000):
        got = positions.slice_of(spark, path, (page - 1) * 24, 24)
        assert [r.id for r in got.collect()] == [r.id for r in search.paginate(rows, page).collect()]
        assert [r.position for r in got.collect()] == list(range((page - 1) * 24, min(page * 24, total)))
    plan = plan_of(positions.slice_of(spark, path, 48, 24))
    assert "GlobalLimit" not in plan and "TakeOrdered" not in plan and "page_part" in plan.split("PartitionFilters")[1][:80]
    assert "place" in plan.split("PushedFilters")[1][:300]


def test_positions_of_nothing(spark):
    path = new_folder(spark, "pages")
    positions.store_in_order(items(spark).limit(0), path, [F.col("id")])
    assert positions.total(spark, path) == 0 and positions.slice_of(spark, path, 0, 24).collect() == []
    assert positions.with_positions(spark, path).collect() == []


def counted(rows):
    return sorted(((r.make, r.model, r.n) for r in rows.collect()), key=str)


def test_facets_after_batches_equal_a_recount(spark):
    rng = random.Random(3)
    title = lambda: rng.choice(["2010 Audi A4, x", "2011 Audi A6, y", "Trailer", "2012 BMW X5, z", None])
    state = {str(i): title() for i in range(200)}
    root = new_folder(spark, "facets")
    first = [(i, t, n) for n, (i, t) in enumerate(state.items())] + [(None, "2010 Audi A4, x", 1)]
    facet_views.start(spark.createDataFrame(first, SCHEMA), root, buckets=4)
    for number in (1, 2, 3):
        batch = [(str(rng.randint(0, 250)), title(), n) for n in range(60)] + [(None, "2012 BMW X5, z", 99)]
        for i, t, _ in batch:
            if i is not None:
                state[i] = t
        rows = spark.createDataFrame(batch, SCHEMA)
        facet_views.apply_batch(rows, root, number, buckets=4)
        now = facets.make_model_counts(spark.createDataFrame([(i, t, 0) for i, t in state.items()], SCHEMA))
        assert counted(facet_views.counts(spark, root)) == counted(now)
        if number == 2:  # the same batch once more, after it was finished
            facet_views.apply_batch(rows, root, number, buckets=4)
            assert counted(facet_views.counts(spark, root)) == counted(now)
    target = new_folder(spark, "facets")
    facet_views.compact(spark, root, target)
    assert counted(facet_views.counts(spark, target)) == counted(facet_views.counts(spark, root))


def test_a_batch_reads_the_buckets_it_touches(spark):
    root = new_folder(spark, "facets")
    facet_views.start(items(spark, 20), root, buckets=16)
    one = spark.createDataFrame([("3-1", "2010 Audi A4, x", 1)], SCHEMA)
    from motorlake.operators import ingest

    rows = ingest.touched_rows(spark, f"{root}/items", one, ["id"], 16)
    filters = plan_of(rows).split("PartitionFilters: [")[1].split("\n")[0]
    assert "bucket" in filters and " IN " not in filters  # one bucket, as a filter on folders
    assert rows.select(F.input_file_name()).distinct().count() == 1


def test_parts_are_bounded_and_in_order(spark):
    rows = [("Other", f"model {i:04d}", i % 3 + 1) for i in range(500)] + [("Other", None, 2), ("Audi", "A4", 7), (None, "x", 1)]
    tree = facet_views.tree_in_parts(spark.createDataFrame(rows, "make string, model string, n long").repartition(4), 40)
    got = sorted(tree.collect(), key=lambda r: (r.name or "", r.part))
    assert max(len(r.models) for r in got) == 40
    other = [m for r in got if r.name == "Other" for m in r.models]
    assert [m["name"] for m in other] == [None] + [f"model {i:04d}" for i in range(500)]
    assert {(r.name, r["count"]) for r in got} == {("Other", sum(n for m, _, n in rows if m == "Other")), ("Audi", 7), (None, 1)}
    assert [r.part for r in got if r.name == "Other"] == list(range(13))


@pytest.mark.parametrize("blocks", [1, 7, 1000])
def test_ordered_statistics_see_earlier_rows_only(spark, blocks):
    import hashlib

    rng = random.Random(5)
    rows = [(str(i), rng.choice(["hot", "hot", "hot", "a", "b", None, ""]), "all", rng.choice([1.0, 2.5, 7.0, None])) for i in range(400)]
    table = spark.createDataFrame(rows, "id string, Make string, Model string, Log_Price double").repartition(3)
    got = {(r.id, r.feature): r for r in ordered_stats.ordered_statistics(table, ["Make", "Model"], blocks=blocks).collect()}
    assert len(got) == 800
    known = [y for *_, y in rows if y is not None]
    prior, a = sum(known) / len(known), ordered_stats.SMOOTHING
    sums = {}
    for i, make, model, y in sorted(rows, key=lambda r: hashlib.md5(r[0].encode()).hexdigest()):
        for feature, category in (("Make", make), ("Model", model)):
            n, s = sums.get((feature, category), (0, 0.0))
            row = got[i, feature]
            assert (row.category, row.seen) == (category, n)
            assert row.encoded == pytest.approx((s + a * prior) / (n + a))
            if y is not None:
                sums[feature, category] = n + 1, s + y
    wide = ordered_stats.encode_ordered(table, ["Make", "Model"], blocks=blocks)
    assert wide.columns == ["id", "Make_enc", "Model_enc"] and wide.count() == 400


def test_ranges_against_all_pairs(spark):
    rng = random.Random(6)
    prices = [(str(i), rng.choice([100.0, 100.0, rng.uniform(0, 1000), rng.randint(0, 10) * 100.0])) for i in range(300)] + [("x", None)]
    bounds = [(k, float(a), float(a + rng.randint(0, 300))) for k in range(60) for a in [rng.randint(-50, 1100)]]
    bounds += [(60, -1e9, 1e9), (61, 5.0, 4.0), (62, None, 5.0), (63, 100.0, 100.0), (64, 0.0, 1000.0)]
    rows = spark.createDataFrame(prices, "id string, price double")
    table = spark.createDataFrame(bounds, "range_id long, lo double, hi double")
    want = sorted((i, k) for i, p in prices for k, lo, hi in bounds if p is not None and lo is not None and lo <= p <= hi)
    for bins, salts in ((1024, 16), (1, 1), (7, 3)):
        met = ranges.range_join(rows, table, "price", bins, salts)
        assert met.columns == ["id", "price", "range_id", "lo", "hi"]
        assert sorted((r.id, r.range_id) for r in met.collect()) == want
    plan = plan_of(met)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ranges.range_join(rows.limit(0), table, "price").collect() == []
    same = ranges.range_join(rows.where("price = 100"), table, "price")
    assert sorted((r.id, r.range_id) for r in same.collect()) == [w for w in want if dict(prices)[w[0]] == 100.0]


def test_ledger_counts_after_batches(spark):
    rng = random.Random(7)
    path = new_folder(spark, "ledger")
    cars, done = set(), set()
    ids = lambda some: spark.createDataFrame([(str(i),) for i in some] + [(None,)], "id string")
    for batch in range(4):
        new, seen = [rng.randint(0, 200_000) for _ in range(80)], [rng.choice([5, 32_768, 32_769, 0, rng.randint(0, 200_000)]) for _ in range(50)]
        cars.update(new)
        done.update(seen)
        resume_ledger.add(path, "cars", batch, ids(new), "id")
        for _ in range(2 if batch == 1 else 1):  # one batch twice
            resume_ledger.add(path, "tags", batch, ids(seen), "id")
        (row,) = resume_ledger.pending_counts(spark, path).collect()
        assert tuple(row) == (len(cars), len(done), len(cars - done))
    target = new_folder(spark, "ledger")
    resume_ledger.compact(spark, path, target)
    assert tuple(resume_ledger.pending_counts(spark, target).first()) == (len(cars), len(done), len(cars - done))


def test_tag_objects_hold_every_attribute(spark):
    rows = [("1", "a", "first", 1), ("1", "a", "late", 2), ("1", "it's", "x", 3), ("2", 'say "b"', "y", 1), ("2", "a", None, 1),
            ("3", None, "z", 1), (None, "a", "z", 1), ("4", "a", "", None)]
    tags = spark.createDataFrame(rows, "car_id string, attribute string, value string, seq long")
    names = unify.attribute_names(tags)
    objects = unify.tag_objects(tags)
    got = objects.select("car_id", *[unify.tag_value(n).alias(n) for n in names], unify.tag_value("none").alias("none"))
    want = unify.pivot_tags(tags, names).withColumn("none", F.lit(None).cast("string"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_self_closed_hidden_elements_hold_nothing(spark):
    from motorlake.operators import extract

    pages = ['<td><i style="display:none"/>keep</td>', '<b style="none"/><p>a</p>', "plain", None, '<i style="display:&#110;one">x</i>y',
             '<u style="none"><i/>gone</u>stays', '<img style="none">a<br/>b']
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = {r.i: r.html for r in rows.select("i", extract.strip_hidden_nodes(F.col("html")).alias("html")).collect()}
    assert got == {0: "<td>keep</td>", 1: "<p>a</p>", 2: "plain", 3: None, 4: "y", 5: "stays", 6: "a<br/>b"}


def test_newest_rate_is_decided_whatever_the_order(spark):
    rows = [("USD", 2.0, 5), ("USD", 3.0, 5), ("USD", 9.0, 1), ("EUR", 4.0, None), ("AMD", 7.0, None), ("AMD", 1.0, 3)]
    for some in (rows, rows[::-1]):
        history = spark.createDataFrame(some, "currency string, per_usd double, as_of int").coalesce(1)
        got = {r.currency: (r.per_usd, r.as_of) for r in search.current_rates(history).collect()}
        assert got == {"USD": (3.0, 5), "EUR": (4.0, None), "AMD": (1.0, 3)}


def test_first_landing_counts_in_one_micro_batch(spark, tmp_path):
    from motorlake.streaming import landing

    page = '<table class="pad-top-6 ad-det"><tbody><tr><td>Color</td><td>{}</td></tr></tbody></table>'
    rows = [("1", page.format("z first"), 10), ("1", page.format("a second"), 11), ("2", page.format("only"), 12)]
    land, log, check = (str(tmp_path / n) for n in ("land", "log", "check"))
    pages = spark.createDataFrame(rows, "car_id string, html string, landed long")
    pages.coalesce(1).write.parquet(land)
    stream = landing.read_landing(spark, land, pages.schema)
    landing.stream_detail_tags(stream, log, check, landing="landed").awaitTermination()
    want = {("1", "Color", "z first"), ("2", "Color", "only")}
    assert {tuple(r) for r in landing.first_tags(spark, log).collect()} == want
    landing.compact_tag_log(spark, log, str(tmp_path / "compact"))
    assert {tuple(r) for r in landing.first_tags(spark, str(tmp_path / "compact")).collect()} == want


def test_the_round_chosen_is_the_minimum_of_the_log(spark):
    from motorlake.operators import model
    from motorlake.sources import tables

    train, _ = model.train_test_split(tables.materialise(adapters.training_set(spark, SF), new_folder(spark, "train")))
    path = new_folder(spark, "validated")
    settings = model.TrainingSettings(depth=3, rounds=12)
    fitted = validated_model.train_validated(train, path, settings)
    curve = sorted(validated_model.fitted_curve(train, path).collect())
    rounds = fitted.stages[1].getNumTrees
    assert [r.iter for r in curve] == list(range(rounds)) and 1 <= rounds <= 12
    assert [r.iter for r in curve if r.best] == [min(curve, key=lambda r: (r.RMSE, r.iter)).iter]
    assert curve[-1].best  # what lies behind the minimum was dropped
    held = train.where(model.is_test(F.col("id"), validated_model.SHARE, 43))
    scored = model.predict_price(held, path, fitted)
    assert model.rmse_log(scored).first()[0] == pytest.approx(curve[-1].RMSE)


def test_train_and_evaluate(spark):
    """The whole job: its figures are those of the stored model on the test part."""
    from motorlake.operators import features, model
    from motorlake.plans import price_model

    path = new_folder(spark, "price-model")
    cars, tags = adapters.cars(spark, SF), adapters.tags(spark, SF)
    (got,) = price_model.train_and_evaluate(cars, tags, path, model.TrainingSettings(depth=3, rounds=4)).collect()
    _, test = model.train_test_split(features.build_training_set(adapters.unified(spark, SF)))
    rows = model.predict_price(test, path).select("Price", "prediction").collect()
    mean = sum(r.Price for r in rows) / len(rows)
    miss = [r.Price - r.prediction for r in rows]
    assert got.mae == pytest.approx(sum(map(abs, miss)) / len(rows))
    assert got.r2 == pytest.approx(1 - sum(m * m for m in miss) / sum((r.Price - mean) ** 2 for r in rows))
