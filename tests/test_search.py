import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from motorlake.operators import facets, search
from motorlake.operators.search import SearchParams
from motorlake.plans import adapters
from motorlake.plans.search_queries import SEARCH


@pytest.fixture(scope="module")
def items(spark, sf):
    return adapters.items(spark, sf)


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("typed"))
    search.write_typed_items(adapters.items(spark, sf), path)
    return spark.read.parquet(path)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_request_arguments():
    got = SearchParams.from_request({"page": "2", "make": "Kia", "min_km": "0", "max_price_usd": "9.5", "max_km": ""})
    assert got == SearchParams(page=2, make="Kia", min_km=0, max_price_usd=9.5)


def test_no_filter_keeps_all(items):
    assert search.matching_items(items, SearchParams()).count() == items.count()


def test_unknown_numbers_pass_upper_bounds_only(items):
    unknown = items.where("at_text = 'N/A' and p_text = 'N/A'")
    assert unknown.count() > 0
    assert search.filter_km_range(unknown, high=5).count() == unknown.count()
    assert search.filter_km_range(unknown, low=1).count() == 0
    assert search.filter_price_usd_range(unknown, high=1.0).count() == unknown.count()


def test_pages_cover_the_matches_in_order(items):
    rows = search.matching_items(items, SearchParams(fuel="diesel"))
    want = ids(rows.orderBy("ingest_seq", "id"))
    got, page = [], 1
    while True:
        one = ids(search.paginate(rows, page))
        got += one
        page += 1
        if len(one) < 24:
            break
    assert got == want
    assert ids(search.paginate(rows, -3)) == want[:24]
    last = rows.orderBy("ingest_seq", "id").collect()[23]
    assert ids(search.page_after(rows, last["ingest_seq"], last["id"])) == want[24:48]


def test_deep_pages_and_null_orders(spark):
    seqs = [i * i for i in range(200)] + [10_000] * 30 + [10**12] + [None] * 7
    rows = spark.createDataFrame([(s, f"{i:04d}") for i, s in enumerate(seqs)], "ingest_seq long, id string")
    order = sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for page in (2, 9, 20, 46, 47, 48, 10**6):
        want = [tuple(r) for r in search.paginate(rows, page, 5).collect()]
        assert want == order[(page - 1) * 5 : page * 5], page
    assert search.paginate(rows.where("false"), 10, 5).collect() == []
    walked, last = [], (None, "")
    while part := [tuple(r) for r in search.page_after(rows, *last, 50).collect()]:
        walked += part
        last = part[-1]
    assert walked == order


def test_has_more(spark):
    rows = spark.createDataFrame([(0,), (23,), (24,), (48,), (49,)], "n long")
    first = [r[0] for r in rows.select(search.has_more(F.col("n"), 1)).collect()]
    assert first == [False, False, True, True, True]
    third = [r[0] for r in rows.select(search.has_more(F.col("n"), 3)).collect()]
    assert third == [False, False, False, False, False]


@pytest.mark.parametrize(
    "params",
    [
        SEARCH,
        SearchParams(),
        SearchParams(min_price_usd=100.0),
        SearchParams(max_price_usd=50.0, max_km=30000),
        SearchParams(min_price_usd=0.0, max_price_usd=0.0),
        SearchParams(model="widget", min_km=1),
    ],
)
def test_typed_search_equals_raw_search(items, stored, params):
    raw = search.vehicle_search(items, params)
    typed = search.typed_vehicle_search(stored, params)
    assert [tuple(r) for r in raw.collect()] == [tuple(r) for r in typed.collect()]


def test_exact_dollar_bound_survives_the_widened_one(stored):
    usd = [r[0] for r in stored.where("currency = 'EUR'").select(F.col("price_value") / 0.93).limit(5).collect()]
    for bound in usd:
        got = search.matching_typed_items(stored, SearchParams(min_price_usd=bound, max_price_usd=bound))
        assert got.where("currency = 'EUR'").count() >= 1
        assert got.where(F.col("currency") == "EUR").where(F.col("price_value") / 0.93 != bound).count() == 0


def test_typed_bounds_reach_the_scan(stored):
    plan = plan_of(search.matching_typed_items(stored, SEARCH))
    assert "GreaterThanOrEqual(km,5000)" in plan and "GreaterThanOrEqual(price_value" in plan


def test_page_key_reaches_the_scan(stored):
    assert "GreaterThanOrEqual(ingest_seq,100)" in plan_of(search.page_after(stored, 100))


def test_search_is_one_jvm_stage(items):
    plan = plan_of(search.vehicle_search(items, SEARCH))
    assert "TakeOrderedAndProject" in plan
    for bad in ("Exchange", "Python", "Join"):
        assert bad not in plan


def test_rates(spark):
    history = spark.createDataFrame(
        [("EUR", 0.9, 1), ("EUR", 0.93, 3), ("EUR", 0.95, 2), ("GEL", 2.7, 1)], "currency string, per_usd double, as_of int"
    )
    current = search.current_rates(history)
    assert sorted(tuple(r) for r in current.collect()) == [("EUR", 0.93, 3), ("GEL", 2.7, 1)]
    assert search.read_rates(current) == {"EUR": 0.93}
    rows = spark.createDataFrame([(1, "EUR"), (2, "XXX"), (3, None)], "id int, currency string")
    got = sorted((r.id, r.per_usd) for r in search.rates_lookup(rows, current).collect())
    assert got == [(1, 0.93), (2, None), (3, None)]


def test_convert_there_and_back(spark):
    rates = search.rates_table(spark)
    rows = spark.createDataFrame([(100.0, "EUR", "AMD"), (5.0, "GEL", "RUB"), (0.0, "USD", "EUR")], "a double, f string, t string")
    there = search.convert_currency(rows, rates, "a", "f", "t", "b")
    back = search.convert_currency(there, rates, "b", "t", "f", "c")
    for r in back.collect():
        assert r.c == pytest.approx(r.a)
    assert "BroadcastHashJoin" in plan_of(there)


def test_facet_children_add_up(items):
    tree = facets.facet_tree(items).collect()
    makes = {r["make"]: r["n"] for r in facets.facet_make_counts(items).collect()}
    assert {t["name"]: t["count"] for t in tree} == makes
    for make in makes:
        parts = sorted((t for t in tree if t["name"] == make), key=lambda t: t["part"])
        names = [m["name"] for t in parts for m in t["models"]]
        assert names == sorted(names) and len(names) == len(set(names))
        assert sum(m["count"] for t in parts for m in t["models"]) == makes[make]


def test_facets_of_typed_items_read_two_columns(items, stored):
    want = sorted(tuple(r) for r in facets.make_model_counts(items).collect())
    counts = facets.make_model_counts(stored)
    assert sorted(tuple(r) for r in counts.collect()) == want
    assert "ReadSchema: struct<make:string,model:string>" in plan_of(counts)


def test_parts_follow_names_alone(items):
    whole = {(t["name"], m["name"]): m["count"] for t in facets.facet_tree(items, 0).collect() for m in t["models"]}
    parts = facets.facet_tree(items, 3).collect()
    dealt = {(t["name"], m["name"]): m["count"] for t in parts for m in t["models"]}
    assert dealt == whole and len(dealt) == sum(len(t["models"]) for t in parts)
    assert all(m["name"].startswith(t["part"]) and len(t["part"]) <= 3 for t in parts for m in t["models"])


def test_stored_items_skip_files_before_the_page(items, tmp_path):
    import glob

    import pyarrow.parquet as pq

    items.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        search.write_typed_items(items, str(tmp_path / "typed"))
    finally:
        items.sparkSession.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = []
    for path in glob.glob(f"{tmp_path}/typed/*.parquet"):
        for group in range((meta := pq.ParquetFile(path).metadata).num_row_groups):
            column = next(c for c in map(meta.row_group(group).column, range(meta.num_columns))
                          if c.path_in_schema == "ingest_seq")
            spans.append((column.statistics.min, column.statistics.max))
    spans.sort()
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_menus(spark):
    rows = spark.createDataFrame([("Kia", "Rio", "a"), ("Kia", "Ceed", None), ("BMW", "X5", "a")], "Make string, Model string, Color string")
    got = [tuple(r) for r in facets.distinct_options(rows, ["Make", "Color"]).collect()]
    assert got == [("Color", None), ("Color", "a"), ("Make", "BMW"), ("Make", "Kia")]
    assert [r[0] for r in facets.cascading_models(rows, "Kia").collect()] == ["Ceed", "Rio"]
    assert facets.cascading_models(rows).count() == 3
    assert sorted(tuple(r) for r in facets.catalog_counts(a=rows, b=rows.limit(1)).collect()) == [("a", 3), ("b", 1)]
