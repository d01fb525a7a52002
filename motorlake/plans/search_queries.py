"""Registered queries: parsing, search, rates and facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.functions import listing as L
from motorlake.functions.sql import register_functions
from motorlake.operators import facets, features, search
from motorlake.plans import adapters
from motorlake.plans.registry import query, with_tables
from motorlake.session import new_folder

SEARCH = search.SearchParams(
    page=1,
    make="brand#1",
    fuel="gasoline,Hybrid",
    min_km=5000,
    max_km=85000,
    min_price_usd=10.0,
    max_price_usd=70000.0,
)
_MATCH = (
    "l_text ilike '%brand#1%' and at_text <> '' and (contains(lower(at_text), 'gasoline') "
    "or contains(lower(at_text), 'hybrid')) and km >= 5000 and km <= 85000 "
    "and usd >= 10.0 and usd <= 70000.0"
)
_VIEW = """
  id, image_src as image, price_value as price_raw, currency as currency_original, year, make, model,
  spec as engine, location, format('{:,} km', km) as mileage, fuel
"""


# ---------------------------------------------------------------- scalar parsing

@query("parse_price", with_tables("parsed", "select id, price_value, currency from parsed"))
def parse_price(spark, sf):
    text = F.col("p_text")
    return adapters.items(spark, sf).select(
        "id", L.price_value(text).alias("price_value"), L.price_currency(text).alias("currency")
    )


@query("price_usd", with_tables("parsed", "select id, round(usd, 4) as usd from parsed"))
def price_usd(spark, sf):
    return adapters.items(spark, sf).select("id", F.round(L.price_usd(F.col("p_text")), 4).alias("usd"))


@query("mileage_km", with_tables("parsed", "select id, km from parsed"))
def mileage_km(spark, sf):
    return adapters.items(spark, sf).select("id", L.mileage_km(F.col("at_text")).alias("km"))


@query("parse_title", with_tables("parsed", "select id, year, make, model, spec from parsed"))
def parse_title(spark, sf):
    title = L.parse_title(F.col("l_text")).alias("title")
    return adapters.items(spark, sf).select("id", title).select("id", "title.*")


@query("fuel_label", with_tables("parsed", "select id, fuel from parsed"))
def fuel_label(spark, sf):
    return adapters.items(spark, sf).select("id", L.fuel_label(F.col("at_text")).alias("fuel"))


@query("location", with_tables("parsed", "select id, location from parsed"))
def location(spark, sf):
    return adapters.items(spark, sf).select("id", L.location(F.col("at_text")).alias("location"))


@query("mileage_label", with_tables("parsed", "select id, format('{:,} km', km) as mileage from parsed"))
def mileage_label(spark, sf):
    km = L.mileage_km(F.col("at_text"))
    return adapters.items(spark, sf).select("id", L.mileage_label(km).alias("mileage"))


_PAIRS = """
  select cast(o_orderkey as varchar(20)) as id,
    case when o_orderkey % 50 = 0 then cast(0 as double) else o_totalprice end as amount,
    case o_orderkey % 5 when 0 then 'USD' when 1 then 'EUR' when 2 then 'AMD' when 3 then 'RUB' else 'GEL' end as source,
    case o_orderkey % 7 when 0 then 'AMD' when 1 then 'USD' when 2 then 'GEL' when 3 then 'EUR' else 'RUB' end as target
  from {orders}
"""
_RATE_PAIRS = (
    "from pairs left join rates f on f.currency = source left join rates t on t.currency = target"
)
_CONVERTED = "amount / coalesce(f.per_usd, 1) * coalesce(t.per_usd, 1)"


def _pairs(spark, sf):
    return spark.sql(_PAIRS, orders=adapters.table(spark, sf, "orders"))


@query(
    "convert_currency",
    with_tables(
        "rates",
        f"select id, round({_CONVERTED}, 4) as converted {_RATE_PAIRS}",
        pairs=_PAIRS.format(orders="orders"),
    ),
)
def convert_currency(spark, sf):
    rates = search.rates_table(spark)
    rows = search.convert_currency(_pairs(spark, sf), rates, "amount", "source", "target", "converted")
    return rows.select("id", F.round("converted", 4).alias("converted"))


@query(
    "format_price",
    "select cast(o_orderkey as varchar(20)) as id, concat(case o_orderkey % 4 when 0 then '$' when 1 then '€' "
    "when 2 then concat('AMD', chr(160)) else concat('RUB', chr(160)) end, "
    "format('{:,}', cast(round(floor(o_totalprice) / 2) as bigint))) as label from orders",
)
def format_price(spark, sf):
    key = F.col("o_orderkey") % 4
    code = F.when(key == 0, "USD").when(key == 1, "EUR").when(key == 2, "AMD").otherwise("RUB")
    amount = F.floor("o_totalprice") / 2
    return adapters.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), L.format_price(amount, code).alias("label")
    )


@query(
    "format_estimate",
    "select cast(o_orderkey as varchar(20)) as id, format('${:,.0f}', floor(o_totalprice) / 2) as label from orders",
)
def format_estimate(spark, sf):
    return adapters.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        L.format_estimate(F.floor("o_totalprice") / 2).alias("label"),
    )


@query("log_price", "select cast(o_orderkey as varchar(20)) as id, round(ln(1 + o_totalprice), 6) as log_price from orders")
def log_price(spark, sf):
    return adapters.cars(spark, sf).select("id", F.round(L.log_price(F.col("price")), 6).alias("log_price"))


@query("exp_price", "select cast(o_orderkey as varchar(20)) as id, round(o_totalprice, 2) as price from orders")
def exp_price(spark, sf):
    back = L.exp_price(L.log_price(F.col("price")))
    return adapters.cars(spark, sf).select("id", F.round(back, 2).alias("price"))


# ---------------------------------------------------------------- filters, paging, view

_RAW = "id, p_text, l_text, at_text"


def _raw(rows):
    return rows.select("id", "p_text", "l_text", "at_text")


@query("filter_make_like", with_tables("items", f"select {_RAW} from items where l_text ilike '%BRAND#1%'"))
def filter_make_like(spark, sf):
    return _raw(search.filter_title_like(adapters.items(spark, sf), "BRAND#1"))


@query("filter_model_like", with_tables("items", f"select {_RAW} from items where l_text ilike '%r_d %g, e%'"))
def filter_model_like(spark, sf):
    return _raw(search.filter_title_like(adapters.items(spark, sf), "R_d %g, e"))


@query(
    "filter_fuel_any",
    with_tables(
        "items",
        f"select {_RAW} from items where contains(lower(at_text), 'diesel') or contains(lower(at_text), ' hybrid')",
    ),
)
def filter_fuel_any(spark, sf):
    return _raw(search.filter_fuel_any(adapters.items(spark, sf), "DIESEL, hybrid"))


@query("filter_km_range", with_tables("parsed", f"select {_RAW} from parsed where km >= 20000 and km <= 60000"))
def filter_km_range(spark, sf):
    return _raw(search.filter_km_range(adapters.items(spark, sf), 20000, 60000))


@query("filter_price_usd_range", with_tables("parsed", f"select {_RAW} from parsed where usd >= 100 and usd <= 5000"))
def filter_price_usd_range(spark, sf):
    return _raw(search.filter_price_usd_range(adapters.items(spark, sf), 100.0, 5000.0))


@query(
    "vehicle_search",
    with_tables("parsed", f"select {_VIEW} from parsed where {_MATCH} order by ingest_seq, id limit 24"),
)
def vehicle_search(spark, sf):
    return search.vehicle_search(adapters.items(spark, sf), SEARCH)


@query("vehicle_search_matches", with_tables("parsed", f"select {_VIEW} from parsed where {_MATCH}"))
def vehicle_search_matches(spark, sf):
    return search.listing_view(search.matching_items(adapters.items(spark, sf), SEARCH))


@query(
    "typed_vehicle_search",
    with_tables("parsed", f"select {_VIEW} from parsed where {_MATCH} order by ingest_seq, id limit 24"),
)
def typed_vehicle_search(spark, sf):
    path = new_folder(spark, "typed-items")
    search.write_typed_items(adapters.items(spark, sf), path)
    return search.typed_vehicle_search(spark.read.parquet(path), SEARCH)


_BOUNDS = """
  select cast(o_orderkey as varchar(20)) as id,
    case o_orderkey % 6 when 0 then null when 1 then cast(0 as double) else o_totalprice end as bound,
    case o_orderkey % 5 when 0 then 'USD' when 1 then 'EUR' when 2 then 'AMD' when 3 then 'RUB' else 'GEL' end as currency
  from {orders}
"""


@query(
    "price_bounds_to_usd",
    with_tables(
        "rates",
        "select id, round(nullif(bound, 0) / coalesce(per_usd, 1), 4) as bound_usd from b "
        "left join rates on rates.currency = b.currency",
        b=_BOUNDS.format(orders="orders"),
    ),
)
def price_bounds_to_usd(spark, sf):
    bounds = spark.sql(_BOUNDS, orders=adapters.table(spark, sf, "orders"))
    priced = search.rates_lookup(bounds, search.rates_table(spark))
    usd = L.bound_to_usd(F.col("bound"), F.col("per_usd"))
    return priced.select("id", F.round(usd, 4).alias("bound_usd"))


@query(
    "has_more",
    with_tables(
        "parsed",
        "select make, count(*) as matched, least(count(*) - 24, 24) = 24 as more from parsed group by make",
    ),
)
def has_more(spark, sf):
    counts = facets.facet_make_counts(adapters.items(spark, sf))
    return counts.select("make", F.col("n").alias("matched"), search.has_more(F.col("n"), 2).alias("more"))


@query("paginate", with_tables("items", f"select {_RAW} from items order by ingest_seq, id limit 24 offset 48"))
def paginate(spark, sf):
    return _raw(search.paginate(adapters.items(spark, sf), 3))


@query("paginate_deep", with_tables("items", f"select {_RAW} from items order by ingest_seq, id limit 24 offset 120"))
def paginate_deep(spark, sf):
    return _raw(search.paginate(adapters.items(spark, sf), 6))


@query(
    "page_after",
    with_tables("items", f"select {_RAW} from items where ingest_seq > 47 order by ingest_seq, id limit 24"),
)
def page_after(spark, sf):
    return _raw(search.page_after(adapters.items(spark, sf), 47, "47"))


@query("listing_view", with_tables("parsed", f"select {_VIEW} from parsed"))
def listing_view(spark, sf):
    return search.listing_view(adapters.items(spark, sf))


@query("listing_link", with_tables("items", "select id, concat('https://cars.example/item/', id) as link from items"))
def listing_link(spark, sf):
    link = L.detail_link("https://cars.example/item/", F.col("id"))
    return adapters.items(spark, sf).select("id", link.alias("link"))


@query("junk_price_filter", with_tables("cars", "select id, price from cars where price > 2000 and price < 80000"))
def junk_price_filter(spark, sf):
    return search.junk_price_filter(adapters.cars(spark, sf)).select("id", "price")


# ---------------------------------------------------------------- rates

@query(
    "rates_lookup",
    with_tables("parsed", "select id, currency, per_usd from parsed join rates using (currency)"),
)
def rates_lookup(spark, sf):
    rows = adapters.items(spark, sf).select("id", L.price_currency(F.col("p_text")).alias("currency"))
    return search.rates_lookup(rows, search.rates_table(spark)).select("id", "currency", "per_usd")


_RATE_HISTORY = """
  select case o_orderkey % 4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'AMD' else 'RUB' end as currency,
    o_totalprice as per_usd, {as_of} as as_of from {orders}
"""


@query(
    "current_rates",
    "select currency, max(per_usd) as per_usd from ("
    + _RATE_HISTORY.format(orders="orders", as_of="row(o_orderdate, o_totalprice)")
    + ") h where (currency, as_of) in (select currency, max(as_of) from ("
    + _RATE_HISTORY.format(orders="orders", as_of="row(o_orderdate, o_totalprice)")
    + ") g group by currency) group by currency",
)
def current_rates(spark, sf):
    text = _RATE_HISTORY.replace("{as_of}", "struct(o_orderdate, o_totalprice)")
    history = spark.sql(text, orders=adapters.table(spark, sf, "orders"))
    return search.current_rates(history).select("currency", "per_usd")


@query(
    "sql_functions",
    with_tables(
        "parsed",
        "select id, km, contains(lower(at_text), 'diesel') or contains(lower(at_text), 'hybrid') as fuel_ok, "
        "round(usd, 4) as usd from parsed where km >= 1000",
    ),
)
def sql_functions(spark, sf):
    register_functions(spark)
    return spark.sql(
        """
        select id, get_km(at_text) as km, check_fuel(at_text, 'Diesel,hybrid') as fuel_ok,
          round(get_price_usd(p_text, per_usd), 4) as usd
        from {items} i left join {rates} r on r.currency = price_currency(i.p_text)
        where get_km(at_text) >= 1000
        """,
        items=adapters.items(spark, sf),
        rates=search.rates_table(spark),
    )


# ---------------------------------------------------------------- facets

@query("facet_make_counts", with_tables("parsed", "select make, count(*) as n from parsed group by make"))
def facet_make_counts(spark, sf):
    return facets.facet_make_counts(adapters.items(spark, sf))


@query(
    "facet_make_model_counts",
    with_tables("parsed", "select make, model, count(*) as n from parsed group by make, model"),
)
def facet_make_model_counts(spark, sf):
    return facets.facet_make_model_counts(adapters.items(spark, sf))


@query(
    "facet_tree",
    with_tables(
        "parsed",
        "select make as name, cast(total as bigint) as \"count\", substr(model, 1, 2) as part, "
        "string_agg(concat(model, '=', n), ';' order by model) as models from "
        "(select make, model, count(*) as n, sum(count(*)) over (partition by make) as total "
        "from parsed group by make, model) g group by make, total, part",
    ),
)
def facet_tree(spark, sf):
    tree = facets.facet_tree(adapters.items(spark, sf))
    shown = F.array_join(F.transform("models", lambda m: F.concat(m["name"], F.lit("="), m["count"])), ";")
    return tree.select("name", "count", "part", shown.alias("models"))


_OPTIONS = "Make Condition Fuel_Type Transmission Drive_Type Body_Type Color Interior_Color".split()
_FEATURES = with_tables(
    "cars firsts",
    "",
    wide="""
      select cars.id, cars.brand as "Make", cars.model as "Model",
        max(case when attribute = 'Գույնը' then value end) as "Color",
        max(case when attribute = 'Շարժիչը' then value end) as "Fuel_Type",
        max(case when attribute = 'Վիճակը' then value end) as "Condition"
      from cars left join firsts on car_id = cars.id group by cars.id, cars.brand, cars.model
    """,
)


@query(
    "distinct_options",
    _FEATURES
    + " select distinct field, value from ("
    + " union all ".join(
        f"select '{f}' as field, "
        + (f"coalesce(nullif(\"{f}\", ''), 'Unknown')" if f in ("Make", "Condition", "Fuel_Type", "Color") else "'Unknown'")
        + " as value from wide"
        for f in _OPTIONS
    )
    + ")",
)
def distinct_options(spark, sf):
    rows = features.rename_features(adapters.unified(spark, sf))
    return facets.distinct_options(features.normalize_categoricals(rows))


@query("cascading_models", with_tables("cars", "select distinct brand as \"Make\", model as \"Model\" from cars"))
def cascading_models(spark, sf):
    return facets.cascading_models(features.rename_features(adapters.cars(spark, sf)))


@query(
    "models_of_make",
    with_tables("cars", "select distinct model as \"Model\" from cars where brand = '2-HIGH'"),
)
def models_of_make(spark, sf):
    return facets.cascading_models(features.rename_features(adapters.cars(spark, sf)), "2-HIGH")


@query(
    "catalog_counts",
    "select 'items' as table_name, count(*) as n from part union all "
    "select 'cars', count(*) from orders union all select 'tags', count(*) from lineitem",
)
def catalog_counts(spark, sf):
    return facets.catalog_counts(
        items=adapters.items(spark, sf), cars=adapters.cars(spark, sf), tags=adapters.tags(spark, sf)
    )
