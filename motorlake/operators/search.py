"""Listing search: filters, paging and the typed listing view."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.functions import listing as L
from motorlake.functions.text import contains_like


@dataclass(frozen=True)
class SearchParams:
    """Search arguments; an empty text or None means the filter is off."""

    page: int = 1
    make: str = ""
    model: str = ""
    fuel: str = ""
    min_km: int | None = None
    max_km: int | None = None
    min_price_usd: float | None = None
    max_price_usd: float | None = None

    @classmethod
    def from_request(cls, args: Mapping[str, str]) -> SearchParams:
        """From query-string arguments, where every value is text."""
        def number(name, kind):
            return kind(args[name]) if args.get(name, "") != "" else None

        return cls(
            page=int(args.get("page", 1)),
            make=args.get("make", ""),
            model=args.get("model", ""),
            fuel=args.get("fuel", ""),
            min_km=number("min_km", int),
            max_km=number("max_km", int),
            min_price_usd=number("min_price_usd", float),
            max_price_usd=number("max_price_usd", float),
        )


def _bounded(rows: DataFrame, value: Column, low, high) -> DataFrame:
    if low is not None:
        rows = rows.where(value >= low)
    if high is not None:
        rows = rows.where(value <= high)
    return rows


def _with_computed(rows: DataFrame, **values: Column) -> DataFrame:
    """Adds columns that later filters read as plain columns.

    Each bound on a computed column would run the regular expressions again (see
    ``as_stored``). Only the new columns go through ``inline`` here, so filters on stored
    columns still move below it and run first.
    """
    packed = F.struct(*[value.alias(name) for name, value in values.items()])
    return rows.withColumn("_packed", packed).select("*", F.inline(F.array("_packed"))).drop("_packed")


def filter_title_like(items: DataFrame, wanted: str) -> DataFrame:
    """Make and model filters both look in the raw title."""
    return items.where(contains_like(F.col("l_text"), wanted)) if wanted else items


def filter_fuel_any(items: DataFrame, wanted: str) -> DataFrame:
    return items.where(L.fuel_matches(F.col("at_text"), wanted)) if wanted else items


def _numeric_filters(
    items: DataFrame, params: SearchParams, rates: Mapping[str, float]
) -> DataFrame:
    by_km = (params.min_km, params.max_km) != (None, None)
    by_price = (params.min_price_usd, params.max_price_usd) != (None, None)
    values = {}
    if by_km:
        values["_km"] = L.mileage_km(F.col("at_text"))
    if by_price:
        values["_usd"] = L.price_usd(F.col("p_text"), rates)
    if not values:
        return items
    rows = _with_computed(items, **values)
    rows = _bounded(rows, F.col("_km"), params.min_km, params.max_km)
    rows = _bounded(rows, F.col("_usd"), params.min_price_usd, params.max_price_usd)
    return rows.drop(*values)


def filter_km_range(items: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    return _numeric_filters(items, SearchParams(min_km=low, max_km=high), {})


def filter_price_usd_range(
    items: DataFrame,
    low: float | None = None,
    high: float | None = None,
    rates: Mapping[str, float] = K.DEFAULT_RATES,
) -> DataFrame:
    return _numeric_filters(items, SearchParams(min_price_usd=low, max_price_usd=high), rates)


def matching_items(
    items: DataFrame, params: SearchParams, rates: Mapping[str, float] = K.DEFAULT_RATES
) -> DataFrame:
    """Every item the filters keep: text tests first, then the parsed numbers."""
    rows = filter_title_like(items, params.make)
    rows = filter_title_like(rows, params.model)
    rows = filter_fuel_any(rows, params.fuel)
    return _numeric_filters(rows, params, rates)


def paginate(rows: DataFrame, page: int, size: int = K.PAGE_SIZE) -> DataFrame:
    """Page ``page`` in arrival order; rows without ``ingest_seq`` come first.

    Every task keeps the rows up to the end of the page, and where those are many Spark
    sorts by range instead. To walk through all results use ``page_after``, whose cost does
    not grow with depth.
    """
    start = max((page - 1) * size, 0)
    return rows.orderBy(F.col("ingest_seq").asc_nulls_first(), "id").offset(start).limit(size)


def page_after(
    rows: DataFrame, last_seq: int | None, last_id: str = "", size: int = K.PAGE_SIZE
) -> DataFrame:
    """The page after a given row: cost does not grow with depth, and the bound on
    ``ingest_seq`` reaches the parquet scan. Rows without ``ingest_seq`` come first: None
    goes on among them."""
    seq = F.col("ingest_seq")
    if last_seq is None:
        later = seq.isNotNull() | (F.col("id") > last_id)
    else:
        later = (seq >= last_seq) & ((seq > last_seq) | (F.col("id") > last_id))
    return rows.where(later).orderBy(seq.asc_nulls_first(), "id").limit(size)


def has_more(matched: Column, page: int, size: int = K.PAGE_SIZE) -> Column:
    """A full page announces another one, even if that one turns out empty."""
    start = max((page - 1) * size, 0)
    return F.least(matched - start, F.lit(size)) == size


def listing_view(items: DataFrame) -> DataFrame:
    """Items as the typed columns a result list shows."""
    title = L.parse_title(F.col("l_text"))
    place = F.col("at_text")
    return items.select(
        "id",
        F.col("image_src").alias("image"),
        L.price_value(F.col("p_text")).alias("price_raw"),
        L.price_currency(F.col("p_text")).alias("currency_original"),
        title["year"].alias("year"),
        title["make"].alias("make"),
        title["model"].alias("model"),
        title["spec"].alias("engine"),
        L.location(place).alias("location"),
        L.mileage_label(L.mileage_km(place)).alias("mileage"),
        L.fuel_label(place).alias("fuel"),
    )


def vehicle_search(
    items: DataFrame, params: SearchParams, rates: Mapping[str, float] = K.DEFAULT_RATES
) -> DataFrame:
    """Filters, one page, listing view: a single stage of built-in expressions."""
    return listing_view(paginate(matching_items(items, params, rates), params.page))


# ---------------------------------------------------------------- stored typed columns

def typed_items(items: DataFrame) -> DataFrame:
    """Items plus every parsed column, to be written once at ingestion."""
    title = L.parse_title(F.col("l_text"))
    place = F.col("at_text")
    return items.select(
        "*",
        L.price_value(F.col("p_text")).alias("price_value"),
        L.price_currency(F.col("p_text")).alias("currency"),
        L.mileage_km(place).alias("km"),
        title["year"].alias("year"),
        title["make"].alias("make"),
        title["model"].alias("model"),
        title["spec"].alias("spec"),
        L.location(place).alias("location"),
        L.fuel_label(place).alias("fuel"),
    )


def write_typed_items(items: DataFrame, path: str) -> None:
    """Store typed items in arrival order.

    Paging filters on ``ingest_seq``: each file holds a range of it, so ``page_after`` skips
    the files before its row. Makes are searched as parts of titles, which no order helps.
    """
    (
        typed_items(items)
        .repartitionByRange("ingest_seq", "id")
        .sortWithinPartitions("ingest_seq", "id")
        .write.mode("overwrite").parquet(path)
    )


def _native_bounds(params: SearchParams, rates: Mapping[str, float]) -> Column | None:
    """The dollar bounds as bounds on the stored price of each currency.

    Comparisons of stored columns with literals, so parquet can skip row groups. They are
    a hair wider than the exact test, which still runs.
    """
    if params.min_price_usd is None and params.max_price_usd is None:
        return None
    slack = 1e-9
    any_currency = None
    for code in (K.DEFAULT_CURRENCY, *(c for c, _ in K.CURRENCY_MARKS)):
        rate = 1.0 if code == K.DEFAULT_CURRENCY else rates.get(code)
        inside = F.col("currency") == code
        if rate is not None and params.min_price_usd is not None:
            bound = params.min_price_usd * rate
            inside = inside & (F.col("price_value") >= bound - abs(bound) * slack)
        if rate is not None and params.max_price_usd is not None:
            bound = params.max_price_usd * rate
            inside = inside & (F.col("price_value") <= bound + abs(bound) * slack)
        any_currency = inside if any_currency is None else any_currency | inside
    return any_currency


def matching_typed_items(
    stored: DataFrame, params: SearchParams, rates: Mapping[str, float] = K.DEFAULT_RATES
) -> DataFrame:
    rows = _bounded(stored, F.col("km"), params.min_km, params.max_km)
    native = _native_bounds(params, rates)
    if native is not None:
        rows = rows.where(native)
        usd = F.col("price_value") / L.rate_of(F.col("currency"), rates)
        rows = _bounded(rows, usd, params.min_price_usd, params.max_price_usd)
    rows = filter_title_like(rows, params.make)
    rows = filter_title_like(rows, params.model)
    return filter_fuel_any(rows, params.fuel)


def typed_listing_view(stored: DataFrame) -> DataFrame:
    return stored.select(
        "id",
        F.col("image_src").alias("image"),
        F.col("price_value").alias("price_raw"),
        F.col("currency").alias("currency_original"),
        "year",
        "make",
        "model",
        F.col("spec").alias("engine"),
        "location",
        L.mileage_label(F.col("km")).alias("mileage"),
        "fuel",
    )


def typed_vehicle_search(
    stored: DataFrame, params: SearchParams, rates: Mapping[str, float] = K.DEFAULT_RATES
) -> DataFrame:
    """``vehicle_search`` over stored typed columns: km and price bounds reach the scan."""
    return typed_listing_view(paginate(matching_typed_items(stored, params, rates), params.page))


# ---------------------------------------------------------------- rates

def rates_table(spark, rates: Mapping[str, float] = K.DEFAULT_RATES) -> DataFrame:
    """A rate map as rows (currency, per_usd), planned with its true tiny size."""
    pairs = [F.lit(x) for code, rate in rates.items() for x in (code, float(rate))]
    return spark.range(1).select(F.explode(F.create_map(*pairs)).alias("currency", "per_usd"))


def current_rates(history: DataFrame) -> DataFrame:
    """The newest rate per currency from rows (currency, per_usd, as_of): of rates of one day
    the greatest; a rate without a day counts only where its currency has no other."""
    newest = F.max(F.struct(F.col("as_of").isNotNull().alias("known"), "as_of", "per_usd")).alias("newest")
    return history.groupBy("currency").agg(newest).select("currency", "newest.per_usd", "newest.as_of")


def read_rates(rates: DataFrame) -> dict[str, float]:
    """Rates of the parsed currencies for use in expressions: four rows at most."""
    codes = [K.DEFAULT_CURRENCY, *(c for c, _ in K.CURRENCY_MARKS)]
    known = rates.where(F.col("currency").isin(codes)).groupBy("currency")
    rows = known.agg(F.max("per_usd").alias("per_usd")).collect()
    return {row["currency"]: row["per_usd"] for row in rows}


def rates_lookup(
    rows: DataFrame, rates: DataFrame, currency: str = "currency", name: str = "per_usd"
) -> DataFrame:
    """Left join to rates (one row per currency).

    No hint: Spark broadcasts the rates while their size is below its threshold, and
    otherwise joins by shuffle, where adaptive execution splits a hot currency.
    """
    side = rates.select(F.col("currency").alias("_code"), F.col("per_usd").alias(name))
    return rows.join(side, rows[currency] == side["_code"], "left").drop("_code")


def convert_currency(
    rows: DataFrame, rates: DataFrame, amount: str, source: str, target: str, name: str
) -> DataFrame:
    joined = rates_lookup(rows, rates, source, "_from")
    joined = rates_lookup(joined, rates, target, "_to")
    value = L.convert(F.col(amount), F.col("_from"), F.col("_to"))
    return joined.withColumn(name, value).drop("_from", "_to")


# ---------------------------------------------------------------- model-side filters

def junk_price_filter(cars: DataFrame, price: str = "price") -> DataFrame:
    return cars.where((F.col(price) > K.PRICE_FLOOR) & (F.col(price) < K.PRICE_CEILING))
