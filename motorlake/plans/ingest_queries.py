"""Registered queries: tables, keyed writes, resume lists, crawl ranges, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake import schemas
from motorlake.operators import ingest, unify
from motorlake.operators.features import clean_numeric
from motorlake.plans import adapters
from motorlake.plans.registry import query, with_tables
from motorlake.session import new_folder
from motorlake.sources import tables
from motorlake.streaming import landing

_SEQ = adapters.SEQ_COLUMNS


# ---------------------------------------------------------------- tables

@query(
    "scan_tables",
    with_tables(
        "items cars tags_raw",
        "select 'items' as source, l_text as key from items union all select 'cars', id from cars "
        "union all select 'tags', car_id from tags_raw",
    ),
)
def scan_tables(spark, sf):
    items = adapters.items(spark, sf).select(F.lit("items").alias("source"), F.col("l_text").alias("key"))
    cars = adapters.cars(spark, sf).select(F.lit("cars"), "id")
    tags = adapters.tags(spark, sf).select(F.lit("tags"), "car_id")
    return items.union(cars).union(tags)


_CELLS = (*K.NA_TOKENS, '17"', "a b", "none", "N/A ", "0")
_CELL_LIST = ", ".join("'" + c + "'" for c in _CELLS)


@query(
    "read_tsv",
    f"select cast(p_partkey as varchar) as id, p_name as name, case when p_partkey % {len(_CELLS)} < {len(K.NA_TOKENS)} "
    f"then null else [{_CELL_LIST}][p_partkey % {len(_CELLS)} + 1] end as cell from part",
)
def read_tsv(spark, sf):
    cells = F.array(*[F.lit(c) for c in _CELLS])
    rows = adapters.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.get(cells, (F.col("p_partkey") % len(_CELLS)).cast("int")).alias("cell"),
    )
    path = new_folder(spark, "cells-tsv")
    tables.write_tsv(rows, path)
    return tables.read_tsv(spark, path, schemas.all_strings(["id", "name", "cell"]))


_WIDE = """
  select cars.id, cars.brand, cars.price, cars.taxed, cars.year,
    max(case when attribute = 'Ձիաուժը' then value end) as horsepower,
    max(case when attribute = 'Վազքը' then value end) as mileage,
    max(case when attribute = 'Շարժիչը' then value end) as fuel,
    max(case when attribute = 'Վիճակը' then value end) as condition
  from cars left join firsts on firsts.car_id = cars.id
  group by cars.id, cars.brand, cars.price, cars.taxed, cars.year
"""
_SHORT = {"Ձիաուժը": "horsepower", "Վազքը": "mileage", "Շարժիչը": "fuel", "Վիճակը": "condition"}


@query("write_replace", with_tables("cars firsts", "select * from wide", wide=_WIDE))
def write_replace(spark, sf):
    path = new_folder(spark, "unified")
    tables.write_replace(adapters.cars(spark, sf).select("id"), path)
    tables.write_replace(adapters.unified(spark, sf), path)
    wide = tables.scan_table(spark, path).withColumnsRenamed(_SHORT)
    return wide.select("id", "brand", "price", "taxed", "year", *_SHORT.values())


@query("ensure_table", with_tables("items", "select id, image_src, p_text, l_text, at_text, ingest_seq from items"))
def ensure_table(spark, sf):
    path = new_folder(spark, "items-table")
    name = f"items_{uuid.uuid4().hex}"
    tables.ensure_table(spark, name, schemas.ITEMS, path)
    adapters.items(spark, sf).select(*schemas.ITEMS.names).write.insertInto(name)
    tables.ensure_table(spark, name, schemas.ITEMS, path)
    spark.sql(f"DROP TABLE {name}")
    return tables.scan_table(spark, path)


@query(
    "export_training_tsv",
    with_tables(
        "cars firsts",
        "select id, brand, cast(price as varchar) as price, cast(cast(taxed as int) as varchar) as taxed, "
        "cast(year as varchar) as year, horsepower, mileage, nullif(fuel, '') as fuel, condition from wide",
        wide=_WIDE,
    ),
)
def export_training_tsv(spark, sf):
    path = new_folder(spark, "combined-tsv")
    tables.export_training_tsv(adapters.unified(spark, sf), path)
    back = tables.read_tsv(spark, path, schemas.all_strings(unify.TRAINING_COLUMNS))
    wide = back.withColumnsRenamed(_SHORT)
    return wide.select("id", "brand", "price", "taxed", "year", *_SHORT.values())


@query(
    "cached_reference_data",
    "select distinct o_orderpriority as make, concat('M', o_custkey % 20) as model from orders",
)
def cached_reference_data(spark, sf):
    menu = adapters.cars(spark, sf).select(F.col("brand").alias("make"), "model").distinct()
    return tables.cached_reference_data(menu)


# ---------------------------------------------------------------- keyed writes

# Every line re-posts the listing of its order number, often several times.
_POSTED = """
  select cast(l_orderkey as varchar(20)) as id, 'N/A' as image_src,
    concat('$', cast(cast(floor(l_extendedprice) as bigint) as varchar(20))) as p_text,
    concat('2015 ', l_returnflag, ' ', l_linestatus) as l_text, 'N/A' as at_text, l_partkey as ingest_seq,
    {pos} as pos
  from {lineitem}
"""


_UPSERTED = with_tables(
    "items",
    "select id, l_text, p_text, ingest_seq from items where id not in (select id from newest) "
    "union all select id, l_text, p_text, ingest_seq from newest",
    newest="select * from (select *, row_number() over (partition by id order by pos desc) as rn from ("
    + _POSTED.format(pos=f"row({_SEQ})", lineitem="lineitem")
    + ") p) q where rn = 1",
)


def _posted(spark, sf):
    text = _POSTED.replace("{pos}", f"struct({_SEQ})")
    return spark.sql(text, lineitem=adapters.table(spark, sf, "lineitem"))


@query("upsert_latest_items", _UPSERTED)
def upsert_latest_items(spark, sf):
    done = ingest.upsert_latest_items(adapters.items(spark, sf), _posted(spark, sf), "pos")
    return done.select("id", "l_text", "p_text", "ingest_seq")


@query("upsert_in_place", _UPSERTED)
def upsert_in_place(spark, sf):
    path = new_folder(spark, "items-buckets")
    ingest.store_in_buckets(adapters.items(spark, sf), path, ["id"], 16)
    ingest.upsert_in_place(path, _posted(spark, sf), ["id"], "pos", 16)
    return ingest.bucket_table(spark, path).select("id", "l_text", "p_text", "ingest_seq")


@query(
    "upsert_latest_cars",
    with_tables(
        "cars",
        "select id, brand, price, strftime(scraped_at, '%Y-%m-%d') as day from cars "
        "where id not in (select id from batch) union all select id, brand, price, '2025-01-01' from batch",
        batch="select cast(l_orderkey as varchar) as id, 'B' as brand, l_extendedprice as price from "
        f"(select *, row_number() over (partition by l_orderkey order by row({_SEQ}) desc) as rn from lineitem) t where rn = 1",
    ),
)
def upsert_latest_cars(spark, sf):
    batch = adapters.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.lit("B").alias("brand"),
        F.lit(None).cast("string").alias("model"),
        F.col("l_extendedprice").alias("price"),
        F.lit("USD").alias("currency"),
        F.lit(False).alias("taxed"),
        F.lit(2000).alias("year"),
        F.lit("").alias("original_price_text"),
        F.expr(f"struct({_SEQ})").alias("pos"),
    )
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    done = ingest.upsert_latest_cars(adapters.cars(spark, sf), batch, "pos", now)
    return done.select("id", "brand", "price", F.date_format("scraped_at", "yyyy-MM-dd").alias("day"))


@query(
    "insert_ignore_tags",
    with_tables(
        "",
        "select car_id, attribute, value from old union all select car_id, attribute, value from fresh "
        "where (car_id, attribute) not in (select (car_id, attribute) from old)",
        raw=adapters.TAGS.format(seq=f"row({_SEQ})", lineitem="(select * from lineitem)")
        .replace("as value,", "as value, l_discount,"),
        old="select car_id, attribute, value from (select *, row_number() over (partition by car_id, attribute "
        "order by seq) as rn from raw where l_discount < 0.05) t where rn = 1",
        fresh="select car_id, attribute, value from (select *, row_number() over (partition by car_id, attribute "
        "order by seq) as rn from raw where l_discount >= 0.05) t where rn = 1",
    ),
)
def insert_ignore_tags(spark, sf):
    lines = adapters.table(spark, sf, "lineitem")
    old = adapters.tags_of(lines.where("l_discount < 0.05"))
    target = ingest.first_wins(old, ["car_id", "attribute"], F.col("seq"))
    batch = adapters.tags_of(lines.where("l_discount >= 0.05"))
    return ingest.insert_ignore_tags(target, batch).select("car_id", "attribute", "value")


@query("default_timestamp", "select cast(o_orderkey as varchar) as id, true as stamped from orders")
def default_timestamp(spark, sf):
    stamped = ingest.default_timestamp(adapters.cars(spark, sf).drop("scraped_at"))
    recent = F.col("scraped_at") >= F.lit("2020-01-01").cast("timestamp")
    return stamped.select("id", recent.alias("stamped"))


_PENDING = "select id from cars where id not in (select car_id from tags_raw)"


@query("pending_ids", with_tables("cars tags_raw", _PENDING))
def pending_ids(spark, sf):
    return ingest.pending_ids(adapters.cars(spark, sf), adapters.tags(spark, sf))


@query(
    "pending_counts",
    with_tables(
        "cars tags_raw",
        "select (select count(distinct id) from cars) as total, (select count(distinct car_id) from tags_raw) as done, "
        f"(select count(*) from ({_PENDING}) p) as pending",
    ),
)
def pending_counts(spark, sf):
    return ingest.pending_counts(adapters.cars(spark, sf), adapters.tags(spark, sf))


@query("set_difference_ids", with_tables("cars tags_raw", "select id from cars except select car_id from tags_raw"))
def set_difference_ids(spark, sf):
    return ingest.set_difference_ids(
        adapters.cars(spark, sf).select("id"), adapters.tags(spark, sf).select("car_id")
    )


@query("distinct_car_ids", with_tables("tags_raw", "select distinct car_id from tags_raw"))
def distinct_car_ids(spark, sf):
    return ingest.distinct_car_ids(adapters.tags(spark, sf))


@query(
    "union_batches",
    with_tables(
        "cars",
        "select id, price from cars where price <= 20000 union all select id, price from cars where price >= 20000 "
        "union all select id, price from cars where price < 5000",
    ),
)
def union_batches(spark, sf):
    cars = adapters.cars(spark, sf).select("id", "price")
    parts = [cars.where("price <= 20000"), cars.where("price >= 20000"), cars.where("price < 5000")]
    return ingest.union_batches(*parts)


_DIRTY = """
  select case when o_orderkey % 97 = 0 then null else cast(o_orderkey as varchar(20)) end as id,
    case o_orderkey % 6 when 0 then '12,500' when 1 then concat(' ', cast(cast(o_totalprice as decimal(18,2)) as varchar(30)), ' ')
      when 2 then '' else cast(cast(o_totalprice as decimal(18,2)) as varchar(30)) end as price,
    case o_orderkey % 5 when 0 then '2015 թ.' when 1 then concat({newline}, '2015', {newline}) else '1999' end as year
  from {orders}
"""
_BAD_PRICE = "o_orderkey % 6 in (0, 2)"


@query(
    "quarantine_bad_rows",
    "select case when o_orderkey % 97 = 0 then null else cast(o_orderkey as varchar) end as id, "
    f"case when {_BAD_PRICE} then cast(-1 as double) else o_totalprice end as price, "
    "case o_orderkey % 5 when 0 then -1 when 1 then 2015 else 1999 end as year, "
    f"case when o_orderkey % 97 = 0 then 'id' when {_BAD_PRICE} then 'price' when o_orderkey % 5 = 0 then 'year' "
    "else 'good' end as status from orders",
)
def quarantine_bad_rows(spark, sf):
    text = _DIRTY.replace("{newline}", "char(10)")
    good, bad = ingest.quarantine_bad_rows(spark.sql(text, orders=adapters.table(spark, sf, "orders")))
    both = good.withColumn("status", F.lit("good")).unionByName(
        bad.drop("price_raw", "year_raw").withColumnRenamed("error", "status")
    )
    return both.select(
        "id",
        F.coalesce("price", F.lit(-1.0)).alias("price"),
        F.coalesce("year", F.lit(-1)).alias("year"),
        "status",
    )


# ---------------------------------------------------------------- crawl ranges

_RUN = """
  select case when o_totalprice <= 20000 then 1 else 2 end as range_id,
    cast(floor(o_orderkey / 50.0) as bigint) + 1 as page,
    case when o_orderstatus = 'F' then 1 else 0 end as n_rows
  from {orders}
"""
_PER_PAGE = "select range_id, page, cast(sum(n_rows) as bigint) as n_rows from run group by range_id, page"


def _run(spark, sf):
    return spark.sql(_RUN, orders=adapters.table(spark, sf, "orders"))


@query(
    "range_run_summary",
    with_tables(
        "",
        "select range_id, count(*) as pages, cast(sum(n_rows) as bigint) as total_rows, "
        "count(*) filter (where n_rows = 0) as empty_pages from per_page group by range_id",
        run=_RUN.format(orders="orders"),
        per_page=_PER_PAGE,
    ),
)
def range_run_summary(spark, sf):
    return ingest.range_run_summary(_run(spark, sf))


@query(
    "range_page_totals",
    with_tables(
        "",
        "select range_id, page, n_rows, cast(sum(n_rows) over (partition by range_id order by page) as bigint) "
        "as running_rows from per_page",
        run=_RUN.format(orders="orders"),
        per_page=_PER_PAGE,
    ),
)
def range_page_totals(spark, sf):
    return ingest.range_page_totals(_run(spark, sf))


_FRONTIER = (
    "select lo as range_lo, hi as range_hi, cast(unnest(generate_series(1, cast(ceil(n / 50.0) as bigint))) as bigint) as page "
    "from (select lo, hi, count(*) as n from cars join (values (cast(1 as double), cast(20000 as double)), "
    "(cast(20000 as double), cast(50000000 as double))) r(lo, hi) on price between lo and hi group by lo, hi) c"
)


def _frontier(spark, sf):
    assigned = ingest.price_range_assign(adapters.cars(spark, sf).select("price"))
    sizes = assigned.groupBy(F.col("lo").alias("range_lo"), F.col("hi").alias("range_hi")).agg(
        F.ceil(F.count("*") / K.CARS_PER_SEARCH_PAGE).alias("pages")
    )
    return ingest.crawl_frontier(sizes)


@query(
    "crawl_frontier",
    with_tables(
        "cars",
        "select *, case when page = 1 then 'https://cars.example/all' else concat('https://cars.example/all/', page) end "
        f"as url from ({_FRONTIER}) f",
    ),
)
def crawl_frontier(spark, sf):
    return _frontier(spark, sf).withColumn("url", ingest.category_url("https://cars.example/all", F.col("page")))


_LANDED = """
  select case when o_totalprice <= 20000 then cast(1 as double) else cast(20000 as double) end as range_lo,
    cast(floor(o_orderkey / 50.0) as bigint) + 1 as page
  from {orders} where o_orderstatus = 'F'
"""


@query(
    "frontier_pending",
    with_tables(
        "cars",
        "select * from frontier where not exists (select 1 from landed where landed.range_lo = frontier.range_lo "
        "and landed.page = frontier.page)",
        frontier=_FRONTIER,
        landed=_LANDED.format(orders="orders"),
    ),
)
def frontier_pending(spark, sf):
    landed = spark.sql(_LANDED, orders=adapters.table(spark, sf, "orders"))
    pending = ingest.frontier_pending(_frontier(spark, sf), landed, ["range_lo", "page"])
    return pending.select("range_lo", "range_hi", "page")


@query(
    "price_range_assign",
    "select cast(o_orderkey as varchar) as id, floor(o_totalprice / 10000) * 10000 as price, lo, hi from orders "
    "join (values (cast(1 as double), cast(20000 as double)), (cast(20000 as double), cast(50000000 as double))) r(lo, hi) "
    "on floor(o_totalprice / 10000) * 10000 between lo and hi",
)
def price_range_assign(spark, sf):
    tens = (F.floor(F.col("price") / 10000) * 10000).cast("double")
    cars = adapters.cars(spark, sf).select("id", tens.alias("price"))
    return ingest.price_range_assign(cars)


@query(
    "search_request_filter",
    with_tables(
        "cars firsts",
        "select cars.id, price, year, try_cast(regexp_replace(value, '[^0-9.]+', '', 'g') as double) as mileage "
        "from cars join firsts on car_id = cars.id and attribute = 'Վազքը' "
        "where price between 20000 and 50000000 and year between 1911 and 2027 "
        "and try_cast(regexp_replace(value, '[^0-9.]+', '', 'g') as double) between 0 and 1000000",
    ),
)
def search_request_filter(spark, sf):
    wide = unify.unify(adapters.cars(spark, sf), adapters.tags(spark, sf), ["Վազքը"])
    cars = wide.withColumn("mileage", clean_numeric(F.col("Վազքը")))
    return ingest.search_request_filter(cars, K.PRICE_RANGES[1]).select("id", "price", "year", "mileage")


# ---------------------------------------------------------------- streams

def _stream(spark, sf, name):
    # As a pattern the path may be one file or a folder of files; plain, only a folder.
    schema = adapters.table(spark, sf, name).schema
    return landing.read_landing(spark, f"{sf}/{name}.parque[t]", schema)


_STREAMED = with_tables(
    "items",
    "select id, case when ingest_seq % 13 = 0 then 'N/A' when ingest_seq % 4 = 0 then '$7,777' else p_text end "
    "as p_text, l_text, at_text from items",
)


# Micro-batches of a landing, and pages a landed file should hold at most.
BATCHES, FILE_PAGES = 3, 100_000


def _landed(spark, rows, pages_of):
    """Pages made of stored rows and landed in files of their own, read as a stream of a few
    micro-batches. More rows are more files a micro-batch, each written by a task of its own."""
    a_batch = max(1, -(-rows.count() // (BATCHES * FILE_PAGES)))
    folder = new_folder(spark, "landing")
    pages_of(rows.repartition(BATCHES * a_batch)).write.parquet(folder)
    return landing.read_landing(spark, folder, spark.read.parquet(folder).schema, a_batch)


@query("stream_extract_upsert", _STREAMED)
def stream_extract_upsert(spark, sf):
    pages = adapters.category_pages(adapters.items_of(_stream(spark, sf, "part")))
    folder = new_folder(spark, "card-stream")
    landing.stream_extract_upsert(pages, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return landing.upserted_cards(spark, f"{folder}/log").drop("image_src")


@query("compact_card_log", _STREAMED)
def compact_card_log(spark, sf):
    """A log is compacted between its first and its second stream."""
    part = adapters.table(spark, sf, "part")
    folder = new_folder(spark, "compacted")

    def listed(rows):
        return adapters.category_pages(adapters.items_of(rows))

    def older(rows):
        return adapters.category_pages(adapters.items_of(rows).withColumn("l_text", F.lit("old")))

    landing.stream_extract_upsert(_landed(spark, part, older), f"{folder}/a", f"{folder}/a-check").awaitTermination()
    landing.compact_log(spark, f"{folder}/a", f"{folder}/b")
    newer = _landed(spark, part, listed)
    landing.stream_extract_upsert(newer, f"{folder}/b", f"{folder}/b-check").awaitTermination()
    landing.compact_log(spark, f"{folder}/b", f"{folder}/c")
    return landing.upserted_cards(spark, f"{folder}/c").drop("image_src")


@query(
    "stream_offer_upsert",
    with_tables("cars", "select id, brand, model, price, taxed, year from cars"),
)
def stream_offer_upsert(spark, sf):
    orders = adapters.table(spark, sf, "orders")
    pages = _landed(spark, orders, lambda rows: adapters.offer_pages(adapters.cars_of(rows)))
    folder = new_folder(spark, "offer-stream")
    landing.stream_offer_upsert(
        pages, f"{folder}/log", f"{folder}/bad", f"{folder}/checkpoint"
    ).awaitTermination()
    return landing.upserted_cars(spark, f"{folder}/log").select("id", "brand", "model", "price", "taxed", "year")


@query(
    "stream_detail_tags",
    with_tables(
        "cars",
        "select id as car_id, attribute, case attribute when 'Brand' then brand else cast(year as varchar) end as value "
        "from cars cross join (values ('Brand'), ('Year')) v(attribute) "
        "where cast(id as bigint) % 9 <> 0 and cast(id as bigint) % 10 <> 0 and cast(id as bigint) % 11 <> 0",
    ),
)
def stream_detail_tags(spark, sf):
    orders = adapters.table(spark, sf, "orders")
    pages = _landed(spark, orders, lambda rows: adapters.detail_pages(adapters.cars_of(rows)).drop("status"))
    folder = new_folder(spark, "detail-stream")
    stream = landing.stream_detail_tags(pages, f"{folder}/a", f"{folder}/checkpoint")
    stream.awaitTermination()
    landing.compact_tag_log(spark, f"{folder}/a", f"{folder}/b")
    return landing.first_tags(spark, f"{folder}/b")


@query("stream_first_wins", with_tables("tags", "select car_id, attribute, value from tags"))
def stream_first_wins(spark, sf):
    tags = adapters.tags_of(_stream(spark, sf, "lineitem"))
    folder = new_folder(spark, "tag-stream")
    landing.stream_first_wins(tags, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return landing.first_tags(spark, f"{folder}/log")


@query(
    "stream_progress",
    "select case when o_totalprice <= 20000 then 1 else 2 end as range_id, o_orderstatus as outcome, "
    "count(*) as n from orders group by 1, 2",
)
def stream_progress(spark, sf):
    pages = _stream(spark, sf, "orders").select(
        F.when(F.col("o_totalprice") <= 20000, 1).otherwise(2).alias("range_id"),
        F.col("o_orderstatus").alias("outcome"),
    )
    folder = new_folder(spark, "progress-stream")
    landing.stream_progress(
        pages, ["range_id", "outcome"], f"{folder}/counts", f"{folder}/checkpoint"
    ).awaitTermination()
    return landing.progress_counts(spark, f"{folder}/counts")


@query(
    "stream_progress_changes",
    "select case when o_totalprice <= 20000 then 1 else 2 end as range_id, o_orderstatus as outcome, "
    "count(*) as n from orders group by 1, 2",
)
def stream_progress_changes(spark, sf):
    """The totals of ``stream_progress``, from a log of what each micro-batch changed."""
    pages = _stream(spark, sf, "orders").select(
        F.when(F.col("o_totalprice") <= 20000, 1).otherwise(2).alias("range_id"),
        F.col("o_orderstatus").alias("outcome"),
    )
    folder, keys = new_folder(spark, "progress-stream"), ["range_id", "outcome"]
    landing.stream_progress_changes(pages, keys, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return landing.progress_totals(spark, f"{folder}/log", keys)


@query("stream_fresh_tags", with_tables("tags", "select car_id, attribute, value from tags"))
def stream_fresh_tags(spark, sf):
    """The tags landed twice in a row, and the stream restarted from its checkpoint between."""
    folder = new_folder(spark, "fresh-tags")
    tags = adapters.tags(spark, sf)
    for _ in range(2):
        tags.write.mode("append").parquet(f"{folder}/landed")
        stream = landing.read_landing(spark, f"{folder}/landed", tags.schema)
        landing.stream_fresh_tags(stream, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return landing.first_tags(spark, f"{folder}/log")
