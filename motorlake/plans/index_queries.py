"""Registered queries: title index, page directory, facets kept by change, ordered statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake import constants as K
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
from motorlake.plans import adapters, model_queries, search_queries
from motorlake.plans.registry import query, with_tables
from motorlake.session import new_folder
from motorlake.sources import tables

_RAW = "id, p_text, l_text, at_text"


# ---------------------------------------------------------------- title index

def _found(spark, sf, wanted):
    path = new_folder(spark, "title-index")
    title_index.build(adapters.items(spark, sf), path)
    return title_index.find(spark, path, wanted).select("id", "p_text", "l_text", "at_text")


def _titles(pattern: str) -> str:
    return with_tables("items", f"select {_RAW} from items where l_text ilike '{pattern}'")


@query("title_index_make", _titles("%BRAND#1%"))
def title_index_make(spark, sf):
    return _found(spark, sf, "BRAND#1")


@query("title_index_wildcards", _titles("%20_5 brand%, st%"))
def title_index_wildcards(spark, sf):
    return _found(spark, sf, "20_5 bRAND%, ST")


@query("title_index_short", _titles("%r_d %g, e%"))
def title_index_short(spark, sf):
    """No three literal characters in a row: the index is passed by."""
    return _found(spark, sf, "R_d %g, e")


@query(
    "title_index_postings",
    with_tables(
        "items",
        "select gram, count(*) as n, cast(sum(ingest_seq) as bigint) as seqs from (select distinct ingest_seq, "
        "unnest(list_transform(range(1, greatest(length(l_text) - 1, 1)), lambda i: substr(lower(l_text), i, 3))) as gram "
        "from items) group by gram",
    ),
)
def title_index_postings(spark, sf):
    """Every trigram with its rows, read back from the stored lists."""
    path = new_folder(spark, "title-index")
    title_index.build(adapters.items(spark, sf), path)
    lists = spark.read.parquet(f"{path}/lists").select("gram", "page_part", F.explode("places").alias("place"))
    rows = positions.stored(spark, path).select("page_part", "place", "ingest_seq")
    return lists.join(rows, ["page_part", "place"]).groupBy("gram").agg(
        F.count("*").alias("n"), F.sum("ingest_seq").alias("seqs")
    )


# ---------------------------------------------------------------- page directory

def _pages(spark, rows):
    path = new_folder(spark, "pages")
    positions.store_in_order(rows, path, [F.col("ingest_seq").asc_nulls_first(), F.col("id")])
    return path


@query(
    "page_directory",
    with_tables("items", f"select {_RAW}, row_number() over (order by ingest_seq nulls first, id) - 1 as position from items"),
)
def page_directory(spark, sf):
    """Every item with its position."""
    path = _pages(spark, adapters.items(spark, sf))
    return positions.with_positions(spark, path).select("id", "p_text", "l_text", "at_text", "position")


@query(
    "page_directory_deep",
    with_tables(
        "items",
        f"select {_RAW}, position from (select *, row_number() over (order by ingest_seq nulls first, id) - 1 as position, "
        "count(*) over () as n from items) where position >= n // 2 and position < n // 2 + 24",
    ),
)
def page_directory_deep(spark, sf):
    """The page that begins in the middle of the table."""
    path = _pages(spark, adapters.items(spark, sf))
    middle = positions.total(spark, path) // 2
    return positions.slice_of(spark, path, middle, K.PAGE_SIZE).select("id", "p_text", "l_text", "at_text", "position")


@query(
    "vehicle_search_pages",
    with_tables(
        "parsed",
        f"select position // {K.PAGE_SIZE} + 1 as page, {search_queries._VIEW} from (select *, "
        f"row_number() over (order by ingest_seq nulls first, id) - 1 as position from parsed where {search_queries._MATCH})",
    ),
)
def vehicle_search_pages(spark, sf):
    """All pages of a search: its matches are stored once, and a page is a slice of them."""
    path = _pages(spark, search.matching_items(adapters.items(spark, sf), search_queries.SEARCH))
    rows = positions.with_positions(spark, path)
    page = rows.select("id", (F.floor(F.col("position") / K.PAGE_SIZE) + 1).alias("page"))
    return search.listing_view(rows).join(page, "id")


# ---------------------------------------------------------------- facets kept by change

# Batch k gives every (k + 4)th item another title, drops none, and adds items.
_CHANGED = "\nunion all\n".join(
    f"""select id, image_src, p_text, concat('201{k} Swap', cast(ingest_seq % 3 as varchar(20)), ' M',
      cast(ingest_seq % 5 as varchar(20)), ' x, new') as l_text, at_text, ingest_seq, {k} as batch
    from items where ingest_seq % {k + 4} = 0
    union all
    select concat('n{k}-', id), image_src, p_text, l_text, at_text, ingest_seq, {k} from items where ingest_seq % 11 = {k}"""
    for k in (1, 2, 3)
)


@query(
    "facet_view",
    with_tables(
        "items",
        "select make, model, count(*) as n from (select case when len(w) >= 2 then w[2] else 'Other' end as make, "
        "case when len(w) >= 2 then array_to_string(w[3:], ' ') else l_text end as model from "
        "(select l_text, string_split(trim(split_part(l_text, ',', 1)), ' ') as w from newest)) group by make, model",
        changed=_CHANGED,
        newest="select * from (select *, row_number() over (partition by id order by batch desc) as rn from "
        "(select *, 0 as batch from items union all select * from changed)) where rn = 1",
    ),
)
def facet_view(spark, sf):
    """Counts after three batches that replace and add items, from the log of changes."""
    items = tables.materialise(adapters.items(spark, sf), new_folder(spark, "items"))
    root = new_folder(spark, "facet-view")
    facet_views.start(items, root)
    changed = spark.sql(_CHANGED.join(["select * from (", ")"]).replace("from items", "from {items}"), items=items)
    for number in (1, 2, 3):
        facet_views.apply_batch(changed.where(F.col("batch") == number).drop("batch"), root, number)
    return facet_views.counts(spark, root)


_PART = 7


@query(
    "facet_tree_parts",
    with_tables(
        "parsed",
        "select make as name, cast(total as bigint) as \"count\", part, "
        "string_agg(concat(model, '=', n), ';' order by k) as models from "
        f"(select *, (k - 1) // {_PART} as part from (select make, model, count(*) as n, "
        "sum(count(*)) over (partition by make) as total, row_number() over (partition by make order by model) as k "
        "from parsed group by make, model)) group by make, total, part",
    ),
)
def facet_tree_parts(spark, sf):
    tree = facet_views.tree_in_parts(facets.make_model_counts(adapters.items(spark, sf)), _PART)
    shown = F.array_join(F.transform("models", lambda m: F.concat(m["name"], F.lit("="), m["count"])), ";")
    return tree.select("name", "count", "part", shown.alias("models"))


# ---------------------------------------------------------------- ordered statistics

_ORDERED = " union all ".join(
    f"""select id, '{c}' as feature, "{c}" as category, count("Log_Price") over w as seen,
      round((coalesce(sum("Log_Price") over w, 0) + {ordered_stats.SMOOTHING} * prior)
        / (count("Log_Price") over w + {ordered_stats.SMOOTHING}), 4) as encoded
    from train cross join (select avg("Log_Price") as prior from train) p
    window w as (partition by "{c}" order by md5(id), id rows between unbounded preceding and 1 preceding)"""
    for c in K.CATEGORICALS
)


@query("ordered_statistics", model_queries._sql(_ORDERED, "train"))
def ordered_statistics(spark, sf):
    train, _ = model_queries._stored_training_set(spark, sf)
    rows = ordered_stats.ordered_statistics(train, blocks=16)
    return rows.withColumn("encoded", F.round("encoded", 4))


# ---------------------------------------------------------------- ranges, ledger, objects

_RANGES = """
  select p_partkey as range_id, cast(p_partkey * 150 as double) as lo, cast(p_partkey * 150 + p_size * 20 as double) as hi
  from part
"""


@query(
    "price_range_join",
    with_tables("cars", "select id, price, range_id, lo, hi from cars join ranges on price between lo and hi", ranges=_RANGES),
)
def price_range_join(spark, sf):
    """Cars and as many ranges as there are parts."""
    wanted = spark.sql(_RANGES.replace("from part", "from {part}"), part=adapters.table(spark, sf, "part"))
    return ranges.range_join(adapters.cars(spark, sf).select("id", "price"), wanted, "price")


@query(
    "resume_ledger",
    with_tables(
        "cars tags_raw",
        "select (select count(distinct id) from cars) as total, (select count(distinct car_id) from tags_raw) as done, "
        "(select count(*) from (select id from cars except select car_id from tags_raw) p) as pending",
    ),
)
def resume_ledger_counts(spark, sf):
    """``pending_counts`` from bitmaps, the tags noted in four batches that overlap."""
    path = new_folder(spark, "ledger")
    resume_ledger.add(path, "cars", 1, adapters.cars(spark, sf), "id")
    tags = adapters.tags(spark, sf)
    for batch in range(4):
        some = tags.where(F.pmod(F.xxhash64("car_id", "attribute"), F.lit(5)).isin(batch, batch + 1))
        resume_ledger.add(path, "tags", batch, some, "car_id")
    return resume_ledger.pending_counts(spark, path)


@query("pivot_variant", model_queries._sql(f"select car_id, {model_queries._names()} from pivoted", "pivoted"))
def pivot_variant(spark, sf):
    """The wide table read out of one VARIANT a car."""
    objects = unify.tag_objects(adapters.tags(spark, sf))
    return objects.select(
        "car_id", *[unify.tag_value(source).alias(name) for name, source in model_queries._ATTRIBUTES.items()]
    )


# ---------------------------------------------------------------- the trainer's own curve

@query("fitted_curve")
def fitted_curve(spark, sf):
    """Validation error after each round of a fit of its own; SQL cannot grow trees."""
    train, _ = model_queries._stored_training_set(spark, sf)
    path = new_folder(spark, "validated-model")
    validated_model.train_validated(train, path)
    return validated_model.fitted_curve(train, path)
