"""Registered queries: extraction from HTML made of the given rows, and from given pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.functions import listing as L
from motorlake.operators import extract, ingest
from motorlake.plans import adapters, listings
from motorlake.plans.registry import query, with_tables
from motorlake.sources.tables import spread_scan

_IMAGE = (
    "case ingest_seq % 3 when 0 then concat('https://img.example/', id, '.jpg') "
    "when 1 then concat('/s/', id, '.png') else 'N/A' end"
)
_CARD_PRICE = "case when ingest_seq % 13 = 0 then 'N/A' else {price} end"
_CARDS = (
    f"select ingest_seq as page_id, 0 as pos, id, {_IMAGE} as image_src, "
    f"{_CARD_PRICE.format(price='p_text')} as p_text, l_text, at_text from items union all "
    f"select ingest_seq, pos, id, {_IMAGE}, {_CARD_PRICE.format(price=chr(39) + '$7,777' + chr(39))}, l_text, at_text "
    "from items cross join (values (3), (4)) v(pos) where ingest_seq % 4 = 0"
)


def _category_pages(spark, sf):
    part = spread_scan(adapters.table(spark, sf, "part"))
    return adapters.category_pages(adapters.items_of(part))


def _cars(spark, sf):
    return adapters.cars_of(spread_scan(adapters.table(spark, sf, "orders")))


@query("extract_gl_cards", with_tables("items", _CARDS))
def extract_gl_cards(spark, sf):
    return extract.extract_gl_cards(_category_pages(spark, sf))


@query(
    "extract_card_texts",
    with_tables(
        "items",
        "select page_id, pos, p_text, l_text, at_text from cards union all "
        "select ingest_seq, pos, 'N/A', 'N/A', 'N/A' from items cross join (values (1), (2)) v(pos)",
        cards=_CARDS,
    ),
)
def extract_card_texts(spark, sf):
    links = extract.container_links(_category_pages(spark, sf))
    return links.select("page_id", "pos", "p_text", "l_text", "at_text")


@query(
    "items_from_pages",
    with_tables(
        "items",
        f"select id, {_IMAGE} as image_src, case when ingest_seq % 13 = 0 then 'N/A' "
        "when ingest_seq % 4 = 0 then '$7,777' else p_text end as p_text, l_text, at_text from items",
    ),
)
def items_from_pages(spark, sf):
    return listings.items_from_pages(_category_pages(spark, sf)).drop("ingest_seq")




@query(
    "extract_item_id",
    "select cast(p_partkey as varchar(20)) as k, case p_partkey % 5 when 4 then '' else "
    "cast(p_partkey as varchar(20)) end as id from part where p_partkey % 5 <> 2",
)
def extract_item_id(spark, sf):
    k, kind = F.col("p_partkey").cast("string"), F.col("p_partkey") % 5
    href = (
        F.when(kind == 0, F.concat(F.lit("/en/item/"), k, F.lit("?ld_src=2")))
        .when(kind == 1, F.concat(F.lit("/item/"), k))
        .when(kind == 2, F.concat(F.lit("/category/"), k))
        .when(kind == 3, F.concat(F.lit("https://h/en/item/"), k, F.lit("/item/8")))
        .otherwise(F.concat(F.lit("/item/?x="), k))
    )
    part = adapters.table(spark, sf, "part")
    ids = part.select(k.alias("k"), L.item_id(href).alias("id"))
    return ids.where("id IS NOT NULL")


@query(
    "resolve_image_url",
    "select cast(p_partkey as varchar(20)) as k, case p_partkey % 4 "
    "when 0 then concat('https://a/', p_partkey, '.jpg') when 1 then concat('x', p_partkey, '.png') "
    "when 2 then 'N/A' else concat('https://b/', p_partkey) end as image_src from part",
)
def resolve_image_url(spark, sf):
    k, kind = F.col("p_partkey").cast("string"), F.col("p_partkey") % 4
    data = F.when(kind == 0, F.concat(F.lit("//a/"), k, F.lit(".jpg"))).when(kind == 1, F.lit(""))
    src = F.when(kind == 1, F.concat(F.lit("x"), k, F.lit(".png"))).when(
        kind == 3, F.concat(F.lit("https://b/"), k)
    )
    part = adapters.table(spark, sf, "part")
    return part.select(k.alias("k"), L.image_url(data, src).alias("image_src"))


@query(
    "extract_page_links",
    r"""select page_id, cast(pos - 1 as int) as pos, hrefs[pos] as href from (
      select page_id, hrefs, unnest(generate_series(1, len(hrefs))) as pos from (
        select page_id, regexp_extract_all(array_to_string(regexp_extract_all(html, '(?s)<nav>(.*?)</nav>', 1), ' '),
          '<a\b[^>]*?\bhref="([^"]*)"', 1) as hrefs from pages) a) b""",
)
def extract_page_links(spark, sf):
    return extract.flat_links(adapters.table(spark, sf, "pages"), "<nav>", "</nav>")


# ---------------------------------------------------------------- search and detail pages

_OFFERS = """
  select o_orderkey as page_id, 0 as pos, id, brand, model, cast(cast(price as decimal(18,2)) as varchar) as price,
    case when o_orderkey % 7 = 0 then '?' else 'USD' end as currency,
    cast(taxed as varchar) as taxed, concat(chr(10), year, chr(10)) as year,
    case when o_orderkey % 7 = 0 then '' else original_price_text end as original_price_text,
    cast(null as varchar) as error
  from cars join orders on id = cast(o_orderkey as varchar)
  union all
  select o_orderkey, 2, id, brand, model, cast(cast(price as decimal(18,2)) as varchar), '?', null, null, '',
    'no card-loc and grey-text'
  from cars join orders on id = cast(o_orderkey as varchar) where o_orderkey % 5 = 0
"""


@query("extract_offer_cards", with_tables("cars", _OFFERS))
def extract_offer_cards(spark, sf):
    cards = extract.extract_offer_cards(adapters.offer_pages(_cars(spark, sf)))
    return cards.withColumn("taxed", F.col("taxed").cast("string"))


@query(
    "price_text_currency",
    "select o_orderkey as page_id, case when o_orderkey % 7 = 0 then '?' else 'USD' end as currency, "
    "case when o_orderkey % 7 = 0 then '' else concat('USD ', cast(floor(o_totalprice) as bigint)) end "
    "as original_price_text from orders",
)
def price_text_currency(spark, sf):
    cards = extract.extract_offer_cards(adapters.offer_pages(_cars(spark, sf)))
    return cards.where("error IS NULL").select("page_id", "currency", "original_price_text")


@query(
    "extract_detail_tags",
    with_tables(
        "cars",
        "select id as car_id, pos, attribute, case pos when 0 then brand when 1 then cast(year as varchar) "
        "else 'later' end as value from cars cross join (values (0, 'Brand'), (1, 'Year'), (2, 'Brand')) v(pos, attribute) "
        "where cast(id as bigint) % 9 <> 0 and cast(id as bigint) % 10 <> 0 and cast(id as bigint) % 11 <> 0",
    ),
)
def extract_detail_tags(spark, sf):
    return extract.extract_detail_tags(adapters.detail_pages(_cars(spark, sf)))


@query(
    "strip_hidden_nodes",
    "select cast(o_orderkey as varchar(20)) as id, concat('<td>', o_orderpriority, '<b style=\"color:red\">', "
    "o_orderstatus, '</b> end</td>') as html from orders",
)
def strip_hidden_nodes(spark, sf):
    html = F.concat(
        F.lit("<td>"), F.col("o_orderpriority"),
        F.lit("<div style='display:none'>a<br><div>b<p>c</p></div>d</div><img style=\"display:none\">"),
        F.lit('<span class="j" style="display: none;">{"k":'),
        F.col("o_custkey").cast("string"), F.lit('}</span><b style="color:red">'), F.col("o_orderstatus"),
        F.lit('</b><i style="pointer-events:none">'), F.col("o_totalprice").cast("string"), F.lit("</i> end</td>"),
    )
    return adapters.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), extract.strip_hidden_nodes(html).alias("html")
    )


_STATUS_PAGES = """
  select page_id, case when page_id % 9 = 0 then replace(html, '<title>', '<title>Just a moment... ')
    when page_id % 7 = 0 then replace(html, 'class="ad"', 'class="x"') else html end as html
  from {pages}
"""
_CLASSIFIED = f"""
  select page_id, title, containers, case when contains(title, 'Just a moment') or contains(title, 'Security')
    then 'challenge' when containers = 0 then 'soft_block' else 'ok' end as status
  from (select page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) as title,
    cast((length(html) - length(replace(html, '<div class="ad"', ''))) / 15 as int) as containers
    from ({_STATUS_PAGES.format(pages="pages")}) p) q
"""


def _classified(spark, sf):
    pages = spark.sql(_STATUS_PAGES, pages=adapters.table(spark, sf, "pages"))
    # Markup inside scripts and comments is no markup.
    dead = '<script>var a=\'<div class="ad">\';</script><!-- <div class="ad"> -->'
    pages = pages.withColumn("html", F.concat("html", F.lit(dead)))
    return extract.classify_pages(pages, "ad")


@query("classify_pages", _CLASSIFIED)
def classify_pages(spark, sf):
    return _classified(spark, sf)


@query("page_status_counts", f"select status, count(*) as n from ({_CLASSIFIED}) group by status")
def page_status_counts(spark, sf):
    return _classified(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "outcome_summary",
    "select case when o_orderkey % 23 = 0 then 'gone' when o_orderkey % 29 = 0 then 'retry' "
    "when o_orderkey % 10 = 0 or o_orderkey % 11 = 0 then 'no_table' else 'ok' end as outcome, "
    "count(*) as n from orders group by 1",
)
def outcome_summary(spark, sf):
    pages = adapters.detail_pages(adapters.cars(spark, sf))
    return ingest.outcome_summary(
        pages.select("status", extract.has_detail_table(F.col("html")).alias("has_table"))
    )
