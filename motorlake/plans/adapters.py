"""The test tables seen as listing data.

``ITEMS``, ``CARS`` and ``TAGS`` are plain SQL that Spark and DuckDB both run. The HTML
pages are made from the same rows, so what extraction must find is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.functions.rows import as_stored

ITEMS = """
select cast(p_partkey as varchar(20)) as id,
  case p_partkey%3 when 0 then concat('https://img.example/', cast(p_partkey as varchar(20))) else 'N/A' end as image_src,
  case p_partkey%6 when 0 then concat('$', num) when 1 then concat(num, ' ֏') when 2 then concat('€', num)
    when 3 then concat(num, ' ₽') when 4 then 'N/A' else 'Price on request' end as p_text,
  case when p_partkey%17=0 then 'Trailer' when p_partkey%19=0 then concat('New ', p_brand, ' ', p_name)
    else concat(cast(1990+p_size%35 as varchar(20)), ' ', p_brand, ' ', p_name, ', ', p_type) end as l_text,
  case p_partkey%5 when 0 then concat('Yerevan, ', num, ' km, Gasoline') when 1 then concat('Gyumri, ', num, ' miles, Diesel')
    when 2 then concat('Vanadzor, ', num, ' km, Hybrid') when 3 then 'Abovyan, Electric' else 'N/A' end as at_text,
  p_partkey as ingest_seq
from (select *,
  concat(cast(cast(floor((500+(p_partkey*37)%89500)/1000.0) as bigint) as varchar(20)), ',',
    lpad(cast((500+(p_partkey*37)%89500)%1000 as varchar(20)),3,'0')) as num
  from {part}) n
"""

CARS = """
select cast(o_orderkey as varchar(20)) as id, o_orderpriority as brand,
  concat('M', cast(o_custkey%20 as varchar(20))) as model, o_totalprice as price, 'USD' as currency,
  o_orderkey%2=0 as taxed, cast(extract(year from o_orderdate) as int)+15 as year,
  concat('USD ', cast(cast(floor(o_totalprice) as bigint) as varchar(20))) as original_price_text,
  o_orderdate as scraped_at
from {orders}
"""

# A tag has no arrival number here: the rest of its row orders it, as a struct.
TAGS = """
select cast(l_orderkey as varchar(20)) as car_id,
  case l_linenumber when 1 then 'Ձիաուժը' when 2 then 'Վազքը' when 3 then 'Շարժիչը' when 4 then 'Շարժիչի ծավալը'
    when 5 then 'Գույնը' when 6 then 'Մխոցների քանակը' else 'Վիճակը' end as attribute,
  case l_linenumber
    when 1 then concat(cast(cast(l_quantity*10 as int) as varchar(20)), ' hp')
    when 2 then concat(cast(cast(floor(l_extendedprice) as bigint) as varchar(20)), ' կմ')
    when 3 then case l_returnflag when 'A' then 'Gasoline' when 'N' then 'Diesel' else '' end
    when 4 then concat(cast(cast(floor(l_quantity/10) as int) as varchar(20)), '.', cast(cast(l_quantity as int)%10 as varchar(20)),
      case when l_partkey%10=0 then ' լ.' else ' L' end)
    when 5 then l_linestatus
    when 6 then cast(cast(l_quantity as int)%12 as varchar(20))
    else l_returnflag end as value,
  {seq} as seq
from {lineitem}
"""
SEQ_COLUMNS = (
    "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "part"))


def items_of(part: DataFrame) -> DataFrame:
    return as_stored(part.sparkSession.sql(ITEMS, part=part))


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cars_of(table(spark, sf_dir, "orders"))


def cars_of(orders: DataFrame) -> DataFrame:
    return orders.sparkSession.sql(CARS, orders=orders)


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags_of(table(spark, sf_dir, "lineitem"))


def tags_of(lineitem: DataFrame) -> DataFrame:
    text = TAGS.replace("{seq}", f"struct({SEQ_COLUMNS})")
    return lineitem.sparkSession.sql(text, lineitem=lineitem)


def first_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags as the keyed write leaves them: one row per (car, attribute)."""
    from motorlake.operators.ingest import first_wins

    return first_wins(tags(spark, sf_dir), ["car_id", "attribute"], F.col("seq"))


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.operators.unify import unify

    return unify(cars(spark, sf_dir), tags(spark, sf_dir), list(K.ATTRIBUTE_FEATURES))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.operators.features import build_training_set

    return build_training_set(unified(spark, sf_dir))


# ---------------------------------------------------------------- pages with known content

def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def category_pages(listed: DataFrame) -> DataFrame:
    """One page per item: its card, a link that is no item, and for every fourth item the
    card once more in a nested container, with a later price."""
    def card(price: Column) -> Column:
        seq = F.col("ingest_seq")
        img = (
            F.when(seq % 3 == 0, _text('<img src="x.png" data-original="//img.example/', F.col("id"), '.jpg">'))
            .when(seq % 3 == 1, _text('<img data-original="" src="/s/', F.col("id"), '.png"/>'))
            .otherwise("")
        )
        price_div = F.when(seq % 13 == 0, "").otherwise(_text('<div class="p"> ', price, "\n</div>"))
        place, rest = F.substring_index("at_text", ",", 1), F.expr(
            "substr(at_text, length(substring_index(at_text, ',', 1)) + 1)"
        )
        return _text(
            '<a href="/en/item/', F.col("id"), '?ref=list">', img, price_div,
            '<div class="x l">', F.col("l_text"), "</div>",
            '<div class="at"><span> ', place, " </span><b>", rest, "</b><!-- note --></div></a>",
        )

    nested = F.when(
        F.col("ingest_seq") % 4 == 0, _text('<div class="gl">', card(F.lit("$7,777")), "</div>")
    ).otherwise("")
    html = _text(
        "<html><head><title>Cars &amp; more</title><script>var a='<div class=\"gl\">';</script></head><body>",
        '<a href="/item/outside">out</a><div class="dl gl">', card(F.col("p_text")),
        '<a href="/category/23">more</a><a>no link</a>', nested, "</div></body></html>",
    )
    return listed.select(F.col("ingest_seq").alias("page_id"), html.alias("html"))


def offer_pages(cars: DataFrame) -> DataFrame:
    """One search page per car: its card, a card with no link, and for every fifth car a
    card that lacks its location and year."""
    key = F.col("id").cast("bigint")
    price = F.col("price").cast("decimal(18,2)").cast("string")
    link = _text(
        '<a class="img click-for-gtag" data-id="', F.col("id"), '" data-brand="', F.col("brand"),
        '" data-model="', F.col("model"), '" data-price="', price, '">go</a>',
    )
    tax = F.when(F.col("taxed"), '<span class="green-text">ok</span>').otherwise("")
    holder = F.when(key % 3 == 0, "ad-mob-price").otherwise("price bold")
    money = F.when(key % 7 == 0, "none").otherwise(
        _text("<span> ", F.col("original_price_text"), " </span><span>old</span>")
    )
    good = _text(
        '<div class="card hoverable">', link, '<div class="card-loc">', tax, "</div>",
        '<span class="grey-text">\n', F.col("year").cast("string"), '\n</span><div class="', holder, '">',
        money, "</div></div>",
    )
    broken = F.when(key % 5 == 0, _text('<div class="card">', link, "</div>")).otherwise("")
    html = _text(
        "<html><title>Search</title><body>", good, '<div class="card"><a>advert</a></div>', broken,
        "</body></html>",
    )
    return cars.select(key.alias("page_id"), html.alias("html"))


def detail_pages(cars: DataFrame) -> DataFrame:
    """One detail page per car with an HTTP status. Some pages have no table, some no table
    body, some swap the class names; values hide markup that must not show."""
    key = F.col("id").cast("bigint")
    css = F.when(key % 11 == 0, "ad-det pad-top-6").otherwise("pad-top-6 ad-det")
    body_open = F.when(key % 9 == 0, "").otherwise("<tbody>")
    body_close = F.when(key % 9 == 0, "").otherwise("</tbody>")
    row_text = _text(
        "<tr><td> Brand </td><td>", F.col("brand"),
        '<span style="display: none;">{"x":1}</span></td></tr>',
        "<tr><td>Year</td><td><b> ", F.col("year").cast("string"),
        ' </b><i style="pointer-events:none">y<u>z</u></i></td></tr>',
        "<tr><td>Brand</td><td>later</td></tr><tr><td>lonely</td></tr>",
    )
    gone = '<p>sold</p><!-- <table class="pad-top-6 ad-det"><tbody></tbody></table> -->'
    table_html = F.when(key % 10 == 0, gone).otherwise(
        _text('<table class="other"><tbody><tr><td>a</td><td>b</td></tr></tbody></table><table class="',
              css, '">', body_open, row_text, body_close, "</table>")
    )
    status = F.when(key % 23 == 0, 404).when(key % 29 == 0, 500).otherwise(200)
    return cars.select(
        F.col("id").alias("car_id"),
        _text("<html><body>", table_html, "</body></html>").alias("html"),
        status.alias("status"),
    )
