import html
import random

from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake import schemas
from motorlake.operators import extract, ingest, search
from motorlake.plans import adapters, listings, price_model
from motorlake.sources import markup, tables


def pages(spark, *htmls, key="page_id"):
    kind = "long" if key == "page_id" else "string"
    rows = [(i if kind == "long" else str(i), h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, f"{key} {kind}, html string")


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_tree_rules():
    root = markup.parse(
        "<div class='a'>x <b> y </b><!-- c -->z<br>w &amp; v &lt; u<p>open</div></i>tail<script>1<2</script>"
    )
    box = root.first("div", "a")
    assert box.text() == "xyzw & v < uopen"
    assert root.text().endswith("tail")
    assert markup.parse("a < b").text() == "a < b"
    assert markup.parse(None).text() == ""
    deep = markup.parse("<div>" * 5000 + "x")
    assert deep.text() == "x" and sum(1 for _ in deep.all("div")) == 5000
    assert markup.parse("<b>" * 50_000 + "</i>" * 50_000 + "x").text() == "x"
    assert [e.tag for e in markup.parse("<p><br/><img/><i/>a</p><u>b</u>").walk()] == ["p", "br", "img", "i", "u"]


def test_category_cards(spark):
    html = """<div class="x gl y"><a href="/item/1?a"><img src="" data-original="//i/1.jpg">
      <div class="p">  $5 <b> 0 </b></div><div class="big l">2015 Kia Rio</div></a>
      <a href="">none</a><a href="/category/2">c</a>
      <div class="gl"><a href="/item/2"><div class="at">Yerevan,<i> 5 km</i></div></a></div></div>
      <div class="glx"><a href="/item/3">no</a></div>"""
    got = extract.extract_gl_cards(pages(spark, html, "<p>gl</p>", None))
    assert sorted(rows(got, "page_id", "pos", "id", "image_src", "p_text", "l_text", "at_text")) == [
        (0, 0, "1", "https://i/1.jpg", "$50", "2015 Kia Rio", "N/A"),
        (0, 3, "2", "N/A", "N/A", "N/A", "Yerevan,5 km"),
        (0, 4, "2", "N/A", "N/A", "N/A", "Yerevan,5 km"),
    ]


def test_last_card_of_an_item_stays(spark):
    card = '<div class="gl"><a href="/item/1"><div class="p">%s</div></a></div>'
    got = listings.items_from_pages(pages(spark, card % "$1" + card % "$2", card % "$3", "<p>"))
    assert rows(got, "id", "p_text") == [("1", "$3")]


OFFER = (
    '<div class="card"><a class="btn click-for-gtag" data-id="7" data-brand="Kia" data-model="Rio" '
    'data-price="9000"></a><div class="card-loc">%s</div><span class="grey-text">%s</span>'
    '<div class="%s"><span> $ 9,000 </span></div></div>'
)


def test_offer_cards(spark):
    html = (
        OFFER % ('<span class="green-text"></span>', "\n2015\n", "price")
        + OFFER % ("", "2016", "ad-mob-price")
        + '<div class="card"><a>none</a></div>'
        + '<div class="card"><a class="click-for-gtag" data-id="8"></a></div>'
    )
    got = extract.extract_offer_cards(pages(spark, html))
    names = ("pos", "id", "price", "currency", "taxed", "year", "original_price_text", "error")
    assert sorted(rows(got, *names)) == [
        (0, "7", "9000", "$", True, "\n2015\n", "$ 9,000", None),
        (1, "7", "9000", "$", False, "2016", "$ 9,000", None),
        (3, "8", None, "?", None, None, "", "no card-loc and grey-text"),
    ]
    good, bad = price_model.cars_from_pages(pages(spark, html))
    assert rows(good, "id", "price", "year", "taxed") == [("7", 9000.0, 2016, False)]
    assert rows(bad, "id", "error") == [("8", "no card-loc and grey-text")]


def test_detail_tags(spark):
    table = '<table class="%s">%s<tr><td> A </td><td>1<span style="display: none;">{}</span></td></tr>%s</table>'
    nested = (
        '<table class="pad-top-6  ad-det"><tbody><tr><td>B</td><td><p style="x:none"><b>h</b></p> v '
        "<i>w</i></td></tr><tr><td>only</td></tr><tr><td>B</td><td>2</td></tr></tbody></table>"
    )
    got = extract.extract_detail_tags(
        pages(
            spark,
            table % ("pad-top-6 ad-det", "<tbody>", "</tbody>"),
            table % ("ad-det pad-top-6", "<tbody>", "</tbody>"),
            table % ("pad-top-6 ad-det", "", ""),
            nested,
            "<p>pad-top-6 ad-det</p>",
            key="car_id",
        )
    )
    assert sorted(rows(got, "car_id", "pos", "attribute", "value")) == [
        ("0", 0, "A", "1"), ("3", 0, "B", "vw"), ("3", 1, "B", "2"),
    ]
    tags = price_model.tags_from_pages(pages(spark, nested, key="car_id"))
    assert rows(tags, "attribute", "value") == [("B", "vw")]


def test_nested_row_of_a_hidden_part_is_gone(spark):
    html = (
        '<table class="pad-top-6 ad-det"><tbody><tr><td>A</td><td><table style="display:none"><tr><td>x</td>'
        "</tr></table>v</td></tr></tbody></table>"
    )
    # The outer row has three cells, so it is no attribute; its inner row has one.
    assert rows(extract.extract_detail_tags(pages(spark, html, key="car_id")), "value") == []


def test_detail_table_flag(spark):
    got = pages(
        spark,
        '<table id="a" class="pad-top-6 ad-det">',
        "<table class='ad-det pad-top-6'>",
        '<table data-class="pad-top-6 ad-det">',
    ).select("page_id", extract.has_detail_table(F.col("html")).alias("t"))
    assert sorted(rows(got, "page_id", "t")) == [(0, True), (1, False), (2, False)]


def test_page_status(spark):
    box = '<div class="gl">'
    got = extract.classify_pages(
        pages(
            spark,
            f"<title>Cars</title>{box}<DIV id=x CLASS='a gl b'><div class='glx'><div data-class='gl'>",
            "<title>Just a moment...</title>",
            f"<title>Security check</title>{box}",
            "<title>Cars</title>",
            "no title",
            None,
        )
    )
    assert got.where("page_id = 5").first()["status"] == "soft_block"
    got = got.where("page_id < 5")
    assert sorted(rows(got, "page_id", "containers", "status")) == [
        (0, 2, "ok"), (1, 0, "challenge"), (2, 1, "challenge"), (3, 0, "soft_block"), (4, 0, "soft_block"),
    ]


def test_whole_pages_are_read(spark):
    far = "<p>" + "x" * 3_000_000 + '</p><div class="gl"><a href="/item/1">a</a></div>'
    assert rows(extract.extract_gl_cards(pages(spark, far)), "id") == [("1",)]


def test_crawl_jobs_end_to_end(spark, sf, tmp_path):
    cars = adapters.cars(spark, sf)
    old = spark.createDataFrame([], schemas.CARS)
    first, second, tag_path = (str(tmp_path / n) for n in ("cars-1", "cars-2", "tags"))

    bad = price_model.land_search_pages(adapters.offer_pages(cars), old, first)
    stored = spark.read.parquet(first)
    want = cars.select("id", "brand", "model", "price", "year")
    assert stored.select(*want.columns).exceptAll(want).count() == 0 and stored.count() == cars.count()
    assert bad.count() == cars.where("cast(id as int) % 5 = 0").count()

    raise_price = cars.where("brand = '2-HIGH'").withColumn("price", F.lit(5.0))
    price_model.land_search_pages(adapters.offer_pages(raise_price), stored, second)
    newer = spark.read.parquet(second)
    assert newer.count() == cars.count()
    assert newer.where("price = 5.0").count() == raise_price.count()
    assert newer.where("price = 5.0").agg(F.min("scraped_at")).first()[0] >= stored.agg(F.max("scraped_at")).first()[0]

    spark.createDataFrame([], schemas.TAGS).write.parquet(tag_path)
    details = adapters.detail_pages(cars)
    for _ in range(2):
        price_model.land_detail_pages(details, tag_path)
        tags = spark.read.parquet(tag_path)
        assert tags.groupBy("car_id", "attribute").count().where("count > 1").count() == 0
        assert rows(tags.where("attribute = 'Brand' and value = 'later'"), "value") == []
    pending = ingest.pending_ids(cars, tags)
    assert pending.count() == cars.where(
        "cast(id as int) % 9 = 0 or cast(id as int) % 10 = 0 or cast(id as int) % 11 = 0"
    ).count()


def test_listing_jobs_end_to_end(spark, sf, tmp_path):
    listed = adapters.items(spark, sf)
    one, two = str(tmp_path / "v1"), str(tmp_path / "v2")
    empty = spark.createDataFrame([], schemas.ITEMS)
    listings.land_category_pages(adapters.category_pages(listed), empty, one)
    first = spark.read.parquet(one)
    assert first.count() == listed.count()
    card = '<div class="gl"><a href="/item/3"><div class="l">2020 Kia Rio, 1.6</div><div class="p">$10</div></a></div>'
    later = spark.createDataFrame([(10**6, card)], "page_id long, html string")
    listings.land_category_pages(later, first.select(*schemas.ITEMS.names), two)
    second = spark.read.parquet(two)
    assert second.count() == listed.count()
    assert rows(second.where("id = '3'"), "make", "model", "spec", "price_value") == [("Kia", "Rio", "1.6", 10.0)]
    # A replaced listing moves to the end of the arrival order.
    last = search.paginate(second, -(-second.count() // 24)).collect()[-1]
    assert last["id"] == "3"


def test_flat_links_agree_with_the_tree(spark, sf):
    given = adapters.table(spark, sf, "pages")
    flat = sorted(rows(extract.flat_links(given, "<nav>", "</nav>"), "page_id", "pos", "href"))
    tree = [
        (page["page_id"], pos, link.attrs["href"])
        for page in given.collect()
        for pos, link in enumerate(markup.parse(page["html"]).first("nav").all("a"))
    ]
    assert flat == sorted(tree) and len(flat) > 0


def test_given_pages_parse_to_their_titles(spark, sf):
    given = adapters.table(spark, sf, "pages")
    titles = dict(rows(extract.classify_pages(given, "ad"), "page_id", "title"))
    for page in given.collect():
        root = markup.parse(page["html"])
        assert root.first("title").text() == html.unescape(titles[page["page_id"]])
        assert sum(1 for _ in root.all("div", "ad")) == 1


def test_hidden_parts_go_with_all_they_hold(spark):
    from conftest import values

    cases = {
        '<span style="display:none">a<b>x</b></span>y': "y",
        "<span style='display:none'>a</span>y": "y",
        "<td>k<i style=display:none>a<i>b</i>c</i> v</td>": "<td>k v</td>",
        "<p>a<br style='display:none'>b</p>": "<p>ab</p>",
        "<ul><li style='display: none'>a<li>b</ul>c": "<ul></ul>c",
        "no tags & <b class='none'>kept</b>": "no tags & <b class='none'>kept</b>",
        "<div style='none'>open to the end": "",
        "</b>stray<!-- <i style='none'> -->": "</b>stray<!-- <i style='none'> -->",
        None: None,
    }
    assert values(spark, extract.strip_hidden_nodes, list(cases)) == list(cases.values())


def test_markup_in_scripts_and_comments_does_not_count(spark):
    html = "<script>var a='<div class=\"gl\">';</script><!-- <div class='gl'><table class='pad-top-6 ad-det'> -->"
    page = spark.createDataFrame([(1, html), (2, html + "<div class='x gl'></div>")], "page_id long, html string")
    assert [r.containers for r in extract.classify_pages(page).orderBy("page_id").collect()] == [0, 1]
    assert [r[0] for r in page.select(extract.has_detail_table(F.col("html"))).collect()] == [False, False]


def test_links_of_every_region(spark):
    html = '<nav><a href="1"></a></nav><a href="x"></a><nav><a href="2"></a><a href="3"></a></nav>'
    page = spark.createDataFrame([(7, html)], "page_id long, html string")
    assert [(r.pos, r.href) for r in extract.flat_links(page, "<nav>", "</nav>").collect()] == [(0, "1"), (1, "2"), (2, "3")]


def test_the_first_landing_of_a_car_counts(spark):
    def page(value):
        return f'<table class="{K.DETAIL_TABLE}"><tbody><tr><td>a</td><td>{value}</td></tr></tbody></table>'

    landed = spark.createDataFrame([("1", page("old"), 4), ("1", page("new"), 9)], "car_id string, html string, at long")
    for rows_ in (landed, landed.orderBy(F.desc("at")).coalesce(1)):
        assert [r.value for r in price_model.tags_from_pages(rows_, "at").collect()] == ["old"]


def _tree(node):
    return node.tag, node.attrs, [c if isinstance(c, str) else _tree(c) for c in node.children]


def _built(page):
    builder = markup._Builder()
    builder.feed(page)
    builder.close()
    return builder.root


def test_plain_pages_are_read_as_the_parser_reads_them():
    plain = (
        "<!DOCTYPE html><DIV Class='a b' data-x=\"1>\"></DIV>", "<p>a<br/><i/>b</p></u>c<!-- <b>-</b> -->d", "",
        "<a href=\"/x?y=1\" HIDDEN>x &amp; y</a >", "<script>if (a<b) x('</div>')</script><style></style>t &lt;",
        "<title>T</title><td\n x='1'\n>1 > 0</td><p><b>open</p>", "<!----><x><!--x--->y</x><div",
    )
    odd = ("<a href=x>", "a < b", "<a b='&lt;'>", "<p", "<!-->x", "<!-- a", "<script>x", "<a/ b>", "<é>", "<?x?>", "</>")
    for page in (*plain, *odd):
        assert _tree(markup.parse(page)) == _tree(_built(page)), page
    assert all(markup._parse_plain(page) is None for page in odd)


def test_pieces_of_markup_in_any_order_give_one_tree():
    pieces = (
        "<div>", "</div>", "<div class='a b'>", '<a href="/x?y=1">', "</a>", "<br/>", "<i/>", "text", " ", "&amp;", "&",
        "a < b", "<!-- c -->", "<!-- <b> -->", "<!-- a -- b -->", "<!DOCTYPE html>", "<script>", "</script>",
        "<script>var a='<div>';</script>", "<title>", "</title>", "<DIV CLASS=\"Q\">", "</ div>", "<a href=x>",
        "<p x='a>b'>", "<img src=\"/s/\"/>", "<textarea>", "</br>", "<p", "&#65;", "--", ">", "'",
    )
    draw, plain = random.Random(3), 0
    for _ in range(3000):
        page = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 8)))
        read = markup._parse_plain(page)
        plain += read is not None
        assert _tree(markup.parse(page)) == _tree(_built(page)), page
    assert plain > 300


def test_pages_of_one_site_do_not_need_the_general_parser(spark, sf, monkeypatch):
    """Search, detail and category pages are all read in one cut, none by ``_Builder``."""
    cars = adapters.cars(spark, sf)
    made = [adapters.offer_pages(cars), adapters.detail_pages(cars), adapters.category_pages(adapters.items(spark, sf))]
    for kind in made:
        for row in kind.limit(50).collect():
            assert _tree(markup._parse_plain(row["html"])) == _tree(_built(row["html"]))


def test_tasks_of_heavy_work_follow_the_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(10_000).coalesce(1).write.parquet(path)
    monkeypatch.setattr(tables, "ROWS_A_TASK", 500)
    spread = tables.spread_scan(spark.read.parquet(path))
    sizes = [len(part) for part in spread.rdd.glom().collect()]
    assert len(sizes) == 20 and max(sizes) <= 600 and sum(sizes) == 10_000
    small = spark.read.parquet(path).where("id < 10")
    assert tables.spread_scan(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
