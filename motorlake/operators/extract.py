"""Rows out of landed HTML pages.

Input is always a table (page_id, html). Where an answer depends on how elements nest,
``mapInArrow`` parses each page with the helper in ``sources.markup``; pages that cannot
hold a card are dropped in the JVM first and never cross into Python. The flat variants
are regular expressions and stay in the JVM altogether.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import motorlake
from motorlake import constants as K
from motorlake.functions import listing as L
from motorlake.functions.text import strip
from motorlake.sources import markup

# The page functions travel to the workers inside the plan, with the helper they call:
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(motorlake)

# What each page function yields, behind the key of the page.
LINK_COLUMNS = (
    "pos int, href string, data_original string, src string, "
    "p_text string, l_text string, at_text string"
)
OFFER_COLUMNS = (
    "pos int, id string, brand string, model string, price string, "
    "taxed boolean, year string, price_text string, error string"
)
TAG_COLUMNS = "pos int, attribute string, value string"


PAGES_PER_OUTPUT = 256


_ARROW = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _map_pages(pages: DataFrame, key: str, rows_of, columns: str, carried: Sequence[str] = ()) -> DataFrame:
    """Run ``rows_of(html)`` on every page; its rows get the page key in front, and behind it
    the carried columns of the page.

    Output leaves the worker every few pages, so memory follows one slice of pages, not a
    whole input batch.
    """
    kept = [key, *carried]
    fields = [field.split() for field in columns.split(", ")]
    schema = ", ".join([*[f"{c} {pages.schema[c].dataType.simpleString()}" for c in kept], columns])
    names, types = [*kept, *[name for name, _ in fields]], [_ARROW[kind] for _, kind in fields]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_PER_OUTPUT):
                piece = batch.slice(start, PAGES_PER_OUTPUT)
                rows, owners = [], []
                for owner, html in enumerate(piece.column(len(kept)).to_pylist()):
                    found = [*rows_of(html)]
                    rows += found
                    owners += [owner] * len(found)
                if rows:
                    owner = pa.array(owners, pa.int32())
                    keys = [piece.column(i).take(owner) for i in range(len(kept))]
                    read = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays([*keys, *read], names)

    return pages.select(*kept, "html").mapInArrow(extract, schema)


# ---------------------------------------------------------------- category pages

def _link_rows(html: str, container: str = K.CARD_CONTAINER):
    """Links under each container; a link in nested containers comes once per container."""
    pos = 0
    for box in markup.parse(html).all("div", container):
        for link in box.all("a"):
            img = link.first("img")
            texts = [link.first("div", css) for css in ("p", "l", "at")]
            yield (
                pos,
                link.attrs.get("href"),
                img.attrs.get("data-original") if img else None,
                img.attrs.get("src") if img else None,
                *[t.text() if t else K.MISSING_TEXT for t in texts],
            )
            pos += 1


def container_links(pages: DataFrame) -> DataFrame:
    """Every link inside a card container, unparsed."""
    return _map_pages(
        pages.where(F.col("html").contains(K.CARD_CONTAINER)), "page_id", _link_rows, LINK_COLUMNS
    )


def extract_gl_cards(pages: DataFrame) -> DataFrame:
    """Listing cards of category pages; links that lead to no item are left out."""
    links = container_links(pages).withColumn("id", L.item_id(F.col("href")))
    return links.where("id IS NOT NULL").select(
        "page_id",
        "pos",
        "id",
        L.image_url(F.col("data_original"), F.col("src")).alias("image_src"),
        "p_text",
        "l_text",
        "at_text",
    )


def flat_links(pages: DataFrame, opening: str, closing: str) -> DataFrame:
    """(page_id, pos, href) of links in all regions between two flat markers, by regular
    expression."""
    regions = F.regexp_extract_all(F.col("html"), F.lit(f"(?s){opening}(.*?){closing}"), F.lit(1))
    links = F.lit(r'<a\b[^>]*?\bhref="([^"]*)"')
    hrefs = F.flatten(F.transform(regions, lambda region: F.regexp_extract_all(region, links, F.lit(1))))
    return pages.select("page_id", F.posexplode(hrefs).alias("pos", "href"))


# ---------------------------------------------------------------- search pages

def _offer_rows(html: str):
    for pos, card in enumerate(markup.parse(html).all("div", K.OFFER_CARD)):
        link = card.first("a", K.OFFER_LINK)
        if link is None:
            continue
        place = card.first("div", "card-loc")
        year = card.first("span", "grey-text")
        price = card.first("div", "price") or card.first("div", "ad-mob-price")
        amount = price.first("span") if price else None
        missing = [
            name for name, node in (("card-loc", place), ("grey-text", year)) if node is None
        ]
        yield (
            pos,
            *[link.attrs.get(f"data-{name}") for name in ("id", "brand", "model", "price")],
            None if place is None else place.first("span", "green-text") is not None,
            None if year is None else year.raw_text(),
            None if amount is None else amount.text(),
            "no " + " and ".join(missing) if missing else None,
        )


def extract_offer_cards(pages: DataFrame) -> DataFrame:
    """Cars of search pages, raw price and year text included.

    A card without its location or year part is kept with nulls and an ``error``, for the
    quarantine table, and does not cost the rest of its page.
    """
    candidates = pages.where(F.col("html").contains(K.OFFER_LINK))
    cards = _map_pages(candidates, "page_id", _offer_rows, OFFER_COLUMNS)
    price_text = F.col("price_text")
    return cards.select(
        "page_id", "pos", "id", "brand", "model", "price",
        L.offer_currency(price_text).alias("currency"),
        "taxed", "year",
        F.coalesce(price_text, F.lit("")).alias("original_price_text"),
        "error",
    )


# ---------------------------------------------------------------- detail pages

def _style_hides(attrs: dict[str, str]) -> bool:
    return "none" in attrs.get("style", "")


def _hidden(node: markup.Element) -> bool:
    return _style_hides(node.attrs)


def _tag_rows(html: str):
    table = markup.parse(html).first("table", K.DETAIL_TABLE)
    body = table.first("tbody") if table else None
    if body is None:
        return
    pos = 0
    for row in list(body.all("tr")):
        cells = list(row.all("td"))
        if len(cells) == 2:
            cells[1].remove(_hidden)
            yield pos, cells[0].text(), cells[1].text()
            pos += 1


def extract_detail_tags(pages: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """(car_id, pos, attribute, value) of detail pages (car_id, html), and any carried
    columns of the pages."""
    candidates = pages
    for word in K.DETAIL_TABLE.split():
        candidates = candidates.where(F.col("html").contains(word))
    return _map_pages(candidates, "car_id", _tag_rows, TAG_COLUMNS, carried)


def live_markup(html: Column) -> Column:
    """The page without comments and without the text of scripts, styles and templates."""
    dead = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
    return F.regexp_replace(html, dead, "")


def has_detail_table(html: Column) -> Column:
    """Whether the page has an attribute table, read off its opening tag."""
    words = r"\s+".join(K.DETAIL_TABLE.split())
    return live_markup(html).rlike(rf"""(?i)<table\b[^>]*\sclass\s*=\s*["']\s*{words}\s*["']""")


def strip_hidden_nodes(html: Column) -> Column:
    """The markup without elements whose style contains ``none``, with all they hold; the
    rest stays as it is written. How elements nest decides, so the page is read as a tree;
    only pages that can hide something are: those with "none" or with a numbered character,
    which may spell it."""

    @F.pandas_udf("string")
    def visible(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: page if page is None else markup.without(page, _style_hides))

    may_hide = html.contains("none") | html.contains("&#")
    return F.coalesce(visible(F.when(may_hide, html)), html)


# ---------------------------------------------------------------- page status

def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)


def count_divs(html: Column, css: str) -> Column:
    """How many ``div`` tags carry the class token ``css``, read off the opening tags."""
    tag = rf"""(?i)<div\b[^>]*?\sclass\s*=\s*["'](?:[^"']*\s)?{css}(?:\s[^"']*)?["']"""
    return F.regexp_count(live_markup(html), F.lit(tag))


def page_status(title: Column, containers: Column) -> Column:
    challenge = F.lit(False)
    for words in K.CHALLENGE_TITLES:
        challenge = challenge | title.contains(words)
    return (
        F.when(challenge, "challenge")
        .when(F.coalesce(containers, F.lit(0)) == 0, "soft_block")
        .otherwise("ok")
    )


def classify_pages(pages: DataFrame, container: str = K.CARD_CONTAINER) -> DataFrame:
    """(page_id, title, containers, status) without leaving the JVM."""
    html = F.col("html")
    read = pages.select(
        "page_id",
        strip(page_title(html)).alias("title"),
        count_divs(html, container).alias("containers"),
    )
    return read.withColumn("status", page_status(F.col("title"), F.col("containers")))
