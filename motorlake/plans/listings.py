"""Listing jobs from landed pages to stored, searchable items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.operators import extract, ingest, search
from motorlake.session import new_folder
from motorlake.sources.tables import materialise


def items_from_pages(pages: DataFrame) -> DataFrame:
    """Category pages (page_id, html) -> items, the last card per id.

    ``ingest_seq`` is the order of arrival: ``page_id``, which counts fetched pages over
    all runs. Of one id the card latest by page and place on the page counts.
    """
    cards = extract.extract_gl_cards(pages)
    last = ingest.last_wins(cards, ["id"], F.col("page_id"), F.col("pos"))
    return last.withColumn("ingest_seq", F.col("page_id").cast("long")).drop("page_id", "pos")


def land_category_pages(pages: DataFrame, items: DataFrame, path: str) -> None:
    """Merge new pages into items and store the typed result at ``path``.

    ``path`` is a new folder, not the one ``items`` is read from: readers move over when
    it is complete. The merge reads its batch twice, so the parsed cards are stored first
    and pages are parsed once.
    """
    folder = new_folder(pages.sparkSession, "landed-cards")
    batch = materialise(items_from_pages(pages), folder)
    search.write_typed_items(ingest.upsert_latest_items(items, batch), path)
