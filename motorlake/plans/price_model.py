"""Car jobs from landed pages to a scored price model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.operators import extract, features, ingest, model, unify
from motorlake.session import new_folder
from motorlake.sources.tables import materialise, write_replace


def offer_cards(pages: DataFrame) -> DataFrame:
    """Typed cards of search pages; ``error`` tells why a card cannot be used."""
    cards = extract.extract_offer_cards(pages).withColumnRenamed("error", "card_error")
    typed = ingest.coerce_cars(cards).withColumn("error", F.coalesce("card_error", "error"))
    return typed.drop("card_error")


def split_offer_cards(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cars, quarantine); the last usable card per id stays."""
    good = cards.where("error IS NULL").drop("error", "price_raw", "year_raw")
    last = ingest.last_wins(good, ["id"], F.col("page_id"), F.col("pos")).drop("page_id", "pos")
    return ingest.default_timestamp(last), cards.where("error IS NOT NULL")


def cars_from_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_offer_cards(offer_cards(pages))


def land_search_pages(pages: DataFrame, cars: DataFrame, path: str) -> DataFrame:
    """Merge the cars of new search pages into ``cars``, store them at ``path`` (a new
    folder), and return the quarantine. The parsed cards are stored first, so that pages
    are parsed once."""
    cards = materialise(offer_cards(pages), new_folder(pages.sparkSession, "offer-cards"))
    good, bad = split_offer_cards(cards)
    write_replace(ingest.upsert_latest(cars, good, ["id"], "scraped_at"), path)
    return bad


def land_detail_pages(pages: DataFrame, path: str, landing: str | None = None) -> None:
    """Append the new tags of landed detail pages to the tags stored at ``path``; a value
    already there stays. Running it again for the same pages appends nothing."""
    spark = pages.sparkSession
    batch = materialise(tags_from_pages(pages, landing), new_folder(spark, "detail-tags"))
    stored = spark.read.parquet(path)
    fresh = ingest.insert_ignore(stored, batch, ["car_id", "attribute"], "seq")
    fresh.select(*stored.columns).write.mode("append").parquet(path)


def tags_from_pages(pages: DataFrame, landing: str | None = None) -> DataFrame:
    """Detail pages (car_id, html) -> tags, the first value per attribute.

    ``landing`` names a column of the pages that orders several landings of one car: the
    first landing counts.
    """
    first = landed_tags(pages, landing)
    return first.drop(landing) if landing else first


def landed_tags(pages: DataFrame, landing: str | None = None) -> DataFrame:
    """``tags_from_pages`` with the column ``landing`` of the landing that counted."""
    carried = [landing] if landing else []
    found = extract.extract_detail_tags(pages, carried).withColumnRenamed("pos", "seq")
    order = [F.col(c) for c in (*carried, "seq")]
    return ingest.first_wins(found, ["car_id", "attribute"], *order)


def train_and_evaluate(
    cars: DataFrame,
    tags: DataFrame,
    path: str,
    settings: model.TrainingSettings = model.TrainingSettings(),
) -> DataFrame:
    """Unify, clean, split, fit, store the model, and return (mae, r2) on the test part.

    The training set is stored once: encoder, trainer and scoring read it.
    """
    wide = unify.unify(cars, tags, list(K.ATTRIBUTE_FEATURES))
    folder = new_folder(cars.sparkSession, "training-set")
    train, test = model.train_test_split(materialise(features.build_training_set(wide), folder))
    fitted = model.train_price_model(train, path, settings)
    return model.evaluate_mae_r2(model.predict_price(test, path, fitted))
