"""Counts and choices for filter menus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.functions.listing import parse_title


def _makes_and_models(items: DataFrame) -> DataFrame:
    """From the stored columns of typed items where they exist, else from the title."""
    if {"make", "model"} <= set(items.columns):
        return items.select(F.coalesce("make", F.lit(K.UNKNOWN_MAKE)).alias("make"), "model")
    title = parse_title(F.col("l_text"))
    return items.select(title["make"].alias("make"), title["model"].alias("model"))


def facet_make_counts(items: DataFrame) -> DataFrame:
    counts = _makes_and_models(items).groupBy("make").agg(F.count("*").alias("n"))
    return counts.orderBy("make")


def make_model_counts(items: DataFrame) -> DataFrame:
    return _makes_and_models(items).groupBy("make", "model").agg(F.count("*").alias("n"))


def facet_make_model_counts(items: DataFrame) -> DataFrame:
    return make_model_counts(items).orderBy("make", "model")


def facet_tree(items: DataFrame, letters: int = 2) -> DataFrame:
    """Rows (name, count, part, models[(name, count)]), models sorted by name.

    A part holds the models of a make that begin with the same ``letters`` characters, so
    the parts in their order list all models of the make in theirs. The rule looks at names
    alone. The make of unparsed titles has a "model" per title; its parts are as many as
    there are beginnings. ``count`` is the make's.
    """
    counts = make_model_counts(items)
    totals = counts.groupBy("make").agg(F.sum("n").alias("count"))
    entry = F.struct(F.col("model").alias("name"), F.col("n").alias("count"))
    part = F.substring(F.coalesce("model", F.lit("")), 1, letters).alias("part")
    parts = counts.groupBy("make", part).agg(F.sort_array(F.collect_list(entry)).alias("models"))
    return parts.join(totals, "make").select(F.col("make").alias("name"), "count", "part", "models")


def distinct_options(rows: DataFrame, fields: Sequence[str] = K.OPTION_FIELDS) -> DataFrame:
    """(field, value) for every menu at once, from one scan."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    )
    return rows.select(F.inline(pairs)).distinct().orderBy("field", "value")


def cascading_models(rows: DataFrame, make: str | None = None) -> DataFrame:
    """Models of one make, or (Make, Model) pairs of all makes."""
    if make is None:
        return rows.select("Make", "Model").distinct().orderBy("Make", "Model")
    return rows.where(F.col("Make") == make).select("Model").distinct().orderBy("Model")


def catalog_counts(**tables: DataFrame) -> DataFrame:
    """Row count of each named table."""
    counted = None
    for name, rows in tables.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        counted = one if counted is None else counted.unionByName(one)
    return counted
