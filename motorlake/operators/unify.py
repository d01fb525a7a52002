"""Attribute rows to one wide car table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.operators.ingest import first_wins

def attribute_names(tags: DataFrame) -> list[str]:
    """Distinct attribute names, sorted: the columns of a pivot over all of them. A plan
    needs its column names; there are as many as the pivot has columns."""
    names = tags.where("attribute IS NOT NULL").select("attribute").distinct()
    return sorted(row[0] for row in names.toLocalIterator())


def pivot_tags(tags: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """(car_id, attribute, value, seq) -> one row per car, one column per attribute.

    The first non-null value by ``seq`` counts; one without ``seq`` counts only where the
    attribute has no other. The least (seq, value) combines before the single shuffle by car.
    """
    known = tags.where("car_id IS NOT NULL AND value IS NOT NULL AND attribute IS NOT NULL")
    grouped = known.groupBy("car_id").pivot("attribute", list(attributes))
    first = grouped.agg(F.min(F.struct(F.col("seq").isNull().alias("_none"), "seq", "value")))
    return first.select("car_id", *[F.col(f"`{a}`")["value"].alias(a) for a in attributes])


def unpivot_tags(wide: DataFrame) -> DataFrame:
    """Back to (car_id, attribute, value), nulls left out."""
    names = [c for c in wide.columns if c != "car_id"]
    pairs = wide.unpivot(["car_id"], names, "attribute", "value")
    return pairs.where("value IS NOT NULL")


def unify_left_join(cars: DataFrame, wide: DataFrame) -> DataFrame:
    """Cars with their attributes; an attribute named like a car column, in any case as
    Spark compares names, gets ``tag_``."""
    taken = {c.lower() for c in cars.columns}
    clashes = {c: f"tag_{c}" for c in wide.columns if c.lower() in taken}
    side = wide.withColumnsRenamed(clashes)
    return cars.join(side, cars["id"] == side["car_id"], "left").drop("car_id")


def unify(cars: DataFrame, tags: DataFrame, attributes: Sequence[str]) -> DataFrame:
    return unify_left_join(cars, pivot_tags(tags, attributes))


def tags_fk_check(tags: DataFrame, cars: DataFrame) -> DataFrame:
    """(car_id, n_tags) of tags whose car does not exist.

    Tags shrink to one row per car before the join.
    """
    per_car = tags.where("car_id IS NOT NULL").groupBy("car_id").agg(F.count("*").alias("n_tags"))
    return per_car.join(cars.select(F.col("id").alias("car_id")), "car_id", "left_anti")


TRAINING_COLUMNS = (*K.CAR_FEATURES, *K.ATTRIBUTE_FEATURES)


def tag_objects(tags: DataFrame, order: str = "seq") -> DataFrame:
    """(car_id, tags): every attribute of a car in one VARIANT, the first value of each.

    One pass and no list of names: attributes nobody knew of are kept, and read later by
    ``tag_value``. Rows without car or attribute are left out; null values count as none.
    """
    first = first_wins(tags.where("value is not null"), ["car_id", "attribute"], F.col(order))
    entries = F.map_from_entries(F.collect_list(F.struct("attribute", "value")))
    return first.groupBy("car_id").agg(F.to_variant_object(entries).alias("tags"))


def tag_value(name: str, tags: str = "tags") -> Column:
    """One attribute out of a VARIANT, null where the car has none."""
    quote = '"' if "'" in name else "'"
    return F.variant_get(F.col(tags), f"$[{quote}{name}{quote}]", "string")
