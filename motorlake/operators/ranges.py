"""Ranges as a table: each value once per closed range it lies in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024
SALTS = 16


def range_join(rows: DataFrame, ranges: DataFrame, value: str, bins: int = BINS, salts: int = SALTS) -> DataFrame:
    """The rows with the columns of every range (lo, hi, ...) that holds ``value``.

    The span of the values is cut into ``bins``; a range is listed under the bins it touches
    and a row has one bin, so the join is by equal bins, the bounds are tested exactly, and a
    pair comes once. Rows of a bin are dealt over ``salts`` by their own hash and ranges
    listed once for each, so a bin with a third of all rows is many keys; what is uneven
    beyond that, adaptive execution splits. Rows and ranges with nulls match nothing. Only
    the least and the greatest value reach the driver.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    if low is None:
        low = high = 0
    width = max((float(high) - float(low)) / bins, 1e-9)

    def bin_of(column):
        return F.floor((column.cast("double") - F.lit(float(low))) / F.lit(width)).cast("long")

    inside = ranges.where((F.col("lo") <= F.col("hi")) & (F.col("hi") >= low) & (F.col("lo") <= high))
    first = F.greatest(bin_of(F.col("lo")), F.lit(0).cast("long"))
    last = F.least(bin_of(F.col("hi")), F.lit(bins).cast("long"))
    listed = inside.withColumn("_bin", F.explode(F.sequence(first, last))).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    kept = rows.where(F.col(value).isNotNull())
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int")
    keyed = kept.withColumns({"_bin": bin_of(F.col(value)), "_salt": salt})
    met = keyed.join(listed, ["_bin", "_salt"])
    return met.where(F.col(value).between(F.col("lo"), F.col("hi"))).drop("_bin", "_salt")
