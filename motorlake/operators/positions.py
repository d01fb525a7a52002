"""Tables stored in an order, with a directory of where each position lies.

A range exchange sorts the table without any task seeing all of it; each task writes one
folder (``page_part``) and numbers its rows from 0 (``place``). The directory has a row per
folder: how many rows it holds and the position of its first. A position is found by the
directory alone, so page 1 and page 1,000,000 cost the same: the folders that hold the page,
and in them the row groups its places lie in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL = (1 << 33) - 1


def store_in_order(rows: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Write ``rows`` sorted by ``order`` and the directory of their positions.

    Rows of equal order keep some order, fixed once stored. End ``order`` with the key, so
    that equal rows need not share a task. Replaces what ``path`` held.
    """
    spark = rows.sparkSession
    ids = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()
    )
    parted = ids.withColumn("page_part", F.shiftright("place", 33).cast("int")).withColumn(
        "place", F.col("place").bitwiseAND(F.lit(_LOCAL))
    )
    parted.sortWithinPartitions("page_part", "place").write.mode("overwrite").partitionBy("page_part").parquet(
        f"{path}/rows"
    )
    parted.limit(0).write.mode("overwrite").parquet(f"{path}/schema")
    before = Window.orderBy("page_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per folder
    counts = stored(spark, path).groupBy("page_part").agg(F.count("*").alias("rows"))
    first = F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")
    counts.select("page_part", first, "rows").coalesce(1).write.mode("overwrite").parquet(f"{path}/directory")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows with ``page_part`` and ``place``; an empty table has no folders, only a schema."""
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page_part int, first long, rows long").parquet(f"{path}/directory")


def with_positions(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their ``position``."""
    return stored(spark, path).join(directory(spark, path), "page_part").withColumn(
        "position", F.col("first") + F.col("place")
    ).drop("page_part", "place", "first", "rows")


def total(spark: SparkSession, path: str) -> int:
    """Rows in all, from the directory."""
    return directory(spark, path).agg(F.sum("rows")).first()[0] or 0


def slice_of(spark: SparkSession, path: str, start: int, size: int) -> DataFrame:
    """The rows at positions ``start`` to ``start + size``, with ``position``, in order.

    The directory names the folders, at most ``size`` of them; folders and places become
    filters of the scan.
    """
    found = directory(spark, path).where((F.col("rows") > 0) & (F.col("first") < start + size)
                                         & (F.col("first") + F.col("rows") > start)).collect()
    chosen, position = F.lit(False), F.lit(None).cast("long")
    for part, first, rows in found:
        low, high = max(start - first, 0), min(start + size - first, rows)
        here = F.col("page_part") == part
        chosen |= here & (F.col("place") >= low) & (F.col("place") < high)
        position = F.when(here, F.col("place") + first).otherwise(position)
    rows = stored(spark, path).where(chosen).withColumn("position", position)
    return rows.drop("page_part", "place").orderBy("position")
