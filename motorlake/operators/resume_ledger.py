"""What a crawl has seen, as stored bitmaps.

An id is a bit of a bitmap of 32,768 ids, so a day's batch is a few kilobytes per bucket it
touches, and counts need neither the cars nor the tags again. A batch is appended under its
number; a batch that is run again replaces itself, and equal bits merge by OR, so ids that
come twice change nothing. ``compact`` merges the batches.

Ids are integers (or text that spells one); rows with any other id are refused by the cast,
and rows without an id are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "bucket long, seen binary, side string, batch int"


def _bits(rows: DataFrame, column: str) -> DataFrame:
    ids = rows.select(F.col(column).cast("long").alias("id")).where("id is not null")
    # Combined before the shuffle: a bucket is one bitmap a task, whatever repeats in it.
    return ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("seen")
    )


def add(path: str, side: str, batch: int, rows: DataFrame, column: str) -> None:
    """Note the ids of batch ``batch`` on a side: 'cars' or 'tags'."""
    _bits(rows, column).write.mode("overwrite").parquet(f"{path}/side={side}/batch={batch}")


def merged(spark: SparkSession, path: str) -> DataFrame:
    """(side, bucket, seen): all batches."""
    log = spark.read.schema(_SCHEMA).parquet(path)
    return log.groupBy("side", "bucket").agg(F.bitmap_or_agg("seen").alias("seen"))


def pending_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row (total, done, pending): cars known, cars with tags, cars still without."""
    sides = merged(spark, path)
    both = sides.groupBy("bucket").agg(
        F.sum(F.when(F.col("side") == "cars", F.bitmap_count("seen"))).alias("total"),
        F.sum(F.when(F.col("side") == "tags", F.bitmap_count("seen"))).alias("done"),
        F.when(F.count("*") == 2, F.bitmap_count(F.bitmap_and_agg("seen"))).alias("shared"),
    )
    sums = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "done", "shared")])
    return sums.select("total", "done", (F.col("total") - F.col("shared")).alias("pending"))


def compact(spark: SparkSession, path: str, target: str) -> None:
    """A new ledger that starts with everything the old one has seen."""
    merged(spark, path).withColumn("batch", F.lit(0)).write.mode("overwrite").partitionBy("side", "batch").parquet(target)
