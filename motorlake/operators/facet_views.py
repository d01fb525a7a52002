"""Facet counts that are kept by change, and facet trees in parts of bounded length.

The view is a log of changes: a row (make, model, n) per batch, n positive for models that
gained items and negative for those that lost some. The first entry is a full count. A batch
reads the buckets of the items its ids fall in, takes back the old make and model of every
item it replaces and adds the new. Counts are the sums of the log; ``compact`` replaces the
log by its sums. Items without an id are left out, as in every keyed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.operators import ingest, positions
from motorlake.operators.facets import _makes_and_models, make_model_counts
from motorlake.session import new_folder
from motorlake.sources.tables import materialise, write_replace

BUCKETS = 64
PART = 1000
_LOG = "make string, model string, n long, batch int"


def start(items: DataFrame, root: str, buckets: int = BUCKETS, position: str = "ingest_seq") -> None:
    """Store the items in buckets by id and their counts as batch 0."""
    rows = materialise(ingest.last_wins(items, ["id"], F.col(position)), new_folder(items.sparkSession, "facet-items"))
    ingest.store_in_buckets(rows, f"{root}/items", ["id"], buckets)
    write_replace(make_model_counts(rows), f"{root}/changes/batch=0")


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(make, model, n): what replacing ``old`` by ``new`` does to the counts."""
    signed = _makes_and_models(old).withColumn("n", F.lit(-1)).unionByName(
        _makes_and_models(new).withColumn("n", F.lit(1))
    )
    return signed.groupBy("make", "model").agg(F.sum("n").alias("n")).where("n <> 0")


def apply_batch(batch: DataFrame, root: str, number: int, buckets: int = BUCKETS, position: str = "ingest_seq") -> None:
    """Batch ``number`` (from 1, one after the other): changes first, then the items.

    Both are derived from the items before this batch, so a batch that is run again, after a
    lost run or a finished one, writes what it wrote before.
    """
    spark = batch.sparkSession
    latest = materialise(ingest.last_wins(batch, ["id"], F.col(position)), new_folder(spark, "facet-batch"))
    before = ingest.touched_rows(spark, f"{root}/items", latest, ["id"], buckets, number)
    old = before.join(latest.select("id"), "id", "left_semi")
    write_replace(changes(old, latest), f"{root}/changes/batch={number}")
    ingest.upsert_in_place(f"{root}/items", latest, ["id"], position, buckets, number)


def counts(spark: SparkSession, root: str) -> DataFrame:
    """(make, model, n) of the items as they are now."""
    log = spark.read.schema(_LOG).parquet(f"{root}/changes")
    return log.groupBy("make", "model").agg(F.sum("n").alias("n")).where("n <> 0")


def compact(spark: SparkSession, root: str, target: str) -> None:
    """The view's counts as batch 0 of a new log under ``target``; its items stay in place."""
    write_replace(counts(spark, root), f"{target}/changes/batch=0")


def tree_in_parts(makes_and_models: DataFrame, size: int = PART) -> DataFrame:
    """(name, count, part, models[(name, count)]) from (make, model, n): part k of a make holds
    its models number k * size to (k + 1) * size in the order of their names.

    The models are stored in order by a range exchange and numbered by ``positions``; no array
    is longer than ``size``, however many models a make has.
    """
    spark = makes_and_models.sparkSession
    path = new_folder(spark, "facet-parts")
    order = [F.col("make").asc_nulls_first(), F.col("model").asc_nulls_first()]
    positions.store_in_order(makes_and_models.select("make", "model", "n"), path, order)
    rows = positions.with_positions(spark, path)
    makes = rows.groupBy("make").agg(F.min("position").alias("first"), F.sum("n").alias("count"))
    inside = rows.join(makes.withColumnRenamed("make", "name"), F.col("make").eqNullSafe(F.col("name")))
    part = F.floor((F.col("position") - F.col("first")) / size).alias("part")
    entry = F.struct("position", F.col("model").alias("name"), F.col("n").alias("count"))
    parts = inside.groupBy("name", "count", part).agg(F.sort_array(F.collect_list(entry)).alias("models"))
    plain = F.transform("models", lambda m: F.struct(m["name"].alias("name"), m["count"].alias("count")))
    return parts.select("name", "count", "part", plain.alias("models"))
