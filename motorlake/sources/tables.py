"""Reading, creating and replacing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from motorlake import constants as K
from motorlake import schemas


def scan_table(spark: SparkSession, source: str) -> DataFrame:
    """A stored table by path or catalog name; Catalyst prunes its columns."""
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)


# Fixed value: rows of heavy work a task should get at most.
ROWS_A_TASK = 250_000


def spread_scan(rows: DataFrame) -> DataFrame:
    """A stored table ahead of heavy per-row work: a task for every core, and more of them
    where rows are many.

    Splits follow bytes, and short rows compress well: one split may be millions of rows,
    and one small file keeps one core busy. A table that already comes in enough splits
    passes through untouched. For plain scans: counting their rows reads no column.
    """
    if rows.isStreaming:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-rows.count() // ROWS_A_TASK))
    if rows.rdd.getNumPartitions() >= wanted:
        return rows
    return rows.repartition(wanted)


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> None:
    """Create an empty parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def ensure_listing_tables(spark: SparkSession, root: str | None = None) -> None:
    """The three stored tables items, cars and tags, below ``root`` or in the warehouse."""
    for name, schema in (("items", schemas.ITEMS), ("cars", schemas.CARS), ("tags", schemas.TAGS)):
        ensure_table(spark, name, schema, f"{root}/{name}" if root else None)


def write_replace(rows: DataFrame, target: str) -> None:
    """Replace a table (catalog name) or folder (path) with these rows."""
    if "/" in target:
        rows.write.mode("overwrite").parquet(target)
    else:
        rows.write.mode("overwrite").format("parquet").saveAsTable(target)


def write_bucketed(
    rows: DataFrame, name: str, key: str, buckets: int, location: str | None = None
) -> None:
    """Store a catalog table bucketed by ``key``.

    Cars bucketed by id and tags by car id, with the same number of buckets, are pivoted
    and joined without any shuffle.
    """
    place = {"path": location} if location else {}
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(
        name, format="parquet", **place
    )


def materialise(rows: DataFrame, path: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cuts the lineage and gives
    the planner true sizes."""
    write_replace(rows, path)
    return rows.sparkSession.read.parquet(path)


# ---------------------------------------------------------------- tab-separated files

def _tsv_options(multiline: bool) -> dict[str, object]:
    return {
        "sep": "\t",
        "header": True,
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def missing_to_null(rows: DataFrame) -> DataFrame:
    """String cells that spell "missing" as nulls."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    return rows.withColumns(
        {c: F.when(~F.col(f"`{c}`").isin(*K.NA_TOKENS), F.col(f"`{c}`")) for c in texts}
    )


def read_tsv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Tab-separated text with header; string cells that spell "missing" become null.

    The schema is given, so no pass over the data infers it. ``multiline`` allows line
    breaks inside quotes, at the price that a file is read by one task.
    """
    reader = spark.read.schema(schema).options(enforceSchema=False, **_tsv_options(multiline))
    return missing_to_null(reader.csv(path))


def write_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").options(**_tsv_options(False)).csv(path)


def export_training_tsv(unified: DataFrame, path: str) -> None:
    """The wide car table without the columns training never reads.

    Booleans go out as 0/1, which the feature step expects of ``taxed``.
    """
    kept = unified.drop("currency", "original_price_text", "scraped_at")
    flags = {
        f.name: F.col(f.name).cast("int")
        for f in kept.schema
        if isinstance(f.dataType, T.BooleanType)
    }
    write_tsv(kept.withColumns(flags) if flags else kept, path)


def learning_curve(spark: SparkSession, path: str) -> DataFrame:
    """(iter, RMSE) rows of a training log."""
    return spark.read.schema(schemas.LEARNING_CURVE).options(**_tsv_options(False)).csv(path)


def best_iteration(curve: DataFrame) -> DataFrame:
    """Iteration with the lowest error, the earliest of equals."""
    best = F.min(F.struct("RMSE", "iter"))
    return curve.agg(best.alias("b")).select(
        F.col("b.iter").alias("best_iter"), F.col("b.RMSE").alias("best_rmse")
    )


def cached_reference_data(rows: DataFrame) -> DataFrame:
    """Keep menu inputs for the session; spills to disk, and a lost block is recomputed.

    Spark matches caches by plan, so asking again for the same rows reuses the first one.
    """
    return rows.persist(StorageLevel.MEMORY_AND_DISK)
