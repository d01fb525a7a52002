"""Helpers the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motorlake.session import new_folder

# The white space the contracts name, and the words between.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(rows: DataFrame, label: str, level: int = 3) -> DataFrame:
    """Write rows to the folder all executors share and read them back.

    Cuts the lineage: an executor lost later costs a re-read, not a recomputation, and
    values such as row numbers stay what they were. ``level`` is that of the compression.
    """
    path = new_folder(rows.sparkSession, label)
    writer = rows.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level)
    writer.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def clean_text(text: str | Column = "text") -> Column:
    """The text as string; a null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``; a null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus


def packed(docs: DataFrame) -> DataFrame:
    """One struct column ``row``: columns an operator adds cannot clash with the caller's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def keyed(docs: DataFrame, label: str, **columns: Column) -> DataFrame:
    """The packed rows with ``row_id``, unique and fixed because the table is stored.

    ``columns`` are computed from the packed row (``row.text``) and stored beside it.
    """
    rows = packed(docs).withColumns(columns) if columns else packed(docs)
    return saved(rows.withColumn("row_id", F.monotonically_increasing_id()), label)


_LOCAL = (1 << 33) - 1


def placed(rows: DataFrame, label: str, position: str = "position", level: int = 3) -> DataFrame:
    """Rows numbered from 0 without a gap, in the order of their partitions, and stored.

    Every task numbers its own rows; the offsets, one row per task of that job, are summed
    up in one window and sent to all. They never hold more rows than the job had tasks.
    """
    ids = rows.withColumn("__id", F.monotonically_increasing_id())
    rows = saved(
        ids.withColumn("__task", F.shiftright("__id", 33)).withColumn(
            "__local", F.col("__id").bitwiseAND(F.lit(_LOCAL))
        ).drop("__id"),
        label,
        level,
    )
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("__task").agg(F.count("*").alias("n"))
    offset = counts.select("__task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return rows.join(F.broadcast(offset), "__task").withColumn(
        position, F.col("__start") + F.col("__local")
    ).drop("__task", "__start", "__local")


def numbered(rows: DataFrame, order: list[str], label: str, position: str = "position") -> DataFrame:
    """Rows numbered from 0 in the order of the given columns.

    A range exchange and a sort inside each range: no single task sees all rows. Pass keys
    without repeats; equal keys meet in one range.
    """
    keys = [F.col(c) for c in order]
    return placed(rows.repartitionByRange(*keys).sortWithinPartitions(*keys), label, position)
