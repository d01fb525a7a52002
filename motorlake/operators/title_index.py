"""Search in titles by an inverted index of trigrams.

The index holds, for every three characters in a row of a folded title, the places of the
rows that contain them. A search for a text cuts its literal stretches into trigrams,
intersects their lists, and tests the exact pattern on the rows that are left. A pattern
without three literal characters in a row reads all titles, as a scan does.

Rows are stored in arrival order (``positions``); a list covers ``BLOCK`` places of one
folder, so the list of a trigram that a third of all titles contain is many bounded rows.
Lists lie in folders by a hash of their trigram: a search opens those of its trigrams.
"""

from __future__ import annotations

import re
import string
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.functions.text import contains_like, fold_ascii
from motorlake.operators import positions
from motorlake.session import new_folder
from motorlake.sources.tables import materialise

BLOCK = 1 << 14
BUCKETS = 64
_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters of the folded text; none where it is shorter."""
    folded = fold_ascii(text)
    starts = F.sequence(F.lit(1), F.greatest(F.length(folded) - 2, F.lit(1)))
    runs = F.array_distinct(F.transform(starts, lambda i: F.substring(folded, i, F.lit(3))))
    return F.when(F.length(folded) >= 3, runs)


def literal_trigrams(wanted: str) -> set[str]:
    """The trigrams every match of ``%wanted%`` contains."""
    stretches = re.split("[%_]", wanted.translate(_FOLD))
    return {s[i : i + 3] for s in stretches for i in range(len(s) - 2)}


def build(items: DataFrame, path: str, buckets: int = BUCKETS, block: int = BLOCK, title: str = "l_text") -> None:
    """Store the items in arrival order and the lists of their titles' trigrams.

    A task reads places in order, so most of a list is put together before the shuffle.
    """
    spark = items.sparkSession
    positions.store_in_order(items, path, [F.col("ingest_seq").asc_nulls_first(), F.col("id")])
    rows = positions.stored(spark, path)
    grams = rows.select("page_part", "place", F.explode(trigrams(F.col(title))).alias("gram"))
    part = F.floor(F.col("place") / block).alias("block")
    lists = grams.groupBy("gram", "page_part", part).agg(F.sort_array(F.collect_list("place")).alias("places"))
    dealt = lists.withColumn("bucket", (F.crc32("gram") % buckets).cast("int"))
    dealt.repartitionByRange("bucket", "gram", "page_part", "block").sortWithinPartitions("bucket", "gram").write.mode(
        "overwrite"
    ).partitionBy("bucket").parquet(f"{path}/lists")
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(f"{path}/form")


def candidates(spark: SparkSession, path: str, grams: set[str]) -> DataFrame:
    """(page_part, place) of the rows that contain all the trigrams."""
    buckets = spark.read.parquet(f"{path}/form").first().buckets
    lists = spark.read.schema("gram string, page_part int, block long, places array<long>, bucket int").parquet(
        f"{path}/lists"
    )
    wanted = F.col("bucket").isin(sorted({zlib.crc32(g.encode()) % buckets for g in grams})) & F.col("gram").isin(sorted(grams))
    met = lists.where(wanted).groupBy("page_part", "block").agg(F.collect_list("places").alias("lists"))
    whole = met.where(F.size("lists") == len(grams))  # a block one trigram is missing from has no match
    shared = F.aggregate(F.slice("lists", 2, len(grams)), F.element_at("lists", 1), F.array_intersect)
    return whole.select("page_part", F.explode(shared).alias("place"))


def find(spark: SparkSession, path: str, wanted: str, title: str = "l_text") -> DataFrame:
    """The items whose title contains ``wanted``: the same rows as ``filter_title_like``."""
    rows = positions.stored(spark, path)
    grams = literal_trigrams(wanted)
    if grams:
        found = materialise(candidates(spark, path, grams), new_folder(spark, "title-candidates"))
        parts = [r.page_part for r in found.select("page_part").distinct().collect()]  # folders, not rows
        rows = rows.where(F.col("page_part").isin(parts)).join(found, ["page_part", "place"], "left_semi")
    if wanted:
        rows = rows.where(contains_like(F.col(title), wanted))
    return rows.drop("page_part", "place")
