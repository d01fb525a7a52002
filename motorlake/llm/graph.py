"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import saved


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Every round hangs all larger neighbours of a node under its smallest one, then all
    smaller neighbours likewise. Each round is two grouped minima, combined before the
    shuffle, and joins by node that Spark splits where a node has very many links. Rounds
    grow with the logarithm of the longest chain; each is stored, and only its count and
    checksum reach the driver. The work ends when a round changes nothing.
    """
    links = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    links, mark = _stored(links, label)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        below = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = below.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        links, now = _stored(small, label)
        if now == mark:
            break
        mark = now
    tops = links.groupBy(F.col("v").alias("node")).agg(F.max("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(tops)


def _stored(rows: DataFrame, label: str):
    rows = saved(rows, label)
    hashed = F.xxhash64("u", "v")
    return rows, tuple(rows.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.shiftright(hashed, 20))).first())
