"""Mixing sources to target weights.

Tokens are summed per source, every source gets a target, and its rate is target over
size. A document is emitted floor(rate) times, and once more where a uniform number hashed
from seed and id lies below the fraction; any number of tasks or reruns gives the same
copies.

Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, 2, ...; they share all
tokens by weight, no target exceeds ``MOST`` times its source, and what is above is shared
again by weight until none is above. That is a water level: with ``level`` tokens per weight
a source gets min(MOST * size, weight * level). Sources live in a table with one row each;
each round is one sum over it, and only sums reach the driver.

Null text counts as empty: size 0, never more than 0 tokens taken. A source of size 0 has
target 0. Rows that share an id share their copies. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import WORD, clean_text, numbered, packed, saved

MOST = 3
SEED = "mix-1"
_DIGITS = 13  # hexadecimal digits of the hash that make the uniform number: 52 bits


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from seed and key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    digits = F.substring(F.md5(name.cast("binary")), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("long").cast("double") / float(16**_DIGITS)


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, weight and target out of rows (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals.withColumn("no_source", F.col("source").isNull()), ["no_source", "source"], "sources")
    rows = ranked.select("source", "source_size", (F.col("position") % 3 + 1).alias("weight"))
    total, weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights = total or 0, weights or 0
    held_tokens = held_weight = 0
    while weights > held_weight:
        # Full: MOST * size / weight is below the level, compared without a division.
        room, open_weight = total - held_tokens, weights - held_weight
        full = F.col("source_size") * (MOST * open_weight) < F.col("weight") * room
        tokens, weight = rows.filter(full).agg(F.sum(F.col("source_size") * MOST), F.sum("weight")).first()
        if (weight or 0) == held_weight:
            break
        held_tokens, held_weight = tokens or 0, weight or 0
    room, open_weight = total - held_tokens, max(1, weights - held_weight)
    full = F.col("source_size") * (MOST * open_weight) < F.col("weight") * room
    target = F.when(full, (F.col("source_size") * MOST).cast("double")).otherwise(
        (F.col("weight") * room).cast("double") / float(open_weight)
    )
    return rows.withColumn("target", target)


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           seed: str = SEED) -> DataFrame:
    """The packed rows with size, source_size, target, rate and copies."""
    rows = packed(docs).select(
        "row",
        F.col(f"row.{key}").alias("doc_id"),
        F.col(f"row.{source}").cast("string").alias("source"),
        word_count(clean_text(f"row.{text}")).alias("size"),
    )
    sizes = saved(rows.groupBy("source").agg(F.sum("size").alias("size")), "sizes")
    goal = targets(sizes).withColumnRenamed("source", "of")
    joined = rows.join(goal, F.col("source").eqNullSafe(F.col("of")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", F.least(rate, F.lit(float(MOST))))
    whole = F.floor("rate")
    extra = uniform(F.col("doc_id"), seed) < F.col("rate") - whole
    return joined.select(
        "row", "doc_id", "source", "size", "source_size", "target", "rate",
        (whole + extra.cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, at most ``MOST`` times."""
    return (
        copies(docs, **columns)
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("row.*")
    )
