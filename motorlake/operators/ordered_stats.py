"""Ordered target statistics: a category is encoded from the rows before it only.

Rows are taken in a hashed permutation of their ids. A row's value for a category is the mean
label of the earlier rows of that category, drawn towards the overall mean, so no row sees
its own label and no folds are needed.

The running sums are made in two steps. The permutation is cut into blocks; a block's total
per category is one row, and sums over blocks give what lies before each block. Inside a
block each category is a window of its own. A category with a third of all rows is thus as
many windows as there are blocks, and the sums before them are as many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.operators.model import SMOOTHING

ROWS_PER_BLOCK = 50_000
_KEYS = ["feature", "category", "no_category"]


def ordered_statistics(rows: DataFrame, features: Sequence[str] = K.CATEGORICALS, label: str = "Log_Price",
                       blocks: int | None = None) -> DataFrame:
    """(id, feature, category, seen, encoded): one row per row and feature.

    ``seen`` is the number of earlier rows of the category with a label. A null category is a
    category like any other. Rows of equal ids follow each other in no stated order. The
    number of blocks follows from the number of rows, the only thing the driver is told
    besides the overall mean; it does not change the result.
    """
    number, prior = rows.agg(F.count("*"), F.avg(label)).first()
    blocks = blocks or number // ROWS_PER_BLOCK + 1
    spot = F.md5(F.col("id").cast("string"))
    block = F.floor(F.conv(F.substring(spot, 1, 8), 16, 10).cast("long") * blocks / F.lit(1 << 32)).cast("int")
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("category"),
                 F.col(c).isNull().alias("no_category"))
        for c in features
    ]
    long = rows.select("id", F.col(label).cast("double").alias("y"), spot.alias("spot"), block.alias("block"),
                       F.inline(F.array(*pairs)))
    totals = long.groupBy(*_KEYS, "block").agg(F.count("y").alias("n"), F.sum("y").alias("s"))
    earlier = Window.partitionBy(*_KEYS).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.select(
        *_KEYS, "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("s_before"),
    )
    inside = Window.partitionBy(*_KEYS, "block").orderBy("spot", "id").rowsBetween(Window.unboundedPreceding, -1)
    local = long.select(
        "id", *_KEYS, "block", F.count("y").over(inside).alias("n"),
        F.coalesce(F.sum("y").over(inside), F.lit(0.0)).alias("s"),
    )
    joined = local.join(heads, [*_KEYS, "block"])
    seen, total = F.col("n") + F.col("n_before"), F.col("s") + F.col("s_before")
    return joined.select(
        "id", "feature", F.when(~F.col("no_category"), F.col("category")).alias("category"), seen.alias("seen"),
        ((total + F.lit(SMOOTHING) * F.lit(prior)) / (seen + F.lit(SMOOTHING))).alias("encoded"),
    )


def encode_ordered(rows: DataFrame, features: Sequence[str] = K.CATEGORICALS, label: str = "Log_Price",
                   blocks: int | None = None) -> DataFrame:
    """(id, <feature>_enc ...): the statistics as one row per id, for ids that occur once."""
    stats = ordered_statistics(rows, features, label, blocks)
    wide = [F.max(F.when(F.col("feature") == c, F.col("encoded"))).alias(f"{c}_enc") for c in features]
    return stats.groupBy("id").agg(*wide)
