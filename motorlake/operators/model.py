"""Price model: split, category encoding, boosted trees, evaluation, scoring.

Categories are encoded by target means held in a table, not in driver memory: free-text
categories such as the trim level may have any number of values. Training rows are
encoded from the other folds only, so no row sees its own price.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.functions import listing as L
from motorlake.functions.rows import as_stored
from motorlake.sources.tables import materialise

FOLDS = 5
SMOOTHING = 10.0
NUMERICS = tuple(c for c in K.FEATURE_ORDER if c not in K.CATEGORICALS)
ENCODED = tuple(f"{c}_enc" for c in K.CATEGORICALS)


# ---------------------------------------------------------------- split

def _split_digest(key: Column, seed: int = K.SPLIT_SEED) -> Column:
    return F.md5(F.concat(key, F.lit(f"|{seed}")))


def is_test(key: Column, share: float = K.TEST_SHARE, seed: int = K.SPLIT_SEED) -> Column:
    """Whether a row belongs to the test part, decided by its own id only."""
    cut = format(int(share * 2**32), "08x")
    return F.substring(_split_digest(key, seed), 1, 8) < cut


def fold_of(key: Column, folds: int = FOLDS, seed: int = K.SPLIT_SEED) -> Column:
    return F.pmod(F.ascii(F.substring(_split_digest(key, seed), 9, 1)), F.lit(folds))


def train_test_split(rows: DataFrame, share: float = K.TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    test = is_test(F.col("id"), share)
    return rows.where(~test), rows.where(test)


# ---------------------------------------------------------------- category encoding

def category_stats(train: DataFrame, label: str = "Log_Price") -> DataFrame:
    """(feature, category, n, s, fold_n[], fold_s[]): label count and sum, all and per fold.

    One scan unrolls the categorical columns, and partial sums shrink the rows to one per
    category and task before the shuffle.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in K.CATEGORICALS]
    )
    rows = train.select(
        fold_of(F.col("id")).alias("fold"), F.col(label).alias("y"), F.inline(pairs)
    )
    folds = [F.when(F.col("fold") == k, F.col("y")) for k in range(FOLDS)]
    return rows.groupBy("feature", "category").agg(
        F.count("*").alias("n"),
        F.sum("y").alias("s"),
        F.array(*[F.count(y) for y in folds]).alias("fold_n"),
        F.array(*[F.coalesce(F.sum(y), F.lit(0.0)) for y in folds]).alias("fold_s"),
    )


def save_encoder(train: DataFrame, path: str, label: str = "Log_Price") -> None:
    """Store the statistics by feature, so that a lookup reads one small folder."""
    stats = category_stats(train, label).hint("rebalance", "feature")
    stats.write.mode("overwrite").partitionBy("feature").parquet(path)


def _encoding(side: str, prior: Column, out_of_fold: bool) -> Column:
    n, s = F.col(f"{side}.n"), F.col(f"{side}.s")
    if out_of_fold:
        n = n - F.get(F.col(f"{side}.fold_n"), F.col("_fold"))
        s = s - F.get(F.col(f"{side}.fold_s"), F.col("_fold"))
    n, s = F.coalesce(n, F.lit(0)), F.coalesce(s, F.lit(0.0))
    return (s + F.lit(SMOOTHING) * prior) / (n + F.lit(SMOOTHING))


def encode_categoricals(
    rows: DataFrame, path: str, out_of_fold: bool, wanted: Sequence[str] = K.CATEGORICALS
) -> DataFrame:
    """Adds one ``<feature>_enc`` column per wanted category; of the other columns those
    are read that the caller goes on to use.

    Each feature joins its own stored statistics, read as a table of its own so that Spark
    knows its size: it broadcasts the small ones, and a large one joins by key, where
    adaptive execution splits a common category.
    """
    def stats(name: str) -> DataFrame:
        return rows.sparkSession.read.parquet(f"{path}/feature={name}")

    # Each feature covers every training row, so the smallest one gives the overall mean.
    prior = stats("Taxed").agg((F.sum("s") / F.sum("n")).alias("prior")).scalar()
    keyed = as_stored(rows, wanted).withColumns({"_prior": prior, "_fold": fold_of(F.col("id"))})
    encoded = keyed.alias("rows")
    for name in wanted:
        side = f"e_{name}"
        match = F.col(name) == F.col(f"{side}.category")
        encoded = encoded.join(stats(name).alias(side), match, "left")
    return encoded.select(
        "rows.*",
        *[
            _encoding(f"e_{name}", F.col("_prior"), out_of_fold).alias(f"{name}_enc")
            for name in wanted
        ],
    ).drop("_prior", "_fold")


# ---------------------------------------------------------------- training, scoring

@dataclass(frozen=True)
class TrainingSettings:
    """Boosting settings. Trees are grown one after another, so the number of rounds is
    kept far below what a single-machine trainer would take."""

    depth: int = K.TREE_DEPTH
    rate: float = K.LEARNING_RATE
    rounds: int = 100
    min_rows_per_leaf: int = 5
    bins: int = 128
    row_share: float = 1.0
    seed: int = K.SPLIT_SEED


def _model_input(rows: DataFrame) -> DataFrame:
    """Numeric features without nulls; the year and motor count may still have them."""
    return rows.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(K.UNKNOWN_NUMBER)) for c in NUMERICS}
    )


# Rows a part of the trainer's input should have, and the most it may have.
PART_ROWS, LARGEST_PART = 10_000, 1_000_000


def trainer_input(rows: DataFrame) -> DataFrame:
    """Stored training rows dealt into even parts, one for every core.

    The trainer caches these parts and passes over them once per round and level. Encoded
    rows compress to a few bytes, so the splits of their files are of any size and number:
    every pass waits for the largest, and each part costs it a set of histograms. Beyond
    ``LARGEST_PART`` rows a part, more rows make more parts.
    """
    total = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(total // PART_ROWS, cores), -(-total // LARGEST_PART))
    return rows.repartition(parts)


def train_price_model(
    train: DataFrame, path: str, settings: TrainingSettings = TrainingSettings()
) -> PipelineModel:
    """Fit on log price; the encoder and the trees are stored under ``path``."""
    save_encoder(train, f"{path}/encoder")
    encoded = _model_input(encode_categoricals(train, f"{path}/encoder", out_of_fold=True))
    assembler = VectorAssembler(inputCols=[*ENCODED, *NUMERICS], outputCol="features")
    trees = GBTRegressor(
        featuresCol="features",
        labelCol="Log_Price",
        predictionCol="log_prediction",
        lossType="squared",
        maxDepth=settings.depth,
        stepSize=settings.rate,
        maxIter=settings.rounds,
        minInstancesPerNode=settings.min_rows_per_leaf,
        maxBins=settings.bins,
        subsamplingRate=settings.row_share,
        seed=settings.seed,
    )
    # The trainer scans its input several times before it caches; give it a stored table
    # instead of the joins.
    needed = encoded.select("Log_Price", *ENCODED, *NUMERICS)
    vectors = trainer_input(materialise(needed, f"{path}/input"))
    model = Pipeline(stages=[assembler, trees]).fit(vectors)
    model.write().overwrite().save(f"{path}/trees")
    return model


def load_price_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/trees")


def predict_price(features: DataFrame, path: str, model: PipelineModel | None = None) -> DataFrame:
    """Adds ``log_prediction`` and ``prediction`` (money) to rows that have an id."""
    if model is None:
        model = load_price_model(path)
    encoded = _model_input(encode_categoricals(features, f"{path}/encoder", out_of_fold=False))
    scored = model.transform(encoded).drop("features", *ENCODED)
    return scored.withColumn("prediction", L.exp_price(F.col("log_prediction")))


def price_estimates(scored: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    return scored.select(*keep, "prediction", L.format_estimate(F.col("prediction")).alias("estimate"))


def training_curve(model: PipelineModel, path: str, rows: DataFrame, out_of_fold: bool = False) -> DataFrame:
    """(iter, RMSE) of the fitted trees on ``rows``: one value per boosting round. With
    ``out_of_fold`` training rows are seen as the trainer saw them, and the error falls."""
    spark: SparkSession = rows.sparkSession
    encoded = _model_input(encode_categoricals(rows, f"{path}/encoder", out_of_fold))
    vectors = model.stages[0].transform(encoded)
    errors = model.stages[1].evaluateEachIteration(vectors, "squared")
    pairs = [(i, float(e) ** 0.5) for i, e in enumerate(errors)]
    return spark.createDataFrame(pairs, "iter int, RMSE double")


# ---------------------------------------------------------------- evaluation

def evaluate_mae_r2(rows: DataFrame, actual: str = "Price", predicted: str = "prediction") -> DataFrame:
    """Mean absolute error and R² in money, in one pass.

    The spread around the mean is a central moment, which Spark merges between tasks
    without losing digits on large values.
    """
    miss = F.col(actual) - F.col(predicted)
    return rows.agg(
        F.avg(F.abs(miss)).alias("mae"),
        (1 - F.sum(miss * miss) / (F.var_pop(actual) * F.count(actual))).alias("r2"),
    )


def rmse_log(
    rows: DataFrame, actual: str = "Log_Price", predicted: str = "log_prediction"
) -> DataFrame:
    return rows.agg(F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2))).alias("rmse"))


def group_mean_model(
    train: DataFrame, rows: DataFrame, keys: Sequence[str] = ("Make", "Year")
) -> DataFrame:
    """Adds the mean log price of the row's group as ``log_prediction``, or the overall
    mean for a group never seen: the yardstick for the trees."""
    groups = train.groupBy(*keys).agg(F.sum("Log_Price").alias("_s"), F.count("Log_Price").alias("_n"))
    overall = groups.agg((F.sum("_s") / F.sum("_n")).alias("m")).scalar()
    if not keys:
        return rows.withColumn("log_prediction", overall)
    return (
        rows.join(groups, list(keys), "left")
        .withColumn("log_prediction", F.coalesce(F.col("_s") / F.col("_n"), overall))
        .drop("_s", "_n")
    )
