"""Price trees grown until a validation part stops gaining, with the trainer's own log."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.operators import model
from motorlake.sources import tables

SHARE = 0.1


def train_validated(
    train: DataFrame, path: str, settings: model.TrainingSettings = model.TrainingSettings(), share: float = SHARE
) -> PipelineModel:
    """Fit on log price and keep the rounds up to the least validation error.

    A share of the rows, chosen by a hash of the id, is held out: the encoder and the trees
    do not learn from it. The trainer measures it after every round, stops when its error no
    longer falls, and drops the rounds behind the best one. ``path`` gets the encoder, the
    trees and the log: (iter, RMSE) of the validation part, a row per round kept.
    """
    held = model.is_test(F.col("id"), share, K.SPLIT_SEED + 1)
    fitting, validation = train.where(~held), train.where(held)
    encoder, names = f"{path}/encoder", [*model.ENCODED, *model.NUMERICS]
    model.save_encoder(fitting, encoder)
    both = [
        model._model_input(model.encode_categoricals(rows, encoder, out_of_fold)).select(
            "Log_Price", *names, F.lit(not out_of_fold).alias("validation")
        )
        for rows, out_of_fold in ((fitting, True), (validation, False))
    ]
    # The trainer scans its input several times: a stored table instead of the joins.
    vectors = model.trainer_input(tables.materialise(both[0].unionByName(both[1]), f"{path}/input"))
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
        validationIndicatorCol="validation",
        validationTol=0.0,
    )
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    fitted = Pipeline(stages=[assembler, trees]).fit(vectors)
    fitted.write().overwrite().save(f"{path}/trees")
    seen = fitted.stages[0].transform(vectors.where("validation"))
    errors = fitted.stages[1].evaluateEachIteration(seen, "squared")
    pairs = [(i, float(e) ** 0.5) for i, e in enumerate(errors)]  # a row per round
    log = train.sparkSession.createDataFrame(pairs, "iter int, RMSE double")
    tables.write_tsv(log.coalesce(1), f"{path}/log")
    return fitted


def fitted_curve(train: DataFrame, path: str) -> DataFrame:
    """(iter, RMSE, best): the log of a model stored at ``path``."""
    curve = tables.learning_curve(train.sparkSession, f"{path}/log")
    best = tables.best_iteration(curve).select("best_iter").scalar()
    return curve.select("iter", "RMSE", (F.col("iter") == best).alias("best"))
