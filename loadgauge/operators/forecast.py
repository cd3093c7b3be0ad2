"""Forecasts of the target, one bucket ahead from observed past values.

Boosted trees and the sequence model are fitted once per interval over all series, on values standardised per series, so that fits
are distributed over rows whatever the number of series; the additive model (:mod:`.additive`) has coefficients per series.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import BASELINES, FEATURES, BoostedTreeConfig, SeasonalConfig, SequenceConfig
from ..functions.load import clip_nonnegative
from ..functions.timegrid import minute_index
from ..session import shared_dir, stage
from .additive import AdditiveSeasonal, SeriesModel
from .blocks import POSITION, SERIES_ROWS, attach, home_rows, in_block, row_blocks
from .metrics import backfill_head
from .scaling import scale, scaler_fit, unscale

TARGET = "intensity"
#: Rounds of boosting that are fitted before the first look for the best one, in times of the patience, and rows of a task of the fit.
AHEAD, TASK_ROWS = 1.25, 50_000


class Forecaster(Protocol):
    """What a forecast plug-in offers: tables in, a fitted model or a ``yhat`` column out.

    ``on`` gives the forecaster for tables with these series columns. A model that is no ``PipelineModel`` has a ``save`` of its own, and
    its class, listed in :data:`STORED`, a ``load``.
    """

    name: str

    def on(self, keys: Sequence[str]) -> Forecaster: ...

    def fit(self, train: DataFrame) -> PipelineModel | SeriesModel: ...

    def predict(self, model: PipelineModel | SeriesModel, rows: DataFrame) -> DataFrame: ...


def baseline_forecasts(features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Long predictions of the baselines: the value a bucket, a day or a week before."""
    wide = features.select(
        *keys, "ds", F.col(TARGET).alias("y"), *[F.col(lag).alias(name) for name, lag in BASELINES.items()]
    )
    return wide.unpivot([*keys, "ds", "y"], list(BASELINES), "model", "yhat")


def trend_fit(table: DataFrame, origin: str, keys: Sequence[str] = (), target: str = TARGET) -> DataFrame:
    """Straight line through each series: units per day, and the level at ``origin``."""
    start = minute_index(F.lit(origin).cast("timestamp_ntz"))
    days = (minute_index(F.col("ds")) - start) / F.lit(1440.0)
    return table.groupBy(*keys).agg(
        F.regr_slope(F.col(target), days).alias("slope"), F.regr_intercept(F.col(target), days).alias("intercept")
    )


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the lowest error, looking no further than ``patience`` rounds beyond it, and whether the search ended by that."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model after its first ``n`` rounds."""
    java, jvm = model._java_obj, SparkContext._active_spark_context._jvm
    kind = jvm.java.lang.Class.forName("org.apache.spark.ml.regression.DecisionTreeRegressionModel")
    trees = jvm.java.lang.reflect.Array.newInstance(kind, n)
    weights = SparkContext._active_spark_context._gateway.new_array(jvm.double, n)
    for i, (tree, weight) in enumerate(zip(java.trees()[:n], model.treeWeights[:n])):
        trees[i], weights[i] = tree, weight
    made = jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights, model.numFeatures)
    return model._copyValues(GBTRegressionModel(java.copyValues(made, jvm.org.apache.spark.ml.param.ParamMap())))


class BoostedTree:
    """Gradient-boosted regression trees, cut at the round that is best on the last days of the training part.

    Rounds are fitted ahead, a little more than the patience at first and twice as many while that doesn't run out: what is cut is the same.
    """

    name = "boosted_tree"

    def __init__(self, keys: Sequence[str] = (), cfg: BoostedTreeConfig = BoostedTreeConfig()):
        self.keys, self.cfg = list(keys), cfg

    def on(self, keys: Sequence[str]) -> BoostedTree:
        return BoostedTree(keys, self.cfg)

    def fit(self, train: DataFrame) -> PipelineModel:
        cfg = self.cfg
        last = train.groupBy(*self.keys).agg(F.max("ds").alias("_last"))
        held = F.col("ds") > F.col("_last") - F.make_dt_interval(F.lit(cfg.validation_days))
        marked = attach(train, last, self.keys).withColumn("_held", held).select(*FEATURES, TARGET, "_held")
        marked = stage(marked, "boosted-rows")
        # A round is a chain of short jobs, so a small table should not be spread over many tasks.
        marked = marked.coalesce(max(1, -(-marked.count() // TASK_ROWS)))
        context = marked.sparkSession.sparkContext
        if context.getCheckpointDir() is None:  # a long chain of rounds is cut at files
            context.setCheckpointDir(shared_dir(marked.sparkSession))
        inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        learned, held_out = (inputs.transform(marked.filter(c)) for c in ("NOT _held", "_held"))
        rounds, ended = 0, False
        while not ended and rounds < cfg.rounds:
            rounds = min(cfg.rounds, max(2 * rounds, int(AHEAD * cfg.patience)))
            trees = GBTRegressor(
                labelCol=TARGET,
                predictionCol="yhat",
                maxIter=rounds,
                maxDepth=cfg.max_depth,
                stepSize=cfg.learning_rate,
                subsamplingRate=cfg.row_sample,
                featureSubsetStrategy=cfg.column_sample,
                seed=cfg.seed,
            ).fit(learned)
            best, ended = best_round(trees.evaluateEachIteration(held_out, "squared"), cfg.patience)
        return PipelineModel(stages=[inputs, first_trees(trees, best)])

    def predict(self, model: PipelineModel, rows: DataFrame) -> DataFrame:
        return model.transform(rows).select(*rows.columns, "yhat")


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance) of a fitted boosted tree; one row per feature."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(FEATURES, weights)), "feature string, importance double")


def sequence_windows(
    df: DataFrame, columns: Sequence[str], n: int, keys: Sequence[str] = (), block_rows: int = 8192
) -> DataFrame:
    """Per row the ``n`` feature rows before it, oldest first, as ``window``; the row itself is not in it.

    Rows with fewer than ``n`` before them are left out.  Expects positions.  Rows are counted, so a
    window may span a gap.
    """
    cut = row_blocks(df, n, block_rows)
    before = in_block(keys).rowsBetween(-n, -1)
    row = F.array(*[F.col(c).cast("double") for c in columns])
    built = home_rows(cut.withColumn("window", F.collect_list(row).over(before)))
    return built.filter(F.size("window") == n)


class SequenceRegression:
    """Ridge regression on the flattened window of the last feature rows."""

    name = "sequence"

    def __init__(self, keys: Sequence[str] = (), cfg: SequenceConfig = SequenceConfig()):
        self.keys, self.cfg = list(keys), cfg

    def on(self, keys: Sequence[str]) -> SequenceRegression:
        return SequenceRegression(keys, self.cfg)

    def _windows(self, rows: DataFrame) -> DataFrame:
        windows = sequence_windows(rows, FEATURES, self.cfg.n_lags, self.keys)
        return windows.withColumn("features", array_to_vector(F.flatten("window"))).drop("window")

    def fit(self, train: DataFrame) -> PipelineModel:
        regression = LinearRegression(labelCol=TARGET, predictionCol="yhat", regParam=self.cfg.ridge)
        return Pipeline(stages=[regression]).fit(self._windows(train))

    def predict(self, model: PipelineModel, rows: DataFrame) -> DataFrame:
        """Rows too early for a window take the first prediction, or 0 if the series has none."""
        columns = [c for c in rows.columns if c not in (POSITION, SERIES_ROWS)]
        made = model.transform(self._windows(rows)).select(*columns, "yhat")
        early = rows.filter(F.col(POSITION) < self.cfg.n_lags).select(*columns, F.lit(None).cast("double").alias("yhat"))
        return made.unionByName(early)


def fit_scaled(forecaster: Forecaster, train: DataFrame, keys: Sequence[str] = ()) -> tuple[PipelineModel | SeriesModel, DataFrame]:
    """Fit on standard scores; returns the model and the scaler it needs."""
    forecaster = forecaster.on(keys)
    stats = scaler_fit(train, [*FEATURES, TARGET], keys)
    return forecaster.fit(scale(train, stats, [*FEATURES, TARGET], keys)), stats


def predict_scaled(
    forecaster: Forecaster, model: PipelineModel, stats: DataFrame, rows: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """(series, ds, model, y, yhat) in units of the target, never below 0."""
    scores = forecaster.predict(model, scale(rows, stats, FEATURES, keys))
    made = unscale(scores, stats, "yhat", TARGET, keys)
    if forecaster.name == SequenceRegression.name:
        made = backfill_head(made, keys)
    return made.select(
        *keys,
        "ds",
        F.lit(forecaster.name).alias("model"),
        F.col(TARGET).alias("y"),
        clip_nonnegative(F.col("yhat")).alias("yhat"),
    )


def with_interval(
    predictions: DataFrame, fitted: DataFrame, keys: Sequence[str] = (), z: float = SeasonalConfig.interval_z
) -> DataFrame:
    """Add yhat_lower and yhat_upper from the spread of the residuals on the training part."""
    spread = fitted.groupBy(*keys).agg(F.stddev_pop(F.col("y") - F.col("yhat")).alias("_sigma"))
    wide = attach(predictions, spread, keys)
    reach = F.col("_sigma") * z
    return wide.withColumns({"yhat_lower": F.col("yhat") - reach, "yhat_upper": F.col("yhat") + reach}).drop("_sigma")


#: Models that are stored in a form of their own.
STORED = {AdditiveSeasonal.name: SeriesModel}


def model_path(root: str, model: str, interval: str) -> str:
    return f"{root}/{model}_{interval}"


def save_model(model: PipelineModel, stats: DataFrame, root: str, name: str, interval: str) -> None:
    """One folder per (model, interval): the pipeline and the scaler it was fitted with."""
    path = model_path(root, name, interval)
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(f"{path}/pipeline")
    else:
        model.save(f"{path}/pipeline")
    stats.write.mode("overwrite").parquet(f"{path}/scaler")


def load_model(spark: SparkSession, root: str, name: str, interval: str) -> tuple[PipelineModel, DataFrame]:
    path = model_path(root, name, interval)
    load = STORED[name].load if name in STORED else lambda _, where: PipelineModel.load(where)
    return load(spark, f"{path}/pipeline"), spark.read.parquet(f"{path}/scaler")


def validation_folds(predictions: DataFrame, cutoffs: Sequence[str], days: int) -> DataFrame:
    """Add ``fold``: the test windows [cutoff, cutoff + days) a row belongs to, numbered from 1.

    The part before a fold's cutoff is its training part, so folds expand.  The few folds travel as
    one array literal; a row is copied only into folds it is in.
    """
    folds = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(c).cast("timestamp_ntz").alias("at")) for i, c in enumerate(cutoffs, 1)])
    length = F.make_dt_interval(F.lit(days))
    inside = F.filter(folds, lambda f: (F.col("ds") >= f["at"]) & (F.col("ds") < f["at"] + length))
    return predictions.withColumn("_f", F.explode(inside)).withColumn("fold", F.col("_f.fold")).drop("_f")
