"""The whole pipeline as jobs over stored tables.

Every job reads the tables of the jobs before it under one root folder and writes its own, so each can
be run, repeated and scheduled alone, and a lost executor costs no more than the task it was running.

``Settings.series`` names the columns that tell series apart, the ``name=value`` folders a log's files lie in, e.g.
``logs/server=web1/access.log``.  They are the first columns of every table but the reports, as text; each series is bucketed,
scaled, forecast and planned by itself.  Without them a log is one series.

    access_log/part=train|test       parsed requests
    rejects/part=...                 lines that are no requests, with the reason
    counts/part=.../job=...          lines, rejects and buckets, as the jobs met them
    reports/top_hosts, content       counts of the training part
    load/part=.../interval=...       cleaned load buckets
    features/part=.../interval=...   model input
    models/<model>_<interval>        fitted pipelines and their scalers
    predictions/predictions_<interval>
    leaderboard                      over all series
    backtest/<interval>, finance/<interval>
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import Settings, model_kind
from ..operators import buckets as B, features as FE, finance, forecast as FC, metrics as M, reports as R
from ..operators.blocks import with_position
from ..session import stage
from ..sources import access_log as AL, tables as TB
from . import capacity as CP
from .pipeline import Counts

TRAIN, TEST = "train", "test"
_PART = T.StructField("part", T.StringType())
_INTERVAL = T.StructField("interval", T.StringType())


def _table(spark: SparkSession, root: str, name: str, schema: T.StructType, *partitions: T.StructField) -> DataFrame:
    return TB.read_table(spark, f"{root}/{name}", T.StructType([*schema.fields, *partitions]))


def _keyed(schema: T.StructType, settings: Settings) -> T.StructType:
    return TB.keyed(schema, **{k: T.StringType() for k in settings.series})


def parse(spark: SparkSession, log_path: str, root: str, part: str, settings: Settings = Settings()) -> dict[str, int]:
    """Text log -> access_log, rejects and the counts of both.  Returns how many rows were written.

    Lines are counted in the pass that parses them; a second pass stores the rejected ones if there are any.  A log whose files do
    not lie in folders of all series columns is an error.
    """
    counts, lines = Counts(), AL.read_lines(spark, log_path)
    if missing := [k for k in settings.series if k not in lines.columns]:
        raise ValueError(f"no folders named {missing[0]}=... under {log_path!r}")
    lines = lines.select("value", *[F.col(k).cast("string").alias(k) for k in settings.series])
    rows = AL.access_log(lines, keep=settings.series, seen=lambda fields: counts.lines("parse", fields))
    TB.write_table(rows.withColumn("part", F.lit(part)), f"{root}/access_log", ["part"])
    _store_counts(spark, root, part, "parse", counts)
    n = {measure: n for (_, measure), n in counts.get().items()}
    if n["no_match"] + n["bad_bytes"]:
        TB.write_table(AL.rejects(lines, keep=settings.series).withColumn("part", F.lit(part)), f"{root}/rejects", ["part"])
    return {"parsed": n["parsed"], "without_time": n["bad_time"]}


def _store_counts(spark: SparkSession, root: str, part: str, job: str, counts: Counts) -> None:
    TB.write_table(counts.table(spark).withColumns({"part": F.lit(part), "job": F.lit(job)}), f"{root}/counts", ["part", "job"])


def stored_counts(spark: SparkSession, root: str) -> DataFrame:
    """(stage, measure, n, part, job): what the jobs read, dropped and kept when they last ran."""
    schema = T.StructType([T.StructField("stage", T.StringType()), T.StructField("measure", T.StringType()), T.StructField("n", T.LongType())])
    return _table(spark, root, "counts", schema, _PART, T.StructField("job", T.StringType()))


def access_log(spark: SparkSession, root: str, part: str, settings: Settings = Settings()) -> DataFrame:
    return _table(spark, root, "access_log", _keyed(TB.ACCESS_LOG, settings), _PART).filter(F.col("part") == part).drop("part")


def report(spark: SparkSession, root: str) -> None:
    """Busiest hosts and file types of the training part; each reads the one column it counts."""
    log = access_log(spark, root, TRAIN)
    TB.write_table(R.top_hosts(log), f"{root}/reports/top_hosts")
    TB.write_table(R.content_report(log), f"{root}/reports/content")


def aggregate(spark: SparkSession, root: str, part: str, settings: Settings = Settings()) -> dict[str, int]:
    """access_log -> cleaned load tables of all intervals.  Returns the number of buckets written."""
    counts = Counts()
    load = B.load_all_intervals(access_log(spark, root, part, settings), settings.intervals, settings.series, settings.load)
    kept = B.clean_load(counts.buckets("clean", load, settings.load), settings.load)
    TB.write_table(kept.withColumn("part", F.lit(part)), f"{root}/load", ["part", "interval"])
    _store_counts(spark, root, part, "aggregate", counts)
    return {"buckets": counts.get()["clean", "kept_buckets"]}


def load_table(spark: SparkSession, root: str, part: str, interval: str, settings: Settings = Settings()) -> DataFrame:
    rows = _table(spark, root, "load", _keyed(TB.LOAD, settings), _PART, _INTERVAL)
    return rows.filter((F.col("part") == part) & (F.col("interval") == interval)).drop("part", "interval")


def feature_table(spark: SparkSession, root: str, part: str, interval: str, settings: Settings = Settings()) -> DataFrame:
    rows = _table(spark, root, "features", _keyed(TB.FEATURES, settings), _PART, _INTERVAL)
    return rows.filter((F.col("part") == part) & (F.col("interval") == interval)).drop("part", "interval")


def build_features(spark: SparkSession, root: str, settings: Settings = Settings()) -> None:
    """Load tables -> features; the training part first, its last days are the test part's past."""

    def write(table: DataFrame, part: str, interval: str) -> None:
        rows = table.withColumns({"part": F.lit(part), "interval": F.lit(interval)})
        TB.write_table(rows, f"{root}/features", ["part", "interval"])

    keys = settings.series
    for interval in settings.intervals:
        train = FE.feature_table(load_table(spark, root, TRAIN, interval, settings), interval, keys, settings.features)
        write(train, TRAIN, interval)
        context = FE.context_tail(feature_table(spark, root, TRAIN, interval, settings), keys, settings.features)
        test = load_table(spark, root, TEST, interval, settings)
        write(FE.test_feature_table(context, test, interval, keys, settings.features), TEST, interval)


def forecasters(settings: Settings = Settings()) -> list[FC.Forecaster]:
    keys = settings.series
    return [
        FC.AdditiveSeasonal(settings.seasonal, keys),
        FC.BoostedTree(keys, settings.trees),
        FC.SequenceRegression(keys, settings.sequence),
    ]


def _rows_for(forecaster: FC.Forecaster, table: DataFrame, settings: Settings) -> DataFrame:
    return with_position(table, settings.series) if forecaster.name == FC.SequenceRegression.name else table


def train(
    spark: SparkSession, root: str, settings: Settings = Settings(), models: Sequence[FC.Forecaster] | None = None
) -> None:
    """Fit every model on every interval's training features and store it."""
    for interval in settings.intervals:
        rows = feature_table(spark, root, TRAIN, interval, settings)
        for forecaster in models or forecasters(settings):
            model, stats = FC.fit_scaled(forecaster, _rows_for(forecaster, rows, settings), settings.series)
            FC.save_model(model, stats, f"{root}/models", forecaster.name, interval)


def predict(
    spark: SparkSession, root: str, interval: str, forecaster: FC.Forecaster, horizon: int | None = None, settings: Settings = Settings()
) -> DataFrame:
    """Score a stored model on (the first ``horizon`` rows of each series of) the test features."""
    keys = settings.series
    rows = M.horizon_limit(feature_table(spark, root, TEST, interval, settings), horizon, keys)
    model, stats = FC.load_model(spark, f"{root}/models", forecaster.name, interval)
    return FC.predict_scaled(forecaster.on(keys), model, stats, _rows_for(forecaster, rows, settings), keys)


def evaluate(
    spark: SparkSession, root: str, settings: Settings = Settings(), models: Sequence[FC.Forecaster] | None = None
) -> DataFrame:
    """Predictions of all models and the baselines, and the leaderboard, on the rows all models share."""
    keys, used = settings.series, list(models or forecasters(settings))
    for interval in settings.intervals:
        baselines = FC.baseline_forecasts(feature_table(spark, root, TEST, interval, settings), keys)
        made = [predict(spark, root, interval, f, None, settings).select(*keys, "ds", "y", "model", "yhat") for f in used]
        table = reduce(DataFrame.unionByName, made, baselines)
        TB.write_table(table.select(*keys, *TB.PREDICTIONS.names), f"{root}/predictions/predictions_{interval}")
    stored = M.clip_predictions(predictions(spark, root, settings))
    shared = stage(M.common_rows(stored, keys, len(used) + len(FC.BASELINES)), "shared-rows")
    board = M.leaderboard(M.forecast_metrics(M.warmup_cut(shared, keys)))
    TB.write_table(board, f"{root}/leaderboard")
    return spark.read.parquet(f"{root}/leaderboard")


def predictions(spark: SparkSession, root: str, settings: Settings = Settings()) -> DataFrame:
    return TB.read_predictions(spark, f"{root}/predictions", _keyed(TB.PREDICTIONS, settings))


def recommend(
    spark: SparkSession,
    root: str,
    interval: str = "15min",
    model: str = "xgboost",
    horizon: int | None = None,
    settings: Settings = Settings(),
    **policy,
) -> tuple[DataFrame, dict]:
    """Replica plan for a model's stored forecasts, and the policy it was made with; without forecasts it is an error."""
    used, keys = settings.policy.override(**policy), settings.series
    points = stage(CP.forecast_points(predictions(spark, root, settings), interval, model, horizon, keys), "points")
    if points.isEmpty():
        raise LookupError(f"no stored forecasts of {model!r} at {interval!r}")
    return CP.scaling_recommendation(points, keys, used).drop("policy"), used.__dict__


def simulate(
    spark: SparkSession, root: str, interval: str = "15min", model: str = "prophet", settings: Settings = Settings()
) -> DataFrame:
    """Replay reactive and forecast-based scaling over a model's forecasts; returns the savings report, a row per series.

    Buckets in which any model has no forecast, or no row at all, are left out, as for the leaderboard.  A model without stored
    forecasts at the interval is an error.
    """
    keys = settings.series
    rows = predictions(spark, root, settings).filter(F.col("interval") == interval)
    models = {r.model for r in rows.select("model").distinct().collect()}
    if model_kind(model) not in models:
        raise LookupError(f"no stored forecasts of {model!r} at {interval!r}")
    known = F.when(F.col("y").isNotNull() & F.col("yhat").isNotNull(), F.col("model"))
    complete = rows.groupBy(*keys, "ds").agg(F.count_distinct(known).alias("_models")).filter(F.col("_models") == len(models))
    kept = M.null_safe_join(rows.filter(F.col("model") == model_kind(model)), complete.drop("_models"), [*keys, "ds"])
    table = stage(kept.select(*keys, "ds", "y", "yhat"), "replay")
    backtest = CP.strategy_backtest(table, keys, settings.policy).select(*keys, *CP.BACKTEST)
    TB.write_table(backtest, f"{root}/backtest/{interval}")
    stored = spark.read.parquet(f"{root}/backtest/{interval}")
    TB.write_table(finance.strategy_totals(stored, keys), f"{root}/finance/{interval}")
    return finance.savings_report(stored, keys)


def _by_interval(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table stored per interval in folders of that name, with ``interval``."""
    found = spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}/*")
    return found.withColumn("interval", F.regexp_extract(F.col("_metadata.file_path"), rf"/{name}/([0-9]+min)/", 1))


def register_views(spark: SparkSession, root: str, settings: Settings = Settings()) -> None:
    """Make the stored tables queryable with Spark SQL under their own names; replays and the leaderboard once they are stored."""
    _table(spark, root, "access_log", _keyed(TB.ACCESS_LOG, settings), _PART).createOrReplaceTempView("access_log")
    _table(spark, root, "load", _keyed(TB.LOAD, settings), _PART, _INTERVAL).createOrReplaceTempView("load")
    _table(spark, root, "features", _keyed(TB.FEATURES, settings), _PART, _INTERVAL).createOrReplaceTempView("features")
    predictions(spark, root, settings).createOrReplaceTempView("predictions")
    stored_counts(spark, root).createOrReplaceTempView("counts")
    later = {"leaderboard": lambda: spark.read.parquet(f"{root}/leaderboard"), **{n: lambda n=n: _by_interval(spark, root, n) for n in ("backtest", "finance")}}
    for name, read in later.items():
        try:
            read().createOrReplaceTempView(name)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
