"""Every operator as a query over the sample tables.

Each entry takes (spark, folder) and returns a DataFrame.  ``events`` plays the access log, one series
per ``site``.  Doubles are rounded so that results can be compared between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import (
    BASELINES,
    FEATURES,
    INTERVALS,
    WARMUP_ROWS_COMPAT,
    LoadConfig,
    ScalingPolicy,
    SeasonalConfig,
)
from ..functions import capacity as C, load as L, logline as G
from ..functions.timegrid import minute_index, to_timestamp
from ..operators import additive as AD, anomaly, buckets as B, features as FE, finance, forecast as FC, metrics as M, outages as OU, reports as R, scaling as S
from ..operators.blocks import POSITION, with_position
from ..operators.policy import of, policy_join, with_policy
from ..session import new_path, stage
from ..sources import access_log as AL, adapters as A, tables as TB
from ..streaming import load as SL, stateful as ST
from . import capacity as CP, pipeline as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CFG = LoadConfig(outages=A.OUTAGES)
POLICY = ScalingPolicy(server_capacity=5000.0)
INTERVAL = "15min"
SITE = ["site"]
ORIGIN = "2024-01-01 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType == T.DoubleType()})


def rounded_means(df: DataFrame) -> DataFrame:
    """Four digits after a nudge that makes exact halves, which means often are, round up everywhere."""
    return rounded(df.withColumns({f.name: F.col(f.name) + 1e-7 for f in df.schema.fields if f.dataType == T.DoubleType()}))


def load(spark: SparkSession, d: str, keys=SITE, interval: str = INTERVAL) -> DataFrame:
    return B.load_by_interval(A.events_log(spark, d), interval, keys, CFG)


def clean(spark: SparkSession, d: str, keys=SITE, interval: str = INTERVAL) -> DataFrame:
    return B.clean_load(load(spark, d, keys, interval), CFG)


def raw_features(spark: SparkSession, d: str, keys=SITE) -> DataFrame:
    return FE.raw_features(clean(spark, d, keys), INTERVAL, keys)


def features(spark: SparkSession, d: str, keys=SITE, interval: str = INTERVAL) -> DataFrame:
    return P.features_of(A.events_log(spark, d), interval, keys, CFG)


def train_test(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return P.train_test_features(A.events_log(spark, d), A.SPLIT, INTERVAL, SITE, CFG)


def baselines(spark: SparkSession, d: str) -> DataFrame:
    """Long predictions of the baselines, stored."""
    made = FC.baseline_forecasts(features(spark, d), SITE)
    return stage(P.with_interval_name(made, INTERVAL), "predictions")


def day_forecast(spark: SparkSession, d: str) -> DataFrame:
    """(site, ds, y, yhat) with yesterday's value as forecast, stored."""
    made = features(spark, d).select("site", "ds", F.col("intensity").alias("y"), F.col("lag_24h").alias("yhat"))
    return stage(made, "forecast")


def backtest(spark: SparkSession, d: str) -> DataFrame:
    return CP.strategy_backtest(day_forecast(spark, d), SITE, POLICY)


def look_back(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.look_back(with_position(day_forecast(spark, d), SITE), SITE)


# --- sources and sinks -------------------------------------------------------------------------


@query
def access_log_parse(spark, d):
    return AL.access_log(A.events_lines(spark, d))


@query
def access_log_rejects(spark, d):
    return AL.rejects(A.mixed_lines(spark, d)).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@query
def row_counts(spark, d):
    return AL.line_counts(A.mixed_lines(spark, d))


@query
def pipeline_counts(spark, d):
    """What each stage read, dropped and kept on the way from the lines of a log to test features."""
    counts = P.Counts()
    log = AL.access_log(A.mixed_lines(spark, d), seen=lambda fields: counts.lines("log", fields))
    log = stage(log.withColumn("site", A.site_of(F.col("host"))), "counted-log")
    # The test part's log starts a day before the training part's ends.
    overlap = F.lit(A.SPLIT).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    parts = {"train": FE.time_split(log, A.SPLIT, "timestamp")[0], "test": log.filter(F.col("timestamp") >= overlap)}
    loads = [stage(counts.buckets(name, B.load_by_interval(part, INTERVAL, SITE, CFG), CFG), "counted-load") for name, part in parts.items()]
    train, test = (B.clean_load(load, CFG).select("site", "ds", "intensity") for load in loads)
    joined = FE.context_union(counts.rows("context", FE.context_tail(train, SITE)), counts.rows("own", test), SITE)
    stage(counts.rows("series", joined), "counted-series")
    return counts.table(spark)


@query
def table_scan(spark, d):
    path = new_path(spark, "load-csv")
    TB.write_table(load(spark, d, []), path, fmt="csv")
    return rounded(TB.read_table(spark, path, TB.LOAD, "csv"))


@query
def table_sink(spark, d):
    path = new_path(spark, "load")
    tables = B.clean_load(B.load_all_intervals(A.events_log(spark, d), list(INTERVALS), SITE, CFG), CFG)
    split = F.when(F.col("ds") < F.lit(A.SPLIT).cast("timestamp_ntz"), "train").otherwise("test")
    TB.write_table(tables.withColumn("split", split), path, ["split", "interval"])
    back = TB.read_table(spark, path, T.StructType([*TB.keyed(TB.LOAD, site=T.IntegerType()).fields,
                                                    T.StructField("split", T.StringType()),
                                                    T.StructField("interval", T.StringType())]))
    return back.groupBy("split", "interval", "site").agg(
        F.count(F.lit(1)).alias("buckets"), F.sum("y").alias("requests"), F.sum("total_bytes").alias("total_bytes")
    )


@query
def prediction_file_scan(spark, d):
    folder = new_path(spark, "predictions")
    for interval, table in P.features_by_interval(A.events_log(spark, d), INTERVALS, SITE, CFG).items():
        made = FC.baseline_forecasts(table, SITE)
        TB.write_table(made, f"{folder}/predictions_{interval}")
    return rounded(TB.read_predictions(spark, folder, TB.keyed(TB.PREDICTIONS, site=T.IntegerType())))


# --- projections and predicates ----------------------------------------------------------------


@query
def normalize_time(spark, d):
    parsed = AL.parse_lines(A.events_lines(spark, d), keep=("event_id",))
    return parsed.select("event_id", "timestamp_text", G.normalize_time(F.col("timestamp_text")).alias("timestamp"))


@query
def cast_measures(spark, d):
    return AL.parse_lines(A.events_lines(spark, d), keep=("event_id",)).select("event_id", "status", "bytes")


@query
def request_extension(spark, d):
    requests = A.pages_log(spark, d).unionByName(A.events_log(spark, d).select("request"))
    return requests.select("request", G.request_extension(F.col("request")).alias("file_type"))


@query
def error_rate(spark, d):
    return load(spark, d).select("site", "ds", F.round("error_rate", 6).alias("error_rate"))


@query
def intensity(spark, d):
    return rounded(load(spark, d).select("site", "ds", "y", "avg_bytes", "intensity"))


@query
def downtime_flag(spark, d):
    return load(spark, d, []).select("ds", "is_downtime")


@query
def outage_table(spark, d):
    """Buckets flagged by outages of each site that overlap: every tenth kind of error is one of so many minutes."""
    table = OU.flag_outages(load(spark, d), A.error_outages(spark, d), SITE)
    return rounded(table.select("site", "ds", "y", "intensity", "is_downtime"))


@query
def exclude_downtime(spark, d):
    return B.cleaning_counts(load(spark, d), SITE, CFG)


@query
def bot_filter(spark, d):
    return rounded(B.bot_filter(load(spark, d, []), CFG).select("ds", "y", "error_rate"))


@query
def fill_zero(spark, d):
    return rounded(raw_features(spark, d).select("site", "ds", *FE.LAG_COLUMNS).na.fill(0))


@query
def drop_null(spark, d):
    kept = raw_features(spark, d).na.drop(subset=["intensity", "lag_24h", "roll_mean_4h"])
    return rounded(kept.select("site", "ds", "intensity", "lag_7d"))


@query
def clip_nonnegative(spark, d):
    swing = F.col("lag_1step") - F.col("lag_24h")
    rows = raw_features(spark, d).select("site", "ds", swing.alias("swing"))
    return rounded(rows.withColumn("yhat", L.clip_nonnegative(F.col("swing"))))


@query
def prune_columns(spark, d):
    return rounded(clean(spark, d, []).select("ds", "intensity"))


@query
def time_split(spark, d):
    before, after = FE.time_split(features(spark, d).select("site", "ds", "intensity"), A.SPLIT)
    return rounded(before.withColumn("split", F.lit("train")).unionByName(after.withColumn("split", F.lit("test"))))


@query
def context_tail(spark, d):
    before, _ = FE.time_split(A.events_log(spark, d), A.SPLIT, "timestamp")
    return rounded(FE.context_tail(stage(P.features_of(before, INTERVAL, SITE, CFG), "features"), SITE))


@query
def positive_actual_mask(spark, d):
    made = FC.baseline_forecasts(features(spark, d), SITE)
    y = F.col("y")
    return rounded(
        made.groupBy("site", "model").agg(
            F.count_if(y > 0).alias("positive_rows"), M.positive_mape(y, F.col("yhat")).alias("mape")
        )
    )


@query
def anomaly_rows(spark, d):
    return rounded(anomaly.anomaly_rows(look_back(spark, d)).select("site", "ds", "y", "yhat"))


# --- joins -------------------------------------------------------------------------------------


@query
def spine_join(spark, d):
    return rounded(B.spine_join(stage(clean(spark, d), "load"), INTERVAL, SITE))


@query
def predictions_align(spark, d):
    table = stage(features(spark, d), "features")
    made = FC.baseline_forecasts(table, SITE).drop("y")
    actual = table.select("site", "ds", F.col("intensity").alias("y"))
    return rounded(M.predictions_align(actual, made, SITE).select("site", "ds", "model", "y", "yhat"))


@query
def share_of_total(spark, d):
    counts = A.events_log(spark, d).groupBy("host").agg(F.count(F.lit(1)).alias("request_count"))
    return rounded(R.share_of_total(counts))


@query
def apply_scaler(spark, d):
    train, test = train_test(spark, d)
    stats = S.scaler_fit(train, FEATURES, SITE)
    return rounded(S.scale(test, stats, FEATURES, SITE).select("site", "ds", *FEATURES))


def overrides(spark: SparkSession, d: str) -> DataFrame:
    """Policies per site: its own capacity on odd sites, a shorter cooldown on site 2."""
    size = F.floor(F.sum("bytes") / 1000)
    return (
        A.events_log(spark, d)
        .groupBy("site")
        .agg(
            F.when(F.col("site") % 2 == 1, size).alias("server_capacity"),
            F.when(F.col("site") == 2, 1).alias("cooldown_period"),
        )
    )


@query
def policy_join_query(spark, d):
    sites = A.events_log(spark, d).select("site").distinct()
    return policy_join(sites, overrides(spark, d), SITE, POLICY).select(
        "site", *[of(c).alias(c) for c in ("server_capacity", "cooldown_period", "max_replicas", "buffer_ratio")]
    )


# --- aggregations ------------------------------------------------------------------------------


@query
def load_by_interval(spark, d):
    """From printed lines to load buckets of the whole server."""
    return rounded(B.load_by_interval(AL.access_log(A.events_lines(spark, d)), INTERVAL, [], CFG))


@query
def load_by_interval_keyed(spark, d):
    return rounded(load(spark, d))


@query
def status_class_counts(spark, d):
    status = F.col("status")
    return A.events_log(spark, d).groupBy("site").agg(
        F.count_if(L.is_client_error(status)).alias("error_4xx"), F.count_if(L.is_server_error(status)).alias("error_5xx")
    )


@query
def load_long_gaps(spark, d):
    """Hourly load per host; after more than one day without requests of a host the grid starts anew."""
    cfg = replace(CFG, max_gap_days=1)
    return B.load_by_interval(A.events_log(spark, d), "60min", ["host"], cfg).select("host", "ds", "y", "total_bytes")


@query
def load_all_intervals(spark, d):
    tables = B.load_all_intervals(A.events_log(spark, d), ["1min", "5min", "15min"], [], CFG)
    return rounded(B.clean_load(tables, CFG))


@query
def top_hosts(spark, d):
    return rounded(R.top_hosts(A.events_log(spark, d)))


@query
def content_report(spark, d):
    requests = A.pages_log(spark, d).unionByName(A.events_log(spark, d).select("request"))
    return R.content_report(requests)


def scored(spark: SparkSession, d: str) -> DataFrame:
    kept = M.warmup_cut(M.clip_predictions(baselines(spark, d)), SITE)
    return M.forecast_metrics(kept)


@query
def forecast_metrics(spark, d):
    return rounded_means(scored(spark, d))


@query
def forecast_metrics_compat_warmup(spark, d):
    kept = M.warmup_cut(M.clip_predictions(baselines(spark, d)), SITE, WARMUP_ROWS_COMPAT)
    return rounded_means(M.forecast_metrics(kept, ["site", "interval", "model"]))


@query
def leaderboard(spark, d):
    tables = P.features_by_interval(A.events_log(spark, d), INTERVALS, SITE, CFG)
    parts = [P.with_interval_name(FC.baseline_forecasts(table, SITE), interval) for interval, table in tables.items()]
    made = stage(M.clip_predictions(reduce(DataFrame.unionByName, parts)), "predictions")
    return M.leaderboard(rounded_means(M.forecast_metrics(M.warmup_cut(made, SITE))))


@query
def strategy_totals(spark, d):
    return rounded(finance.strategy_totals(backtest(spark, d), SITE))


@query
def savings_report(spark, d):
    return rounded(finance.savings_report(backtest(spark, d), SITE))


@query
def sla_report(spark, d):
    return rounded(finance.sla_report(backtest(spark, d), SITE))


@query
def forecast_mae(spark, d):
    points = CP.forecast_points(baselines(spark, d), INTERVAL, "seasonal_day", 200, SITE)
    return rounded(M.forecast_mae(points, SITE))


@query
def scaler_fit(spark, d):
    return rounded(S.scaler_fit(features(spark, d), ["intensity", *FEATURES], SITE))


# --- windows -----------------------------------------------------------------------------------


@query
def lag_features(spark, d):
    return rounded(raw_features(spark, d).select("site", "ds", "intensity", *FE.LAG_COLUMNS))


@query
def rolling_features(spark, d):
    return rounded(raw_features(spark, d).select("site", "ds", *FE.ROLL_COLUMNS))


@query
def calendar_features(spark, d):
    return rounded(FE.calendar_features(load(spark, d, []).select("ds")))


@query
def feature_table(spark, d):
    """Cleaned features of the whole server as one series."""
    return rounded(features(spark, d, []))


@query
def feature_table_keyed(spark, d):
    return rounded(features(spark, d))


@query
def test_feature_table(spark, d):
    return rounded(train_test(spark, d)[1])


@query
def previous_demand(spark, d):
    return rounded(anomaly.previous_demand(look_back(spark, d)).select("site", "ds", "y", "previous"))


@query
def residual_anomaly(spark, d):
    return rounded(look_back(spark, d).select("site", "ds", "y", "yhat", "is_anomaly"))


@query
def cumulative_cost(spark, d):
    table = stage(backtest(spark, d), "backtest")
    running = finance.running_total(table, "cost", "cumulative_cost", ["site", "strategy"])
    return rounded(running.select("site", "strategy", "ds", "cost", "cumulative_cost"))


@query
def sequence_windows(spark, d):
    """The windows themselves are reported as their length, their oldest row and checksums.

    The weighted one counts every cell by its row's place from 1 times its feature's, so that no two rows or features can change places.
    """
    rows = with_position(stage(features(spark, d), "features"), SITE)
    windows = FC.sequence_windows(rows, FEATURES, 30, SITE)
    lag = FEATURES.index("lag_1step")
    sums = F.aggregate("window", F.lit(0.0), lambda total, row: total + row[lag])
    cells = F.transform("window", lambda row, i: (i + 1) * F.aggregate(F.transform(row, lambda x, j: x * (j + 1)), F.lit(0.0), lambda total, x: total + x))
    weighted = F.aggregate(cells, F.lit(0.0), lambda total, x: total + x)
    return rounded(
        windows.select(
            "site", "ds", F.col("intensity").alias("target"), F.size("window").alias("rows"),
            F.col("window")[0][lag].alias("oldest_lag"), sums.alias("lag_sum"), F.round(weighted, 1).alias("weighted_sum"),
        ),
        2,
    )


@query
def warmup_cut(spark, d):
    return rounded(M.warmup_cut(baselines(spark, d), SITE).select("site", "model", "ds", "y", "yhat"))


@query
def tail_align(spark, d):
    """Sequence rows start later than the features they are compared with; joining on ds keeps the shared tail."""
    table = stage(features(spark, d), "features")
    late = FC.sequence_windows(with_position(table, SITE), ["lag_1step"], 30, SITE)
    made = late.select("site", "ds", F.col("lag_1step").alias("yhat"))
    actual = table.select("site", "ds", F.col("intensity").alias("y"))
    return rounded(M.predictions_align(actual, made, SITE).select("site", "ds", "y", "yhat"))


@query
def backfill_head(spark, d):
    """The week lag is unknown in a series' first week; those rows take the first known one."""
    rows = raw_features(spark, d).filter(F.col("intensity").isNotNull() & F.col("lag_24h").isNotNull())
    made = stage(rows.select("site", "ds", F.col("intensity").alias("y"), F.col("lag_7d").alias("yhat")), "predictions")
    return rounded(M.backfill_head(made, SITE))


# --- sort, limit, sets, shape ------------------------------------------------------------------


@query
def sort_by_time(spark, d):
    return A.events_log(spark, d).orderBy(F.col("timestamp").asc_nulls_last(), "host", "request", "bytes")


@query
def top_k(spark, d):
    counts = A.events_log(spark, d).groupBy("request").agg(F.count(F.lit(1)).alias("requests"))
    return R.top_k(counts, "requests", "request", 20)


@query
def horizon_limit(spark, d):
    return rounded(M.horizon_limit(day_forecast(spark, d), 100, SITE))


@query
def zoom_slice(spark, d):
    table = stage(backtest(spark, d), "backtest").drop(POSITION)
    zoomed = M.horizon_limit(table, 288, ["site", "strategy"])
    return rounded(zoomed.select("site", "strategy", "ds", "y", "replicas"))


@query
def context_union(spark, d):
    before, after = FE.time_split(A.events_log(spark, d), A.SPLIT, "timestamp")
    context = FE.context_tail(stage(P.features_of(before, INTERVAL, SITE, CFG), "features"), SITE)
    return rounded(FE.context_union(context, P.cleaned_load(after, INTERVAL, SITE, CFG), SITE))


@query
def dedup_latest(spark, d):
    """Requests of one site in the same minute stand for repeated loads of a bucket; the latest event stays."""
    rows = A.table(spark, d, "events").select(
        (F.col("user_id") % A.SITES).cast("int").alias("site"),
        to_timestamp(minute_index(F.col("ts"))).alias("ds"),
        "event_id", "event_type", "value",
    )
    return FE.dedup_latest(rows, SITE, "event_id")


@query
def unpivot_strategies(spark, d):
    table = backtest(spark, d)
    wide = table.groupBy("site", "ds").agg(
        *[F.max(F.when(F.col("strategy") == s, F.col("replicas"))).alias(f"{s.lower()}_replicas") for s in CP.STRATEGIES]
    )
    labels = {"predictive_replicas": "Forecast-based", "reactive_replicas": "Load-based"}
    return finance.unpivot_strategies(wide, labels, "replicas", SITE)


@query
def pivot_predictions(spark, d):
    made = FC.baseline_forecasts(features(spark, d), SITE)
    return rounded(M.pivot_predictions(made, list(BASELINES), SITE))


# --- forecasts ---------------------------------------------------------------------------------


def _baseline(spark: SparkSession, d: str, model: str) -> DataFrame:
    made = FC.baseline_forecasts(features(spark, d), SITE)
    return rounded(made.filter(F.col("model") == model).select("site", "ds", "y", "yhat"))


@query
def naive_forecast(spark, d):
    return _baseline(spark, d, "naive")


@query
def seasonal_naive_forecast(spark, d):
    made = FC.baseline_forecasts(features(spark, d), SITE)
    return rounded(made.filter(F.col("model").startswith("seasonal")))


@query
def trend_fit(spark, d):
    return rounded(FC.trend_fit(clean(spark, d), ORIGIN, SITE), 3)


@query
def scale_transform(spark, d):
    table = stage(features(spark, d).select("site", "ds", "intensity"), "features")
    stats = S.scaler_fit(table, ["intensity"], SITE)
    score = S.scale(table, stats, ["intensity"], SITE).withColumn("score", F.col("intensity"))
    return rounded(S.unscale(score, stats, "intensity", "intensity", SITE))


@query
def rolling_validation(spark, d):
    cutoffs = ["2024-01-15 00:00:00", "2024-01-18 00:00:00", "2024-01-21 00:00:00"]
    folds = FC.validation_folds(FC.baseline_forecasts(features(spark, d), SITE), cutoffs, 5)
    return rounded_means(M.forecast_metrics(folds, ["fold", "model"]))


CUTOFFS = ["2024-01-15 00:00:00", "2024-01-18 00:00:00", "2024-01-21 00:00:00"]


@query
def rolling_refit(spark, d):
    """The additive model fitted anew for every fold: rows fitted on, buckets forecast, and how far the fit is from its normal equations."""
    table = stage(features(spark, d), "features")
    made, fits, basis = AD.refitted(table, CUTOFFS, 5, SITE)
    tested = made.groupBy("site", "fold").agg(F.count("yhat").alias("n_test"))
    steep = []
    for fold, cutoff in enumerate(CUTOFFS, 1):
        before = table.filter(F.col("ds") < F.lit(cutoff).cast("timestamp_ntz"))
        each = AD.gradients(before, basis, SeasonalConfig(), fits.filter(F.col("fold") == fold), SITE)
        steep.append(each.groupBy("site").agg(F.max("n").alias("n_train"), F.round(F.max(F.abs("gradient")), 6).alias("gradient")).withColumn("fold", F.lit(fold)))
    return M.null_safe_join(reduce(DataFrame.unionByName, steep), tested, ["site", "fold"])


@query
def rolling_refit_metrics(spark, d):
    """Errors per fold of models fitted on what was known before the fold."""
    made, _, _ = AD.refitted(stage(features(spark, d), "features"), CUTOFFS, 5, SITE)
    return rounded(M.forecast_metrics(made, ["fold"]))


def _fitted(spark: SparkSession, d: str, make) -> tuple:
    train, test = train_test(spark, d)
    forecaster = make()
    if forecaster.name == FC.SequenceRegression.name:
        train, test = with_position(train, SITE), with_position(test, SITE)
    model, stats = FC.fit_scaled(forecaster, train, SITE)
    return forecaster, model, stats, train, test


@query
def additive_seasonal_forecast(spark, d):
    forecaster, model, stats, train, test = _fitted(spark, d, FC.AdditiveSeasonal)
    made = FC.predict_scaled(forecaster, model, stats, test, SITE)
    fitted = FC.predict_scaled(forecaster, model, stats, train, SITE)
    return rounded(FC.with_interval(made, fitted, SITE))


@query
def additive_fit(spark, d):
    """The fit per site and term against its normal equations: rows, and the gradient that is left."""
    train, _ = train_test(spark, d)
    table = stage(train, "train-features")
    model = AD.AdditiveSeasonal(keys=SITE).fit(table)
    made = AD.gradients(table, model.basis, SeasonalConfig(), model.coefficients, SITE)
    return made.select("site", "term", "n", F.round(F.abs("gradient"), 6).alias("gradient"))


@query
def boosted_tree_forecast(spark, d):
    forecaster, model, stats, _, test = _fitted(spark, d, lambda: FC.BoostedTree(SITE))
    return rounded(FC.predict_scaled(forecaster, model, stats, test, SITE))


@query
def feature_importance(spark, d):
    _, model, _, _, _ = _fitted(spark, d, lambda: FC.BoostedTree(SITE))
    return rounded(FC.feature_importance(spark, model))


@query
def sequence_regression(spark, d):
    forecaster, model, stats, _, test = _fitted(spark, d, lambda: FC.SequenceRegression(SITE))
    return rounded(FC.predict_scaled(forecaster, model, stats, test, SITE))


@query
def batch_scoring(spark, d):
    """Fit, save, load, and score every test bucket of each site with each of the models."""
    made = []
    for make in (FC.AdditiveSeasonal, lambda: FC.BoostedTree(SITE), lambda: FC.SequenceRegression(SITE)):
        forecaster, model, stats, _, test = _fitted(spark, d, make)
        root = new_path(spark, "models")
        FC.save_model(model, stats, root, forecaster.name, INTERVAL)
        stored, scaler = FC.load_model(spark, root, forecaster.name, INTERVAL)
        made.append(FC.predict_scaled(forecaster, stored, scaler, test, SITE).select("site", "ds", "y", "yhat").withColumn("model", F.lit(forecaster.name)))
    return rounded(reduce(DataFrame.unionByName, made))


@query
def save_load_model(spark, d):
    """Whether each forecast of a model is the same before it is stored and after it is loaded again."""
    forecaster, model, stats, _, test = _fitted(spark, d, FC.AdditiveSeasonal)
    root = new_path(spark, "models")
    FC.save_model(model, stats, root, forecaster.name, INTERVAL)
    stored, scaler = FC.load_model(spark, root, forecaster.name, INTERVAL)
    now = FC.predict_scaled(forecaster, model, stats, test, SITE).select("site", "ds", "yhat")
    later = FC.predict_scaled(forecaster, stored, scaler, test, SITE).select("site", "ds", F.col("yhat").alias("stored_yhat"))
    both = M.null_safe_join(now, later, ["site", "ds"])
    return both.select("site", "ds", F.col("yhat").eqNullSafe(F.col("stored_yhat")).alias("same"))


# --- capacity ----------------------------------------------------------------------------------


@query
def ceil_clip(spark, d):
    x = F.col("intensity") / POLICY.server_capacity
    return clean(spark, d).select("site", "ds", C.ceil_clip(x, F.lit(2), F.lit(6)).alias("replicas"))


@query
def normalized_demand(spark, d):
    return rounded(backtest(spark, d).select("site", "strategy", "ds", C.normalized_demand(F.col("y"), of("server_capacity")).alias("demand")))


@query
def reactive_target(spark, d):
    rows = with_policy(anomaly.previous_demand(look_back(spark, d)), POLICY)
    return rows.select("site", "ds", CP.reactive().alias("target"))


@query
def predictive_target(spark, d):
    rows = with_policy(day_forecast(spark, d), POLICY)
    return rows.select("site", "ds", CP.predictive().alias("target"))


@query
def emergency_target(spark, d):
    """Replicas in the buckets flagged as anomalies, where the target follows the current replicas."""
    flagged = backtest(spark, d).filter((F.col("strategy") == finance.PREDICTIVE) & F.col("is_anomaly"))
    return flagged.select("site", "ds", "replicas")


@query
def replica_plan(spark, d):
    return backtest(spark, d).select("site", "strategy", "ds", "target", "replicas")


@query
def plan_actions(spark, d):
    return backtest(spark, d).select("site", "strategy", "ds", "replicas", "action", "reason")


@query
def step_cost(spark, d):
    return rounded(backtest(spark, d).select("site", "strategy", "ds", "dropped", "infra", "penalty", "cost"))


@query
def prorated_cost(spark, d):
    made = CP.prorated_costs(day_forecast(spark, d), INTERVAL, SITE, POLICY)
    return rounded(made.select("site", "strategy", "ds", "replicas", "dropped", "infra", "penalty", "cost"))


@query
def reactive_plan_simple(spark, d):
    rows = with_policy(anomaly.previous_demand(look_back(spark, d), "yhat"), POLICY)
    simple = C.reactive_plan_simple(F.col("previous"), of("server_capacity"), of("reactive_buffer"))
    return rows.select("site", "ds", simple.alias("replicas"))


@query
def strategy_backtest(spark, d):
    return rounded(backtest(spark, d).select("site", *CP.BACKTEST))


@query
def policy_backtest(spark, d):
    """Totals when every site has its own policy."""
    made = CP.strategy_backtest(day_forecast(spark, d), SITE, POLICY, overrides(spark, d))
    return rounded(finance.strategy_totals(made, SITE))


@query
def forecast_points(spark, d):
    return rounded(CP.forecast_points(baselines(spark, d), INTERVAL, "naive", 150, SITE))


@query
def scaling_recommendation(spark, d):
    points = stage(CP.forecast_points(baselines(spark, d), INTERVAL, "seasonal_day", 150, SITE), "points")
    plan = CP.scaling_recommendation(points, SITE, POLICY.override(buffer_ratio=0.1, cooldown_period=None))
    return rounded(plan.select("site", "ds", "yhat", "recommended_replicas", "action", "reason", "y"))


# --- streams -----------------------------------------------------------------------------------


def _as_stream(table: DataFrame, name: str) -> DataFrame:
    """A stored copy of ``table`` read as a file stream."""
    path = new_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.readStream.schema(table.schema).parquet(path)


@query
def stream_load(spark, d):
    return rounded(SL.run_available(SL.stream_load(A.events_stream(spark, d), INTERVAL, SITE, "10 minutes", CFG), "stream-load"))


@query
def stream_fill(spark, d):
    """Closed buckets from one stream, with the empty ones added by a second."""
    closed = SL.run_available(SL.stream_load(A.events_stream(spark, d), INTERVAL, SITE, "10 minutes", CFG), "stream-load")
    return rounded(SL.run_available(SL.stream_fill(_as_stream(closed, "load-stream"), INTERVAL, SITE, CFG), "stream-fill"))


@query
def stream_late(spark, d):
    """Two deliveries of the log: the hosts of every fiftieth user come after the rest, and are late but for the last buckets."""
    log = A.events_log(spark, d)
    behind = F.substr("host", F.lit(2)).cast("long") % 50 == 0
    source, load_out, load_state, all_out, all_state = (new_path(spark, f"late-{x}") for x in ("log", "load", "load-state", "all", "all-state"))
    for delivery in (log.filter(~behind), log.filter(behind)):
        delivery.write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        loaded = SL.run_available(SL.stream_load(stream, INTERVAL, SITE, "10 minutes", CFG), "late-load", load_out, load_state)
        received = SL.run_available(SL.stream_received(stream, INTERVAL, SITE), "late-all", all_out, all_state)
    return SL.load_account(received, loaded, INTERVAL, SITE, "10 minutes")


def _on_time(made: DataFrame, name: str) -> DataFrame:
    return rounded(ST.split_late(SL.run_available(made, name))[0])


@query
def stream_anomaly(spark, d):
    stream = _as_stream(day_forecast(spark, d), "forecast-stream")
    return _on_time(ST.stream_anomaly(stream, SITE, POLICY), "stream-anomaly")


@query
def stream_replica_plan(spark, d):
    stream = _as_stream(day_forecast(spark, d), "forecast-stream")
    return _on_time(ST.stream_replica_plan(stream, SITE, POLICY), "stream-plan")


@query
def stream_backtest(spark, d):
    """Both strategies over one stream, the alarm included."""
    made = _on_time(ST.stream_backtest(_as_stream(day_forecast(spark, d), "forecast-stream"), SITE, POLICY), "stream-backtest")
    return made.select("site", *CP.BACKTEST, "action", "reason")


@query
def stream_late_rows(spark, d):
    """Plan of a stream whose rows of every seventh day of a month come after all others."""
    table = day_forecast(spark, d)
    source, out, state = (new_path(spark, f"late-{x}") for x in ("source", "out", "state"))
    seventh = F.dayofmonth("ds") % 7 == 0
    for part in (table.filter(~seventh), table.filter(seventh)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(table.schema).parquet(source)
        made = SL.run_available(ST.stream_replica_plan(stream, SITE, POLICY), "late", out, state)
    return rounded(made.select("site", "ds", "y", "yhat", "late", "recommended_replicas", "action"))


QUERIES["policy_join"] = QUERIES.pop("policy_join_query")
