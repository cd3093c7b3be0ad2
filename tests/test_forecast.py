"""Scalers, metrics, models, folds, and stage tables."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from loadgauge.config import FEATURES, BoostedTreeConfig, LoadConfig, SequenceConfig, model_kind
from loadgauge.operators import forecast as FC, metrics as M, scaling as S
from loadgauge.operators.blocks import with_position
from loadgauge.plans import capacity as CP, pipeline as P
from loadgauge.session import new_path
from loadgauge.sources import adapters as A, tables as TB

T0 = datetime(2024, 1, 1)
STEP = timedelta(minutes=15)
CFG = LoadConfig(outages=A.OUTAGES)


@pytest.fixture(scope="module")
def parts(spark, small):
    return P.train_test_features(A.events_log(spark, small), A.SPLIT, "15min", ["site"], CFG)


def predictions(spark, rows):
    return spark.createDataFrame(rows, "interval string, model string, ds timestamp_ntz, y double, yhat double")


def line(n, y=1.0, yhat=0.0, interval="15min", model="m"):
    return [(interval, model, T0 + i * STEP, float(y), float(yhat)) for i in range(n)]


def test_metrics(spark):
    rows = [("15min", "m", T0, 4.0, 1.0), ("15min", "m", T0 + STEP, 0.0, 2.0), ("15min", "m", T0 + 2 * STEP, 2.0, 2.0)]
    got = M.forecast_metrics(predictions(spark, rows)).first()
    assert got.mse == pytest.approx(13 / 3) and got.rmse == pytest.approx(np.sqrt(13 / 3))
    assert got.mae == pytest.approx(5 / 3) and got.mape == pytest.approx(37.5)
    zero = M.forecast_metrics(predictions(spark, line(3, y=0.0, yhat=1.0))).first()
    assert zero.mape == 0.0


@pytest.mark.parametrize("n, left", [(95, 95), (96, 96), (97, 1), (300, 204)])
def test_warmup(spark, n, left):
    assert M.warmup_cut(predictions(spark, line(n))).count() == left


def test_warmup_rows_per_interval(spark):
    both = predictions(spark, line(300) + line(300, interval="5min"))
    got = {r.interval: r["count"] for r in M.warmup_cut(both).groupBy("interval").count().collect()}
    assert got == {"15min": 204, "5min": 12}


def test_leaderboard_sorts_intervals_as_text(spark):
    rows = [(i, m, r, r, r, r) for i in ("1min", "5min", "15min") for m, r in (("a", 2.0), ("b", 1.0))]
    df = spark.createDataFrame(rows, "interval string, model string, rmse double, mse double, mae double, mape double")
    got = [(r.interval, r.model) for r in M.leaderboard(df).collect()]
    assert got == [(i, m) for i in ("15min", "1min", "5min") for m in ("b", "a")]


def test_common_rows(spark):
    df = predictions(spark, line(5, model="a") + line(3, model="b"))
    assert M.common_rows(df, [], 2).count() == 6


def test_backfill(spark):
    df = spark.createDataFrame(
        [(1, T0, None), (1, T0 + STEP, 7.0), (1, T0 + 2 * STEP, 8.0), (2, T0, None)],
        "site int, ds timestamp_ntz, yhat double",
    )
    got = sorted((r.site, r.yhat) for r in M.backfill_head(df, ["site"]).collect())
    assert got == [(1, 7.0), (1, 7.0), (1, 8.0), (2, 0.0)]


def test_horizon(spark):
    df = predictions(spark, line(30))
    assert [M.horizon_limit(df, h).count() for h in (7, 30, 99, 0, -1, None)] == [7, 30, 30, 30, 30, 30]
    first = M.horizon_limit(df, 7).agg(F.max("ds")).first()[0]
    assert first == T0 + 6 * STEP


def test_scaler(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 3.0, 5.0), (2, 4.0, 1.0)], "site int, a double, b double")
    stats = S.scaler_fit(df, ["a", "b"], ["site"])
    got = {r.site: r for r in stats.collect()}
    assert (got[1].a_mean, got[1].a_scale, got[1].b_scale, got[2].a_scale) == (2.0, 1.0, 1.0, 1.0)
    back = S.unscale(S.scale(df, stats, ["a"], ["site"]), stats, "a", "a", ["site"])
    assert sorted(r.a for r in back.collect()) == [1.0, 3.0, 4.0]
    single = df.drop("site")
    whole = S.scale(single, S.scaler_fit(single, ["a"]), ["a"])
    assert sum(r.a for r in whole.collect()) == pytest.approx(0.0)
    with pytest.raises(ValueError):
        S.scale(df, stats, ["c"], ["site"])


def test_trend_recovers_a_line(spark):
    rows = [(T0 + i * STEP, 3.0 + 2.0 * i / 96) for i in range(200)]
    got = FC.trend_fit(spark.createDataFrame(rows, "ds timestamp_ntz, intensity double"), "2024-01-01 00:00:00").first()
    assert got.slope == pytest.approx(2.0) and got.intercept == pytest.approx(3.0)


@pytest.mark.parametrize("block_rows", [5, 8192])
def test_sequence_windows(spark, block_rows):
    rows = [(T0 + i * STEP, float(i)) for i in range(60)]
    df = with_position(spark.createDataFrame(rows, "ds timestamp_ntz, x double"), [])
    got = FC.sequence_windows(df, ["x"], 5, [], block_rows).orderBy("ds").collect()
    assert [[v[0] for v in r.window] for r in got] == [list(map(float, range(i - 5, i))) for i in range(5, 60)]


def test_folds_expand(spark):
    df = spark.createDataFrame([(T0 + timedelta(days=d),) for d in range(10)], "ds timestamp_ntz")
    got = FC.validation_folds(df, ["2024-01-03", "2024-01-05"], 4)
    days = sorted((r.fold, r.ds.day) for r in got.collect())
    assert days == [(1, 3), (1, 4), (1, 5), (1, 6), (2, 5), (2, 6), (2, 7), (2, 8)]


def test_additive_model_beats_the_mean_on_a_seasonal_series(spark, parts):
    train, test = parts
    season = 100 + 50 * F.col("hour_sin") + 20 * F.col("day_cos")
    train, test = train.withColumn("intensity", season), test.withColumn("intensity", season)
    model, stats = FC.fit_scaled(FC.AdditiveSeasonal(), train, ["site"])
    made = FC.predict_scaled(FC.AdditiveSeasonal(), model, stats, test, ["site"])
    assert M.forecast_mae(made).first().mae < 5
    ranged = FC.with_interval(made, FC.predict_scaled(FC.AdditiveSeasonal(), model, stats, train, ["site"]), ["site"])
    assert ranged.filter("yhat_lower <= yhat AND yhat <= yhat_upper").count() == test.count()


def test_boosted_trees_stop_early_and_rank_features(spark, parts):
    train, test = parts
    target = 100 + 50 * F.col("is_weekend")
    train, test = train.withColumn("intensity", target.cast("double")), test.withColumn("intensity", target.cast("double"))
    trees = FC.BoostedTree(["site"], BoostedTreeConfig(rounds=30, max_depth=3, learning_rate=0.5, row_sample=1.0, column_sample="all"))
    model, stats = FC.fit_scaled(trees, train, ["site"])
    assert len(model.stages[-1].trees) < 30
    made = FC.predict_scaled(trees, model, stats, test, ["site"])
    assert M.forecast_mae(made).first().mae < 5
    ranks = {r.feature: r.importance for r in FC.feature_importance(spark, model).collect()}
    assert set(ranks) == set(FEATURES) and max(ranks, key=ranks.get) in ("is_weekend", "day_sin", "day_cos")


def test_best_round_waits_for_patience():
    assert FC.best_round([3, 2, 2.5, 2.4, 1], 2) == (2, True)
    assert FC.best_round([3, 2, 2.5, 2.4, 1], 4) == (5, False)
    assert FC.best_round([1, 1, 1], 2) == (1, True)


def test_boosting_goes_on_while_the_held_days_gain(spark, parts):
    """A gain below Spark's tolerance a round, as small steps have, is still one; the cut is stored with the model."""
    train, test = parts
    season = 100 + 50 * F.col("hour_sin") + 20 * F.col("day_cos") + F.col("lag_1step")
    train, test = train.withColumn("intensity", season), test.withColumn("intensity", season)
    trees = FC.BoostedTree(["site"], BoostedTreeConfig(rounds=40, max_depth=3, learning_rate=0.05, patience=10))
    model, stats = FC.fit_scaled(trees, train, ["site"])
    assert len(model.stages[-1].trees) > 10
    root = new_path(spark, "models")
    FC.save_model(model, stats, root, "boosted_tree", "15min")
    stored, scaler = FC.load_model(spark, root, "boosted_tree", "15min")
    made, again = (sorted(map(tuple, FC.predict_scaled(trees, m, s, test, ["site"]).collect())) for m, s in ((model, stats), (stored, scaler)))
    assert made == again


def test_queries_fit_the_configured_model(monkeypatch, spark, small):
    from loadgauge.plans.catalog import QUERIES

    asked = []
    monkeypatch.setattr(FC.BoostedTree, "fit", lambda self, train: asked.append(self.cfg) or 1 / 0)
    for name in ("boosted_tree_forecast", "feature_importance", "batch_scoring"):
        with pytest.raises(ZeroDivisionError):
            QUERIES[name](spark, small)
    assert asked == [BoostedTreeConfig()] * 3


def test_sequence_model_backfills(spark, parts):
    train, test = (with_position(p, ["site"]) for p in parts)
    model = FC.SequenceRegression(["site"], SequenceConfig(n_lags=3))
    fitted, stats = FC.fit_scaled(model, train, ["site"])
    made = FC.predict_scaled(model, fitted, stats, test, ["site"])
    assert made.count() == test.count()
    head = made.groupBy("site").agg(F.slice(F.array_sort(F.collect_list(F.struct("ds", "yhat"))), 1, 4).alias("h"))
    assert all(len({x.yhat for x in r.h}) == 1 for r in head.collect() if len(r.h) == 4)


def test_models_are_stored_per_interval(spark, parts):
    train, test = parts
    model, stats = FC.fit_scaled(FC.AdditiveSeasonal(), train, ["site"])
    root = new_path(spark, "models")
    FC.save_model(model, stats, root, "additive_seasonal", "15min")
    stored, scaler = FC.load_model(spark, root, "additive_seasonal", "15min")

    def rows(m, s):
        return sorted(map(tuple, FC.predict_scaled(FC.AdditiveSeasonal(), m, s, test, ["site"]).collect()))

    assert rows(model, stats) == rows(stored, scaler)


def test_requests_check_their_domains(spark):
    df = predictions(spark, line(5, model="additive_seasonal", yhat=-3.0))
    assert {r.yhat for r in CP.forecast_points(df, "15min", "prophet").collect()} == {0.0}
    assert model_kind("xgboost") == "boosted_tree" and model_kind("naive") == "naive"
    for interval, model in (("7min", "prophet"), ("15min", "oracle")):
        with pytest.raises(ValueError):
            CP.forecast_points(df, interval, model)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_tables_keep_their_types(spark, fmt):
    df = predictions(spark, line(4)).drop("interval")
    folder = new_path(spark, "predictions")
    for interval in ("5min", "15min"):
        TB.write_table(df, f"{folder}/predictions_{interval}", fmt=fmt)
    got = TB.read_predictions(spark, folder, fmt=fmt)
    assert got.groupBy("interval").count().orderBy("interval").collect() == [("15min", 4), ("5min", 4)]
    assert got.drop("interval").schema == TB.PREDICTIONS


def test_partitions_are_replaced_one_by_one(spark):
    path = new_path(spark, "table")
    a = spark.createDataFrame([(1, "train"), (2, "test")], "y int, split string")
    TB.write_table(a, path, ["split"])
    TB.write_table(spark.createDataFrame([(3, "test")], "y int, split string"), path, ["split"])
    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("split", T.StringType())])
    assert sorted(map(tuple, TB.read_table(spark, path, schema).collect())) == [(1, "train"), (3, "test")]
