"""The additive model: series of their own, bends, folds from one pass."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgauge.config import SeasonalConfig
from loadgauge.operators import additive as AD, forecast as FC
from loadgauge.session import new_path, stage

T0 = datetime(2024, 1, 1)
CFG = SeasonalConfig(ridge=1e-8, changepoint_ridge=1e-6, changepoints=4, daily_order=2, weekly_order=1)


@pytest.fixture(scope="module")
def table(spark):
    """Opposite slopes, a bend, a daily wave of different height; one series without a name, one constant."""
    rows = []
    for i in range(24 * 20):
        ds, day, wave = T0 + timedelta(hours=i), i / 24, np.sin(2 * np.pi * i / 24)
        rows += [("up", ds, 10 + 3 * day + 5 * wave), ("down", ds, 90 - 3 * day - wave), (None, ds, 5 + (0 if day < 8 else 2 * (day - 8)))]
        rows += [("flat", ds, 7.0)]
    made = spark.createDataFrame([(s, d, float(v)) for s, d, v in rows], "series string, ds timestamp_ntz, load double")
    return stage(made.repartition(5), "series")


def slopes(model):
    trend = list(model.basis.terms()).index("trend")
    return {r.series: r.coefficients[trend] / model.basis.span for r in model.coefficients.collect()}


@pytest.fixture(autouse=True)
def no_features(monkeypatch):
    monkeypatch.setattr(AD.Basis.of, "__defaults__", ((),))


def test_series_have_their_own_trend(table):
    model = AD.AdditiveSeasonal(CFG, ["series"], "load").fit(table)
    found = slopes(model)
    assert found["up"] == pytest.approx(3, abs=0.05) and found["down"] == pytest.approx(-3, abs=0.05) and found["flat"] == pytest.approx(0, abs=1e-6)
    made = AD.AdditiveSeasonal(CFG, ["series"], "load").predict(model, table)
    off = made.groupBy("series").agg(F.max(F.abs(F.col("load") - F.col("yhat"))).alias("off")).collect()
    assert all(r.off < (0.5 if r.series else 3) for r in off) and len(off) == 4


def test_a_trend_bends(table):
    late = table.where(F.col("ds") >= F.lit(T0 + timedelta(days=17)))
    for bends, near in ((0, False), (4, True)):
        cfg = SeasonalConfig(**{**CFG.__dict__, "changepoints": bends})
        model = AD.AdditiveSeasonal(cfg, ["series"], "load").fit(table)
        made = AD.AdditiveSeasonal(cfg, ["series"], "load").predict(model, late).where("series IS NULL")
        assert (made.agg(F.max(F.abs(F.col("load") - F.col("yhat")))).first()[0] < 1.5) == near


def test_folds_equal_a_fit_of_their_own(table):
    cutoffs = ["2024-01-08 00:00:00", "2024-01-12 06:00:00", "2024-01-16 00:00:00"]
    made, fits, basis = AD.refitted(table, cutoffs, 3, ["series"], CFG, "load")
    for fold, cutoff in enumerate(cutoffs, 1):
        before = table.where(F.col("ds") < F.lit(cutoff).cast("timestamp_ntz"))
        alone = AD.fit_folds(before.withColumn(AD.SEGMENT, F.lit(0)), basis, CFG, 1, ["series"], "load")
        want = {r.series: (r.n, r.sigma, r.coefficients) for r in alone.collect()}
        got = {r.series: (r.n, r.sigma, r.coefficients) for r in fits.where(F.col("fold") == fold).collect()}
        assert got.keys() == want.keys()
        for s in want:
            assert got[s][0] == want[s][0] and np.allclose(got[s][2], want[s][2], atol=1e-5)
        assert before.count() == sum(v[0] for v in want.values())
    tested = made.groupBy("fold").count().orderBy("fold").collect()
    assert [tuple(r) for r in tested] == [(1, 288), (2, 288), (3, 288)]
    assert made.where("yhat IS NULL").count() == 0


def test_gradients_vanish_at_the_solution_only(table):
    model = AD.AdditiveSeasonal(CFG, ["series"], "load").fit(table)
    steep = AD.gradients(table, model.basis, CFG, model.coefficients, ["series"], "load")
    assert steep.agg(F.max(F.abs("gradient"))).first()[0] < 1e-7
    moved = model.coefficients.withColumn("coefficients", F.transform("coefficients", lambda c: c * 1.01))
    assert AD.gradients(table, model.basis, CFG, moved, ["series"], "load").agg(F.max(F.abs("gradient"))).first()[0] > 1e-4


def test_model_of_one_series_is_stored(spark, table):
    one = table.where("series = 'up'").drop("series")
    model = AD.AdditiveSeasonal(CFG, [], "load").fit(one)
    stats = one.agg(F.lit(0.0).alias("load_mean"))
    root = new_path(spark, "models")
    FC.save_model(model, stats, root, "additive_seasonal", "15min")
    stored, _ = FC.load_model(spark, root, "additive_seasonal", "15min")
    assert stored.basis == model.basis and stored.coefficients.collect() == model.coefficients.collect()
    rows = [AD.AdditiveSeasonal(CFG, [], "load").predict(m, one).orderBy("ds").collect() for m in (model, stored)]
    assert rows[0] == rows[1]


def test_rows_with_gaps_are_left_out_and_empty_tables_fit_nothing(spark, table):
    holed = table.withColumn("load", F.when(F.hour("ds") != 3, F.col("load")))
    model = AD.AdditiveSeasonal(CFG, ["series"], "load").fit(holed)
    assert {r.n for r in model.coefficients.collect()} == {24 * 20 - 20}
    none = AD.AdditiveSeasonal(CFG, ["series"], "load").fit(table.limit(0))
    assert none.coefficients.count() == 0
    assert AD.AdditiveSeasonal(CFG, ["series"], "load").predict(none, table).where("yhat IS NOT NULL").count() == 0
