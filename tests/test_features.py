"""Lags and rolling statistics: gaps, blocks, leakage."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadgauge.config import FEATURES, FeatureConfig
from loadgauge.operators import features as FE

T0 = datetime(2024, 1, 1)
STEP = timedelta(minutes=30)


def series(n, missing=(), seed=0):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1000, n).astype(float)
    return [(T0 + i * STEP, float(values[i])) for i in range(n) if i not in missing]


def frame(spark, rows, key=None):
    if key is None:
        return spark.createDataFrame(rows, "ds timestamp_ntz, intensity double")
    return spark.createDataFrame([(key, *r) for r in rows], "site int, ds timestamp_ntz, intensity double")


def in_pandas(rows):
    """Features on the restored grid of one half-hourly series."""
    s = pd.Series(dict(rows)).sort_index()
    s = s.reindex(pd.date_range(s.index.min(), s.index.max(), freq="30min"))
    past = s.shift(1).rolling(8)
    return pd.DataFrame(
        {
            "intensity": s, "lag_1step": s.shift(1), "lag_1h": s.shift(2), "lag_24h": s.shift(48), "lag_7d": s.shift(336),
            "roll_mean_4h": past.mean(), "roll_std_4h": past.std(), "roll_max_4h": past.max(),
        }
    )


@pytest.mark.parametrize("days", [7, 28])
def test_equals_pandas_over_gaps_and_blocks(spark, days):
    rows = series(48 * 40, missing={5, 100, 101, 700, *range(900, 1000)})
    got = FE.raw_features(frame(spark, rows), "30min", [], FeatureConfig(block_days=days)).toPandas().set_index("ds").sort_index()
    want = in_pandas(rows).dropna(subset=["intensity"])
    pd.testing.assert_frame_equal(
        got[want.columns], want, check_names=False, check_freq=False, check_index_type=False, rtol=1e-9
    )


def test_cleaning_drops_and_fills(spark):
    rows = series(48 * 9)
    got = FE.feature_table(frame(spark, rows), "30min").toPandas()
    assert len(got) == 48 * 8 and not got.isna().any().any()
    assert (got.sort_values("ds")["lag_7d"].head(48) == 0).all()


def test_no_feature_uses_the_present_or_the_future(spark):
    rows = series(48 * 10)
    at = T0 + 480 // 2 * STEP
    changed = [(t, v + 500 * (t >= at)) for t, v in rows]
    kept = [c for c in FEATURES]

    def upto(data):
        table = FE.raw_features(frame(spark, data), "30min")
        return table.filter(F.col("ds") <= F.lit(at)).select("ds", *kept).toPandas().sort_values("ds").reset_index(drop=True)

    pd.testing.assert_frame_equal(upto(rows), upto(changed))


def test_series_do_not_mix(spark):
    a, b = series(48 * 9, seed=1), series(48 * 9, seed=2)
    both = frame(spark, a, 1).unionByName(frame(spark, b, 2))
    keyed = FE.feature_table(both, "30min", ["site"])
    alone = FE.feature_table(frame(spark, b), "30min")
    assert sorted(map(tuple, keyed.filter("site = 2").drop("site").collect())) == sorted(map(tuple, alone.collect()))


def test_test_part_looks_back_into_the_context(spark):
    rows = series(48 * 20)
    cut = 48 * 14
    train = FE.feature_table(frame(spark, rows[:cut]), "30min")
    context = FE.context_tail(train)
    assert context.count() == 48 * 8
    test = frame(spark, rows[cut:])
    got = FE.test_feature_table(context, test, "30min").orderBy("ds").toPandas()
    want = in_pandas(rows).iloc[cut:]
    assert len(got) == len(want)
    np.testing.assert_allclose(got["lag_7d"], want["lag_7d"])
    np.testing.assert_allclose(got["roll_std_4h"], want["roll_std_4h"])


def test_context_wins_over_test(spark):
    context, test = frame(spark, [(T0, 1.0)]), frame(spark, [(T0, 2.0), (T0 + STEP, 3.0)])
    assert sorted(r.intensity for r in FE.context_union(context, test).collect()) == [1.0, 3.0]


def test_dedup_keeps_the_latest(spark):
    df = spark.createDataFrame([(T0, 1, "a"), (T0, 3, "c"), (T0, 2, "b")], "ds timestamp_ntz, seq int, x string")
    assert [r.x for r in FE.dedup_latest(df, [], "seq").collect()] == ["c"]


@pytest.mark.parametrize("interval", ["30min", "1min"])
def test_one_shuffle_serves_all_windows(spark, interval):
    df = FE.raw_features(frame(spark, series(48 * 9), 1), interval, ["site"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 3
