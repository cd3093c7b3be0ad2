"""Targets, the controller, anomalies, cost."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgauge.config import ScalingPolicy
from loadgauge.functions import capacity as C
from loadgauge.operators import finance
from loadgauge.operators.anomaly import look_back, previous_demand
from loadgauge.operators.blocks import POSITION, SERIES_ROWS, with_position
from loadgauge.operators.policy import policy_join, with_policy
from loadgauge.operators.replica_plan import replica_plan
from loadgauge.plans import capacity as CP

T0 = datetime(2024, 1, 1)
STEP = timedelta(minutes=15)


def targets(spark, values, alarms=None, key=0):
    alarms = [False] * len(values) if alarms is None else alarms
    rows = [(key, T0 + i * STEP, int(t), bool(a)) for i, (t, a) in enumerate(zip(values, alarms))]
    return with_position(spark.createDataFrame(rows, "site int, ds timestamp_ntz, target int, alarm boolean"), ["site"])


def controller(values, alarms, policy):
    """Step by step, for comparison."""
    replicas, wait, out = policy.min_replicas, 0, []
    for target, alarm in zip(values, alarms):
        goal = min(policy.max_replicas, int(replicas * 1.5)) if alarm else target
        action = "hold"
        if goal > replicas:
            replicas, wait, action = goal, policy.cooldown_period, "scale_out"
        elif goal < replicas and wait <= 0:
            replicas, action = goal, "scale_in"
        elif wait > 0:
            wait -= 1
        out.append((replicas, action))
    return out


def plan(df, keys=("site",), policy=ScalingPolicy(), **options):
    got = replica_plan(with_policy(df, policy), list(keys), "target", "alarm", **options)
    return got.orderBy(*keys, "ds").collect()


def test_cooldown_trace(spark):
    rows = plan(targets(spark, [3, 1, 1, 1, 5]))
    assert [r.replicas for r in rows] == [3, 3, 3, 1, 5]
    assert [r.reason for r in rows] == [
        "forecast above capacity threshold", "cooldown active (2)", "cooldown active (1)",
        "forecast below threshold and cooldown passed", "forecast above capacity threshold",
    ]
    assert [r.action for r in rows] == ["scale_out", "hold", "hold", "scale_in", "scale_out"]


def test_emergency_grows_by_half_but_not_from_one(spark):
    assert [r.replicas for r in plan(targets(spark, [9, 9], [True, True]))] == [1, 1]
    assert [r.replicas for r in plan(targets(spark, [2, 9, 9], [False, True, True]))] == [2, 3, 4]


@pytest.mark.parametrize("block_rows", [1, 7, 50, 8192])
@pytest.mark.parametrize("seed", [0, 1])
def test_blocks_give_the_step_by_step_plan(spark, block_rows, seed):
    rng = np.random.default_rng(seed)
    policy = ScalingPolicy(min_replicas=2, max_replicas=30, cooldown_period=3)
    frames, want = [], []
    for key, n in ((0, 230), (1, 49), (2, 1)):
        values = rng.integers(2, 31, n) if seed else np.repeat(rng.integers(2, 31, n // 9 + 1), 9)[:n]
        alarms = rng.random(n) < 0.1
        frames.append(targets(spark, values, alarms, key))
        want += controller(values.tolist(), alarms.tolist(), policy)
    both = frames[0].unionByName(frames[1]).unionByName(frames[2])
    got = [(r.replicas, r.action) for r in plan(both, policy=policy, block_rows=block_rows)]
    assert got == want


def test_one_series_without_key_columns(spark):
    df = targets(spark, [3, 1, 1, 1, 5, 5, 2, 2, 2, 2]).drop("site")
    got = [r.replicas for r in plan(df, keys=(), block_rows=3)]
    assert got == [r for r, _ in controller([3, 1, 1, 1, 5, 5, 2, 2, 2, 2], [False] * 10, ScalingPolicy())]


def forecast(spark, y, yhat, key=0):
    rows = [(key, T0 + i * STEP, float(a), float(b)) for i, (a, b) in enumerate(zip(y, yhat))]
    return spark.createDataFrame(rows, "site int, ds timestamp_ntz, y double, yhat double")


def flags(spark, residuals, block_rows=8192):
    df = with_position(forecast(spark, residuals, [0.0] * len(residuals)), ["site"])
    return [r.is_anomaly for r in look_back(df, ["site"], block_rows=block_rows).orderBy("ds").collect()]


def test_anomaly_needs_a_full_window_and_a_positive_spike(spark):
    assert flags(spark, [0] * 23 + [50]) == [False] * 23 + [True]
    assert not any(flags(spark, [0] * 23 + [-50]))
    assert not any(flags(spark, [7] * 40))
    assert not any(flags(spark, [0] * 9 + [50] + [0] * 20))


@pytest.mark.parametrize("block_rows", [23, 64])
def test_anomaly_does_not_depend_on_blocks(spark, block_rows):
    rng = np.random.default_rng(3)
    residuals = rng.normal(0, 1, 300) + 9 * (rng.random(300) < 0.03)
    want = []
    for i, e in enumerate(residuals):
        w = residuals[max(0, i - 23):i + 1]
        want.append(bool(len(w) == 24 and w.std() > 0 and e > 0 and abs(e - w.mean()) / w.std() > 3))
    assert any(want) and flags(spark, residuals.tolist(), block_rows) == want


def test_previous_demand_on_the_first_row(spark):
    df = look_back(with_position(forecast(spark, [5, 6, 7], [1, 2, 3]), ["site"]), ["site"], block_rows=23)
    assert [r.previous for r in previous_demand(df).orderBy("ds").collect()] == [5, 5, 6]
    assert [r.previous for r in previous_demand(df, "yhat").orderBy("ds").collect()] == [1, 5, 6]


@pytest.mark.parametrize("days", [1, 28])
def test_positions(spark, days):
    rng = np.random.default_rng(5)
    rows = [(k, T0 + int(i) * STEP) for k in (1, 2, None) for i in sorted(rng.choice(3000, 400, replace=False))]
    df = spark.createDataFrame(rows, "site int, ds timestamp_ntz").repartition(5)
    got = with_position(df, ["site"], days=days).collect()
    for k in (1, 2, None):
        mine = sorted((r.ds, r[POSITION]) for r in got if r.site == k)
        assert [p for _, p in mine] == list(range(400))
    assert {r[SERIES_ROWS] for r in got} == {400}


@pytest.mark.parametrize("demand, lost", [(80.0, 0.0), (100.0, 0.0), (130.0, 30.0)])
def test_step_cost(spark, demand, lost):
    df = spark.createDataFrame([(demand, 2)], "y double, replicas int")
    policy = ScalingPolicy(server_capacity=50.0, server_cost=0.5, sla_penalty=0.1)
    row = finance.with_cost(with_policy(df, policy)).first()
    assert (row.dropped, row.infra, row.penalty) == (lost, 1.0, pytest.approx(lost * 0.1))
    assert row.cost == pytest.approx(1.0 + lost * 0.1)
    assert finance.with_cost(with_policy(df, policy), 0.25).first().infra == 0.25


def test_targets_are_clipped(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (99.9,), (1e9,)], "x double")
    got = df.select(C.ceil_clip(F.col("x"), F.lit(1), F.lit(200))).collect()
    assert [r[0] for r in got] == [1, 1, 100, 200]


def test_no_demand_reports(spark):
    rows = [(s, 0.0, 0.0, 0.0) for s in ("Reactive", "Predictive")]
    df = spark.createDataFrame(rows, "strategy string, y double, dropped double, cost double")
    assert finance.savings_report(df).first().savings_pct == 0.0
    assert tuple(finance.sla_report(df).first()) == (100.0, 100.0, 0.0)
    assert {r.sla_violation for r in finance.strategy_totals(df).collect()} == {0.0}


def test_policy_overrides(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "site int")
    given = spark.createDataFrame([(1, 9.0, None), (2, None, 7)], "site int, server_capacity double, cooldown_period int")
    got = {r.site: r.policy for r in policy_join(df, given, ["site"]).collect()}
    assert (got[1].server_capacity, got[1].cooldown_period) == (9.0, 2)
    assert (got[2].server_capacity, got[2].cooldown_period) == (5_000_000.0, 7)
    assert got[3].max_replicas == 200
    with pytest.raises(ValueError):
        policy_join(df, given.withColumnRenamed("cooldown_period", "nonsense"), ["site"])
    assert ScalingPolicy().override(buffer_ratio=0.1, cooldown_period=None).cooldown_period == 2
    with pytest.raises(ValueError):
        ScalingPolicy().override(nonsense=1)


def test_backtest_does_not_depend_on_blocks(spark):
    rng = np.random.default_rng(8)
    y = np.abs(rng.normal(20_000, 9_000, 400))
    df = forecast(spark, y, np.roll(y, 1))
    policy = ScalingPolicy(server_capacity=5000.0)

    def rows(size):
        made = CP.strategy_backtest(df, ["site"], policy, block_rows=size)
        return sorted(map(tuple, made.select("site", *CP.BACKTEST).collect()))

    assert rows(30) == rows(8192)


@pytest.mark.parametrize("size", [10, 8192])
def test_running_total(spark, size):
    y = list(range(1, 101))
    df = with_position(forecast(spark, y, y), ["site"])
    got = finance.running_total(df, "y", "total", ["site"], size).orderBy("ds").collect()
    assert [r.total for r in got] == np.cumsum(y).tolist()


def test_rows_with_missing_values_are_left_out_of_a_backtest(spark):
    df = forecast(spark, [1, 2, 3], [1, 2, 3]).withColumn("yhat", F.when(F.col("y") != 2, F.col("yhat")))
    assert CP.strategy_backtest(df, ["site"]).count() == 4
