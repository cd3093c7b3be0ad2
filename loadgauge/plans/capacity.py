"""Predictions -> replica plans, their cost, and the two request-shaped queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import ScalingPolicy, interval_minutes, model_kind
from ..functions import capacity as C
from ..functions.load import clip_nonnegative
from ..operators import finance
from ..operators.anomaly import BLOCK_ROWS, look_back, previous_demand
from ..operators.blocks import POSITION, with_position
from ..operators.metrics import horizon_limit
from ..operators.policy import of, policy_join, with_policy
from ..operators.replica_plan import replica_plan


def reactive() -> Column:
    return C.reactive_target(
        F.col("previous"), of("server_capacity"), of("reactive_buffer"), of("min_replicas"), of("max_replicas")
    )


def predictive() -> Column:
    return C.predictive_target(
        F.col("yhat"), of("server_capacity"), of("buffer_ratio"), of("min_replicas"), of("max_replicas")
    )


# A strategy is its target column and whether anomalies override it.
STRATEGIES: dict[str, tuple[Callable[[], Column], bool]] = {
    finance.REACTIVE: (reactive, False),
    finance.PREDICTIVE: (predictive, True),
}


def _policies(df: DataFrame, keys: Sequence[str], policy: ScalingPolicy, overrides: DataFrame | None) -> DataFrame:
    return with_policy(df, policy) if overrides is None else policy_join(df, overrides, keys, policy)


def strategy_backtest(
    predictions: DataFrame,
    keys: Sequence[str] = (),
    policy: ScalingPolicy = ScalingPolicy(),
    overrides: DataFrame | None = None,
    strategies: dict[str, tuple[Callable[[], Column], bool]] = STRATEGIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Run each strategy over a stored forecast table (series, ds, y, yhat): replicas and cost per bucket.

    Rows without demand or forecast are dropped first.  One anomaly check serves all strategies.
    """
    rows = with_position(predictions.na.drop(subset=["y", "yhat"]), keys)
    seen = look_back(rows, keys, policy.anomaly_threshold, policy.anomaly_window, block_rows)
    ready = _policies(previous_demand(seen), keys, policy, overrides)
    options = F.array(
        *[
            F.struct(
                F.lit(name).alias("strategy"),
                target().alias("target"),
                (F.col("is_anomaly") if alarmed else F.lit(False)).alias("alarm"),
            )
            for name, (target, alarmed) in strategies.items()
        ]
    )
    long = ready.withColumn("_s", F.explode(options)).select("*", "_s.strategy", "_s.target", "_s.alarm").drop("_s")
    plan = replica_plan(long, [*keys, "strategy"], "target", "alarm", block_rows)
    return finance.with_cost(_policies(plan, keys, policy, overrides))


BACKTEST = ["ds", "y", "is_anomaly", "strategy", "replicas", "cost", "dropped"]


def forecast_points(
    predictions: DataFrame, interval: str, model: str, horizon: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """First ``horizon`` buckets of a model's stored forecasts: ds, yhat (NULL as 0, not below 0), y."""
    interval_minutes(interval)
    chosen = predictions.filter((F.col("interval") == interval) & (F.col("model") == model_kind(model)))
    points = chosen.select(*keys, "ds", clip_nonnegative(F.col("yhat")).alias("yhat"), "y")
    return horizon_limit(points, horizon, keys)


def scaling_recommendation(
    points: DataFrame,
    keys: Sequence[str] = (),
    policy: ScalingPolicy = ScalingPolicy(),
    overrides: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Replica plan with actions and reasons for forecast points (a stored table)."""
    rows = _policies(with_position(points, keys), keys, policy, overrides).withColumn("target", predictive())
    plan = replica_plan(rows, keys, "target", None, block_rows)
    return plan.withColumnRenamed("replicas", "recommended_replicas").drop("target", POSITION)


def prorated_costs(
    points: DataFrame,
    interval: str,
    keys: Sequence[str] = (),
    policy: ScalingPolicy = ScalingPolicy(),
    hours: float | None = None,
) -> DataFrame:
    """Recommended and simple reactive plan side by side, priced per hour, one row per strategy.

    ``points`` is a stored table of forecast points.  ``hours`` replaces the length of a bucket; older
    reports of 15-minute plans were priced with 5 / 60.
    """
    hours = interval_minutes(interval) / 60 if hours is None else hours
    plan = scaling_recommendation(points, keys, policy)
    rows = with_position(points, keys)
    before = with_policy(previous_demand(look_back(rows, keys, window=2), "yhat"), policy)
    simple = C.reactive_plan_simple(F.col("previous"), of("server_capacity"), of("reactive_buffer"))
    columns = [*keys, "ds", "y", "yhat", "replicas", "strategy"]
    reactive_rows = before.withColumns({"replicas": simple, "strategy": F.lit(finance.REACTIVE)}).select(*columns)
    predictive_rows = (
        plan.withColumnRenamed("recommended_replicas", "replicas")
        .withColumn("strategy", F.lit(finance.PREDICTIVE))
        .select(*columns)
    )
    return finance.with_cost(with_policy(reactive_rows.unionByName(predictive_rows), policy), hours)
