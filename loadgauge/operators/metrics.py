"""Forecast quality over long prediction tables (series, interval, model, ds, y, yhat)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..config import WARMUP_ROWS
from ..functions.load import clip_nonnegative
from .blocks import POSITION, SERIES_ROWS, attach, with_position


def clip_predictions(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("yhat", clip_nonnegative(F.col("yhat")))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which NULL equals NULL; the columns of ``left``, then the others of ``right``."""
    named = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(and_, [left[c].eqNullSafe(named[f"_right_{c}"]) for c in on])
    return left.join(named, same, "inner").drop(*[f"_right_{c}" for c in on])


def predictions_align(actual: DataFrame, predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pair each prediction with the actual of its own bucket; buckets only one side has drop out.

    A NULL series key is a series of its own, as everywhere else.
    """
    return null_safe_join(predictions, actual, [*keys, "ds"])


def common_rows(predictions: DataFrame, keys: Sequence[str], models: int) -> DataFrame:
    """Keep the buckets all ``models`` models predict, so that they are scored on the same rows."""
    group = [*keys, "interval", "ds"]
    both = predictions.groupBy(*group).agg(F.count_distinct("model").alias("_models")).filter(F.col("_models") == models)
    return null_safe_join(predictions, both.drop("_models"), group)


def warmup_column(rows: Mapping[str, int]) -> Column:
    cut = F.lit(0)
    for interval, n in rows.items():
        cut = F.when(F.col("interval") == interval, n).otherwise(cut)
    return cut


def warmup_cut(
    predictions: DataFrame, keys: Sequence[str] = (), rows: Mapping[str, int] = WARMUP_ROWS
) -> DataFrame:
    """Drop each series' first rows, unless it has no more than those.  Reads a stored table twice."""
    numbered = with_position(predictions, [*keys, "interval", "model"])
    cut = warmup_column(rows)
    return numbered.filter((F.col(SERIES_ROWS) <= cut) | (F.col(POSITION) >= cut)).drop(POSITION, SERIES_ROWS)


def positive_mape(y: Column, yhat: Column) -> Column:
    """Mean absolute percentage error over the rows with demand; 0 if there are none."""
    return F.coalesce(F.avg(F.when(y > 0, F.abs((y - yhat) / y))) * 100, F.lit(0.0))


def forecast_metrics(predictions: DataFrame, by: Sequence[str] = ("interval", "model")) -> DataFrame:
    """rmse, mse, mae and mape per group: one partial aggregation."""
    y, yhat = F.col("y"), F.col("yhat")
    miss = y - yhat
    mse = F.avg(miss * miss)
    return predictions.groupBy(*by).agg(
        F.sqrt(mse).alias("rmse"),
        mse.alias("mse"),
        F.avg(F.abs(miss)).alias("mae"),
        positive_mape(y, yhat).alias("mape"),
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Best model first within each interval; intervals sort as text."""
    return metrics.orderBy("interval", "rmse", "model")


def forecast_mae(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return points.groupBy(*by).agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"))


def horizon_limit(df: DataFrame, horizon: int | None, keys: Sequence[str] = ()) -> DataFrame:
    """Each series' first ``horizon`` rows; None or a number below 1 keeps all."""
    if not horizon or horizon < 1:
        return df
    return with_position(df, keys).filter(F.col(POSITION) < horizon).drop(POSITION, SERIES_ROWS)


def backfill_head(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows without a prediction take the series' first one; a series without any takes 0."""
    made = predictions.filter(F.col("yhat").isNotNull())
    first = made.groupBy(*keys).agg(F.min_by("yhat", "ds").alias("_first"))
    filled = attach(predictions, first, keys)
    return filled.withColumn("yhat", F.coalesce("yhat", "_first", F.lit(0.0))).drop("_first")


def pivot_predictions(predictions: DataFrame, models: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One column per model next to the actual."""
    y = F.first("y", ignorenulls=True).alias("y")
    columns = [F.first(F.when(F.col("model") == m, F.col("yhat")), ignorenulls=True).alias(m) for m in models]
    return predictions.groupBy(*keys, "ds").agg(y, *columns)
