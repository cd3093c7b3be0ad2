"""Standard scores per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .blocks import attach


def scaler_fit(train: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per series: ``<c>_mean`` and ``<c>_scale`` (population std, 1 where it is 0)."""
    stats = []
    for c in columns:
        std = F.stddev_pop(c)
        stats += [F.avg(c).alias(f"{c}_mean"), F.when(std == 0, 1.0).otherwise(std).alias(f"{c}_scale")]
    return train.groupBy(*keys).agg(*stats)


def scale(df: DataFrame, stats: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Replace ``columns`` by their standard scores under ``stats``."""
    wanted = [f"{c}_{part}" for c in columns for part in ("mean", "scale")]
    missing = [c for c in wanted if c not in stats.columns]
    if missing:
        raise ValueError(f"the scaler was fitted without {missing}")
    joined = attach(df, stats.select(*keys, *wanted), keys)
    scores = {c: (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_scale") for c in columns}
    return joined.withColumns(scores).drop(*wanted)


def unscale(df: DataFrame, stats: DataFrame, column: str, of: str, keys: Sequence[str] = ()) -> DataFrame:
    """Turn standard scores in ``column`` back into units of ``of``."""
    joined = attach(df, stats.select(*keys, f"{of}_mean", f"{of}_scale"), keys)
    back = F.col(column) * F.col(f"{of}_scale") + F.col(f"{of}_mean")
    return joined.withColumn(column, back).drop(f"{of}_mean", f"{of}_scale")
