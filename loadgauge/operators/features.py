"""Load table -> features: calendar, lags and rolling statistics of the target, past values only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import FEATURES, LAG_FEATURES, ROLL_FEATURES, FeatureConfig, interval_minutes
from ..functions.calendar import calendar_columns
from ..functions.timegrid import left_edge, minute_index
from .blocks import BLOCK, attach, home_rows, time_blocks

WEEK = 7 * 1440
ROLL = 4 * 60
LAG_COLUMNS, ROLL_COLUMNS = list(LAG_FEATURES), list(ROLL_FEATURES)


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns(F.col("ds")))


def _series_order(keys: Sequence[str]):
    return Window.partitionBy(*keys, BLOCK).orderBy("_minute")


def _lags(target: Column, keys: Sequence[str], minutes: int) -> dict[str, Column]:
    order = _series_order(keys)
    spans = zip(LAG_COLUMNS, (minutes, 60, 24 * 60, WEEK))
    return {name: F.first(target).over(order.rangeBetween(-span, -span)) for name, span in spans}


def _lags_and_rolls(rows: DataFrame, target: Column, keys: Sequence[str], minutes: int) -> DataFrame:
    """Lags, and rolling statistics from running aggregates at a cost per row that does not grow with the frame.

    Time is cut into pieces of 4 hours.  The 4 hours before a bucket are the end of one piece and the
    beginning of the next; both are running aggregates, one forward and one backward.
    """
    minute = F.col("_minute")
    piece = Window.partitionBy(*keys, BLOCK, "_piece")

    def running(order: Column) -> Column:
        so_far = piece.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return F.struct(
            F.count(target).over(so_far).alias("n"),
            F.avg(target).over(so_far).alias("mean"),
            F.var_pop(target).over(so_far).alias("var"),
            F.max(target).over(so_far).alias("top"),
        )

    # One shuffle by block serves the pieces of a block as well.
    halves = rows.repartition(*keys, BLOCK).withColumn("_piece", left_edge(minute, ROLL)).withColumns(
        {"_begin": running(minute.asc()), "_end": running(minute.desc())}
    )
    order = _series_order(keys)
    built = halves.withColumns(
        {
            **_lags(target, keys, minutes),
            "_a": F.first("_end").over(order.rangeBetween(-ROLL, -ROLL)),
            "_b": F.first("_begin").over(order.rangeBetween(-minutes, -minutes)),
        }
    )
    a, b = F.col("_a"), F.col("_b")
    # On a piece's first bucket the piece before is all there is to the window.
    alone = minute == F.col("_piece")
    size = F.lit(float(ROLL // minutes))
    whole = F.when(alone, a["n"]).otherwise(a["n"] + b["n"]) == ROLL // minutes
    mean = F.when(alone, a["mean"]).otherwise((a["n"] * a["mean"] + b["n"] * b["mean"]) / size)
    gap = b["mean"] - a["mean"]
    squares = F.when(alone, a["n"] * a["var"]).otherwise(
        a["n"] * a["var"] + b["n"] * b["var"] + gap * gap * a["n"] * b["n"] / size
    )
    top = F.when(alone, a["top"]).otherwise(F.greatest(a["top"], b["top"]))
    return built.withColumns(
        {
            "roll_mean_4h": F.when(whole, mean),
            "roll_std_4h": F.when(whole, F.sqrt(squares / (size - 1))),
            "roll_max_4h": F.when(whole, top),
        }
    ).drop("_piece", "_begin", "_end", "_a", "_b")


def lag_rolling_features(
    df: DataFrame, interval: str, keys: Sequence[str] = (), cfg: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Lags of 1 bucket, 1 h, 24 h and 7 d, and mean, sample std and max of the 4 h before a bucket.

    Frames are ranges of time, not of rows: a bucket missing from ``df`` leaves a NULL lag and voids
    the rolling window, exactly as if the grid had been restored with NULLs, without building the grid.
    One shuffle by (series, time block) serves all of it; no task holds more than ``block_days`` + 7
    days of one series.
    """
    minutes = interval_minutes(interval)
    target = F.col(cfg.target)
    # Rows with a NULL target are absent values.
    rows = df.filter(target.isNotNull()).withColumn("_minute", minute_index(F.col("ds")))
    built = _lags_and_rolls(time_blocks(rows, WEEK, cfg.block_days), target, keys, minutes)
    return home_rows(built).drop("_minute")


def clean_features(df: DataFrame, target: str = "intensity") -> DataFrame:
    """Drop rows without target, day lag or full 4 h window; what is still NULL becomes 0."""
    return df.na.drop(subset=[target, "lag_24h", "roll_mean_4h"]).na.fill(0)


def select_features(df: DataFrame, keys: Sequence[str] = (), target: str = "intensity") -> DataFrame:
    return df.select(*keys, "ds", target, *FEATURES)


def raw_features(
    load: DataFrame, interval: str, keys: Sequence[str] = (), cfg: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Feature columns before cleaning; NULL where the past is not known."""
    narrow = load.select(*keys, "ds", cfg.target)
    return select_features(calendar_features(lag_rolling_features(narrow, interval, keys, cfg)), keys, cfg.target)


def feature_table(
    load: DataFrame, interval: str, keys: Sequence[str] = (), cfg: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Cleaned load -> model input."""
    return clean_features(raw_features(load, interval, keys, cfg), cfg.target)


def context_tail(features: DataFrame, keys: Sequence[str] = (), cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The last days of a cleaned feature table (ds > max - days), kept as past of the next part.

    Reads ``features`` twice (its end, its rows); store it first when it is costly.
    """
    last = features.groupBy(*keys).agg(F.max("ds").alias("_last"))
    recent = F.col("ds") > F.col("_last") - F.make_dt_interval(F.lit(cfg.context_days))
    return attach(features, last, keys).filter(recent).select(*keys, "ds", cfg.target)


def context_union(context: DataFrame, test: DataFrame, keys: Sequence[str] = (), target: str = "intensity") -> DataFrame:
    """Context and test rows as one series; where both have a bucket the context's value stands.

    ``is_test`` marks buckets at or after the test part's own start.
    """
    both = context.select(*keys, "ds", target, F.lit(0).alias("_rank")).unionByName(
        test.select(*keys, "ds", target, F.lit(1).alias("_rank"))
    )
    return both.groupBy(*keys, "ds").agg(F.min_by(target, "_rank").alias(target))


def test_feature_table(
    context: DataFrame, test: DataFrame, interval: str, keys: Sequence[str] = (), cfg: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Features of the test part, its first rows looking back into ``context``.

    Only rows from the test part's own first bucket on are returned.
    """
    start = test.groupBy(*keys).agg(F.min("ds").alias("_start"))
    joined = context_union(context, test, keys, cfg.target)
    built = raw_features(joined, interval, keys, cfg)
    return clean_features(attach(built, start, keys).filter(F.col("ds") >= F.col("_start")).drop("_start"), cfg.target)


def time_split(df: DataFrame, at: str, ds: str = "ds") -> tuple[DataFrame, DataFrame]:
    """(before, from ``at`` on); never random."""
    edge = F.lit(at).cast("timestamp_ntz")
    return df.filter(F.col(ds) < edge), df.filter(F.col(ds) >= edge)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per (series, ds): the one with the highest ``order``.

    An aggregate, so duplicates are thinned out before the shuffle.
    """
    group = [*keys, "ds"]
    rest = [c for c in df.columns if c not in group]
    picked = df.groupBy(*group).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*group, *[F.col(f"_row.{c}").alias(c) for c in rest])
