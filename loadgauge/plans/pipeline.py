"""Raw log -> load -> features -> predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..config import FeatureConfig, LoadConfig
from ..operators import buckets, features as FE
from ..session import stage
from ..sources import access_log


class Counts:
    """What stages read, dropped and kept: observed in the pass that writes their tables, and known once that has run."""

    def __init__(self):
        self._seen: list[tuple[str, Observation]] = []

    def _observed(self, stage_name: str, df: DataFrame, measures: Sequence[Column]) -> DataFrame:
        self._seen.append((stage_name, seen := Observation()))
        return df.observe(seen, *measures)

    def lines(self, stage_name: str, fields: DataFrame) -> DataFrame:
        return self._observed(stage_name, fields, access_log.line_measures())

    def buckets(self, stage_name: str, load: DataFrame, cfg: LoadConfig = LoadConfig()) -> DataFrame:
        return self._observed(stage_name, load, buckets.cleaning_measures(cfg))

    def rows(self, stage_name: str, df: DataFrame) -> DataFrame:
        return self._observed(stage_name, df, [F.count(F.lit(1)).alias("rows")])

    def get(self) -> dict[tuple[str, str], int]:
        return {(name, measure): n for name, seen in self._seen for measure, n in seen.get.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, measure, n); a handful of rows."""
        return spark.createDataFrame([(*k, n) for k, n in self.get().items()], "stage string, measure string, n long")


def cleaned_load(
    log: DataFrame, interval: str, keys: Sequence[str] = (), cfg: LoadConfig = LoadConfig()
) -> DataFrame:
    return buckets.clean_load(buckets.load_by_interval(log, interval, keys, cfg), cfg)


def features_of(
    log: DataFrame,
    interval: str,
    keys: Sequence[str] = (),
    load_cfg: LoadConfig = LoadConfig(),
    cfg: FeatureConfig = FeatureConfig(),
) -> DataFrame:
    """Feature table of one log."""
    return FE.feature_table(cleaned_load(log, interval, keys, load_cfg), interval, keys, cfg)


def features_by_interval(
    log: DataFrame,
    intervals: Sequence[str],
    keys: Sequence[str] = (),
    load_cfg: LoadConfig = LoadConfig(),
    cfg: FeatureConfig = FeatureConfig(),
) -> dict[str, DataFrame]:
    """Feature tables of several intervals; the log is read once, the load tables are stored by interval."""
    loads = buckets.clean_load(buckets.load_all_intervals(log, intervals, keys, load_cfg), load_cfg)
    stored = stage(loads, "loads", ("interval",))
    return {i: FE.feature_table(stored.filter(F.col("interval") == i).drop("interval"), i, keys, cfg) for i in intervals}


def train_test_features(
    log: DataFrame,
    split: str,
    interval: str,
    keys: Sequence[str] = (),
    load_cfg: LoadConfig = LoadConfig(),
    cfg: FeatureConfig = FeatureConfig(),
) -> tuple[DataFrame, DataFrame]:
    """(train, test) feature tables, stored.

    The two parts are bucketed on their own; the test part looks back into the last days of the
    cleaned training features.
    """
    before, after = FE.time_split(log, split, "timestamp")
    train = stage(features_of(before, interval, keys, load_cfg, cfg), "train-features")
    test_load = stage(cleaned_load(after, interval, keys, load_cfg).select(*keys, "ds", cfg.target), "test-load")
    context = FE.context_tail(train, keys, cfg)
    test = stage(FE.test_feature_table(context, test_load, interval, keys, cfg), "test-features")
    return train, test


def with_interval_name(predictions: DataFrame, interval: str) -> DataFrame:
    return predictions.withColumn("interval", F.lit(interval))
