"""Parameters of the pipeline; every default can be replaced per call."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

# Intervals, models and the forecast target the query surface accepts.
INTERVALS = ("1min", "5min", "15min")
TARGET = "intensity"

# Model names a request may use -> the model kind that answers it here.
MODELS = {"prophet": "additive_seasonal", "xgboost": "boosted_tree", "lstm": "sequence"}
BASELINES = {"naive": "lag_1step", "seasonal_day": "lag_24h", "seasonal_week": "lag_7d"}

# Feature columns in table order.
CALENDAR_FEATURES = ("hour_sin", "hour_cos", "day_sin", "day_cos", "is_weekend")
LAG_FEATURES = ("lag_1step", "lag_1h", "lag_24h", "lag_7d")
ROLL_FEATURES = ("roll_mean_4h", "roll_std_4h", "roll_max_4h")
FEATURES = CALENDAR_FEATURES + LAG_FEATURES + ROLL_FEATURES

# Rows dropped before scoring, one day of buckets.  ``15min`` may also be
# scored with 288, the figure older reports of 15-minute models were made with.
WARMUP_ROWS = {"1min": 1440, "5min": 288, "15min": 96}
WARMUP_ROWS_COMPAT = {"1min": 1440, "5min": 288, "15min": 288}


def interval_minutes(interval: str) -> int:
    """``'15min'`` -> 15.  The interval must divide an hour, so that every bucket edge is on one grid."""
    digits = interval.removesuffix("min")
    if digits == interval or not digits.isdigit() or int(digits) == 0 or 60 % int(digits):
        raise ValueError(f"interval must be 'Nmin' with N dividing 60, got {interval!r}")
    return int(digits)


def model_kind(name: str) -> str:
    """The model a request's name stands for; our own names are accepted as they are."""
    kind = MODELS.get(name, name)
    if kind not in {*MODELS.values(), *BASELINES}:
        raise ValueError(f"unknown model {name!r}")
    return kind


@dataclass(frozen=True)
class LoadConfig:
    """Bucketing and cleaning.  ``outages`` holds inclusive (start, end) wall-clock strings.

    Days without any request are filled with empty buckets if no more than ``max_gap_days`` lie between two days with requests: one
    absurd date must not fill thousands of years.
    """

    resource_weight: float = 1.2
    bot_error_threshold: float = 0.8
    outages: tuple[tuple[str, str], ...] = (("1995-07-28 13:25:00", "1995-08-03 05:25:00"),)
    max_gap_days: int = 3660


@dataclass(frozen=True)
class FeatureConfig:
    target: str = TARGET
    context_days: int = 8
    block_days: int = 28


@dataclass(frozen=True)
class ScalingPolicy:
    """Capacity and cost of one replica, and how the controller moves."""

    server_capacity: float = 5_000_000.0
    server_cost: float = 0.05
    sla_penalty: float = 0.0001
    min_replicas: int = 1
    max_replicas: int = 200
    buffer_ratio: float = 0.25
    cooldown_period: int = 2
    anomaly_threshold: float = 3.0
    anomaly_window: int = 24
    reactive_buffer: float = 1.2

    def override(self, **values) -> "ScalingPolicy":
        """Replace the fields given as non-null; unknown names are an error."""
        known = {f.name for f in fields(self)}
        unknown = set(values) - known
        if unknown:
            raise ValueError(f"unknown policy fields: {sorted(unknown)}")
        return replace(self, **{k: v for k, v in values.items() if v is not None})


@dataclass(frozen=True)
class SeasonalConfig:
    """Additive model: a trend that bends at changepoints + daily and weekly Fourier terms + the feature columns.

    Changepoints lie in the first ``changepoint_range`` of the training part's time.
    """

    daily_order: int = 4
    weekly_order: int = 3
    ridge: float = 1e-3
    changepoints: int = 12
    changepoint_range: float = 0.8
    changepoint_ridge: float = 0.05
    interval_z: float = 1.96


@dataclass(frozen=True)
class BoostedTreeConfig:
    rounds: int = 1000
    max_depth: int = 6
    learning_rate: float = 0.01
    row_sample: float = 0.8
    column_sample: str = "0.8"
    seed: int = 42
    validation_days: int = 3
    patience: int = 50


@dataclass(frozen=True)
class SequenceConfig:
    n_lags: int = 30
    ridge: float = 1.0


@dataclass(frozen=True)
class Settings:
    """Everything a run of the jobs needs to know."""

    intervals: tuple[str, ...] = INTERVALS
    series: tuple[str, ...] = ()
    load: LoadConfig = LoadConfig()
    features: FeatureConfig = FeatureConfig()
    policy: ScalingPolicy = ScalingPolicy()
    seasonal: SeasonalConfig = SeasonalConfig()
    trees: BoostedTreeConfig = BoostedTreeConfig()
    sequence: SequenceConfig = SequenceConfig()

    @classmethod
    def from_dict(cls, values: dict) -> "Settings":
        """Sections named like the fields above, each with the fields of its class; the rest keeps its default."""
        known = {f.name: f.default for f in fields(cls)}
        unknown = set(values) - set(known)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        given = {}
        for name, value in values.items():
            if name in ("intervals", "series"):
                given[name] = tuple(value)
            else:
                if "outages" in value:
                    value = {**value, "outages": tuple(tuple(o) for o in value["outages"])}
                given[name] = replace(known[name], **value)
        return cls(**given)
