"""Anomaly flags, replica plans and backtests over streams of forecast rows (series, ds, y, yhat), in event-time order.

A series' rows wait in its state until its clock, the newest time seen in the series less ``delay``, has passed them; a series that lags
behind the others has its own time.  Rows that the clock has passed are stepped through in order of time, whatever batches they came
in, so results are those of the batch operators.  The rows of the last ``delay`` wait for the series to go on.  A row that is not newer than the last one stepped through is late: it changes nothing and is handed on
with ``late`` set and without results (:func:`split_late`).

State per series: the last and the newest time, the rows still waiting (those of ``delay``), and what the operator needs of the past
(residuals, the last demand, replicas and cooldown of each strategy).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import ScalingPolicy, interval_minutes
from ..functions.timegrid import minute_index, to_timestamp
from ..operators import finance
from ..operators.policy import with_policy
from ..operators.replica_plan import controller, plan_actions
from ..plans.capacity import predictive, reactive

AT, LATE, SERIES = "_at", "late", "_series"
_LONGS, _DOUBLES = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())

# A strategy is its target, whether that follows the row before, and whether anomalies override it.
STRATEGIES = {finance.REACTIVE: (lambda: reactive(), True, False), finance.PREDICTIVE: (lambda: predictive(), False, True)}


def _spikes(window: int, threshold: float) -> Callable:
    """A function of the residuals before (at most ``window`` - 1) and the new ones: the new ones' flags, and those to keep."""
    import numpy as np

    def flags(before: list[float], new: list[float]) -> tuple[list[bool], list[float]]:
        every = np.array([*before, *new])
        found = np.zeros(len(every), bool)
        if len(every) >= window:
            recent = np.lib.stride_tricks.sliding_window_view(every, window)
            spread, e = recent.std(axis=1), every[window - 1 :]
            away = np.abs(e - recent.mean(axis=1))
            found[window - 1 :] = (spread > 0) & (e > 0) & (away > threshold * spread)
        return found[len(before) :].tolist(), every[len(every) - min(len(every), window - 1) :].tolist()

    return flags


def _in_order(keys: list[str], columns: list[str], results: list[str], delay: int, advance: Callable, blank: tuple) -> Callable:
    """The step of a series: ``advance`` gets (rows now due, last time, memory) and gives (results by row, memory)."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, newest, held, memory = (None, None, None, blank)
        if state.exists:
            last, newest, *rest = state.get
            held, memory = rest[: len(columns)], tuple(rest[len(columns) :])
        new = pd.concat([b[columns] for b in batches])
        late = new[new[AT] <= last] if last is not None else new[:0]
        new = new[new[AT] > last] if last is not None else new
        if held is not None and len(held[0]):
            new = pd.concat([pd.DataFrame(dict(zip(columns, held))), new])
        new = new.sort_values(AT, kind="stable")
        newest = max([int(m) for m in new[AT].iloc[-1:]] + ([] if newest is None else [newest]))
        due, wait = new[new[AT] <= newest - delay], new[new[AT] > newest - delay]
        made = []
        if len(due):
            done, memory = advance(due, last, memory)
            made.append(done.assign(**{LATE: False}))
            last = int(due[AT].iloc[-1])
        if len(late):
            made.append(late.assign(**{r: None for r in results}, **{LATE: True}))
        state.update((last, newest, *[wait[c].tolist() for c in columns], *memory))
        for part in made:
            yield part.assign(**dict(zip(keys, key)))

    return step


def _ordered(rows: DataFrame, keys: Sequence[str], results: list[T.StructField], memory: list[T.StructField], advance, blank, delay: str) -> DataFrame:
    """``rows`` have a minute AT and numbers; the result has keys, these, the results and LATE."""
    given = list(keys)
    if not given:
        rows, keys = rows.withColumn(SERIES, F.lit(0)), [SERIES]
    keys = list(keys)
    fields = {f.name: f for f in rows.schema.fields}
    columns = [c for c in fields if c not in keys]
    kinds = {T.LongType(): _LONGS, T.DoubleType(): _DOUBLES}
    state = T.StructType(
        [T.StructField("last", T.LongType()), T.StructField("newest", T.LongType()), *[T.StructField(c, kinds[fields[c].dataType]) for c in columns], *memory]
    )
    out = T.StructType([*[fields[k] for k in keys], *[T.StructField(c, fields[c].dataType) for c in columns], *results, T.StructField(LATE, T.BooleanType())])
    names, order = [r.name for r in results], [f.name for f in out.fields]
    step = _in_order(keys, columns, names, _minutes(rows, delay), advance, blank)

    def run(key, batches, held):
        for part in step(key, batches, held):
            yield part[order]

    made = rows.groupBy(*keys).applyInPandasWithState(run, out, state, "append", GroupStateTimeout.NoTimeout)
    return made if given else made.drop(SERIES)


def _minutes(df: DataFrame, delay: str) -> int:
    """The whole minutes of an interval such as '2 hours'."""
    made = df.sparkSession.range(1).select((F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {delay}")) / 60).alias("m"))
    return int(made.first().m)


def _with_minute(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    return predictions.select(*keys, minute_index(F.col("ds")).alias(AT), *[F.col(c).cast("double").alias(c) for c in ("y", "yhat")])


def _with_time(made: DataFrame, keys: Sequence[str]) -> DataFrame:
    return made.select(*keys, to_timestamp(F.col(AT)).alias("ds"), *[c for c in made.columns if c not in (*keys, AT)])


def split_late(made: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The results, and the rows that came too late to have one (series, ds, y, yhat)."""
    return made.filter(~F.col(LATE)).drop(LATE), made.filter(LATE).select(*[c for c in made.columns[: made.columns.index("yhat") + 1]])


def stream_anomaly(predictions: DataFrame, keys: Sequence[str] = (), policy: ScalingPolicy = ScalingPolicy(), delay: str = "0 minutes") -> DataFrame:
    """Add ``is_anomaly`` and ``late`` to a stream of forecast rows; rows without demand or forecast are left out, buckets that are
    missing don't count among the last ones."""
    flags = _spikes(policy.anomaly_window, policy.anomaly_threshold)

    def advance(due, last, memory):
        found, kept = flags(memory[0], (due["y"] - due["yhat"]).tolist())
        return due.assign(is_anomaly=found), (kept,)

    rows = _with_minute(predictions, keys).na.drop(subset=["y", "yhat"])
    result, memory = T.StructField("is_anomaly", T.BooleanType()), T.StructField("residuals", _DOUBLES)
    return _with_time(_ordered(rows, keys, [result], [memory], advance, ([],), delay), keys)


def _gap_counter(interval: str | None) -> Callable:
    width = interval_minutes(interval) if interval else 0

    def gaps(minutes: list[int], last: int | None) -> list[int]:
        before = [minutes[0] if last is None else last, *minutes[:-1]]
        return [max((m - b) // width - 1, 0) if width else 0 for m, b in zip(minutes, before)]

    return gaps


_PLAN = [T.StructField(n, T.LongType()) for n in ("replicas", "_before", "_waits")]


def stream_replica_plan(
    predictions: DataFrame, keys: Sequence[str] = (), policy: ScalingPolicy = ScalingPolicy(), delay: str = "0 minutes", interval: str | None = None
) -> DataFrame:
    """Replica plan with actions and reasons over a stream of forecast rows, and ``late``.

    With an ``interval`` buckets that are missing run the cooldown down, as in the batch plan.
    """
    control, gaps = controller(), _gap_counter(interval)
    low, high, cool = policy.min_replicas, policy.max_replicas, policy.cooldown_period

    def advance(due, last, memory):
        targets, at = due["_target"].astype(int).tolist(), due["_at"].astype(int).tolist()
        now, before, waits, *after = control(targets, [False] * len(due), gaps(at, last), *memory, high, cool)
        return due.assign(replicas=now, _before=before, _waits=waits), tuple(after)

    rows = with_policy(_with_minute(predictions, keys), policy).withColumn("_target", predictive().cast("long")).drop("policy")
    memory = [T.StructField("now", T.LongType()), T.StructField("counter", T.LongType())]
    made = _with_time(_ordered(rows, keys, _PLAN, memory, advance, (low, 0), delay), keys)
    named = plan_actions(made.withColumn("replicas", F.col("replicas").cast("int"))).withColumnRenamed("replicas", "recommended_replicas")
    unknown = {c: F.when(~F.col(LATE), F.col(c)) for c in ("action", "reason")}
    return named.withColumns(unknown).drop("_before", "_waits", "_target")


def stream_backtest(
    predictions: DataFrame,
    keys: Sequence[str] = (),
    policy: ScalingPolicy = ScalingPolicy(),
    delay: str = "0 minutes",
    interval: str | None = None,
    strategies: dict[str, tuple[Callable, bool, bool]] = STRATEGIES,
) -> DataFrame:
    """Every strategy side by side over a stream of forecast rows: a row per bucket and strategy with replicas, action, reason and cost.

    One state holds the residuals that raise the alarm, the demand before and where each strategy stands.  Late rows have no strategy.
    """
    control, gaps, flags = controller(), _gap_counter(interval), _spikes(policy.anomaly_window, policy.anomaly_threshold)
    low, high, cool = policy.min_replicas, policy.max_replicas, policy.cooldown_period
    names, plans = list(strategies), list(strategies.values())

    def advance(due, last, memory):
        residuals, previous, *states = memory
        alarms, residuals = flags(residuals, (due["y"] - due["yhat"]).tolist())
        steps, kept, ends, parts = gaps(due["_at"].astype(int).tolist(), last), [], [], []
        for i, (name, (_, follows, alarmed)) in enumerate(zip(names, plans)):
            targets = due[f"_t{i}"].astype(int).tolist()
            if follows:  # the target that the row before asks for; the first row's own stands in for it
                targets, end = [previous[i] if last is not None else targets[0], *targets[:-1]], targets[-1]
            else:
                end = 0
            now, before, waits, *after = control(targets, alarms if alarmed else [False] * len(due), steps, states[0][i], states[1][i], high, cool)
            parts.append(due.assign(is_anomaly=alarms, strategy=name, target=targets, replicas=now, _before=before, _waits=waits))
            kept.append(end)
            ends.append(after)
        return pd.concat(parts), (residuals, kept, *[list(x) for x in zip(*ends)])

    rows = _with_minute(predictions, keys).na.drop(subset=["y", "yhat"])
    rows = with_policy(rows.withColumn("previous", F.col("y")), policy)
    rows = rows.withColumns({f"_t{i}": target().cast("long") for i, (target, _, _) in enumerate(plans)}).drop("policy", "previous")
    results = [T.StructField("is_anomaly", T.BooleanType()), T.StructField("strategy", T.StringType()), T.StructField("target", T.LongType()), *_PLAN]
    memory = [T.StructField("residuals", _DOUBLES), *[T.StructField(n, _LONGS) for n in ("previous", "now", "counter")]]
    blank = ([], [0] * len(names), [low] * len(names), [0] * len(names))
    made = _with_time(_ordered(rows, keys, results, memory, advance, blank, delay), keys).drop(*[f"_t{i}" for i in range(len(names))])
    whole = made.withColumns({c: F.col(c).cast("int") for c in ("target", "replicas")})
    named = plan_actions(with_policy(whole, policy))
    costed = finance.with_cost(named.withColumns({c: F.when(~F.col(LATE), F.col(c)) for c in ("action", "reason")}))
    return costed.withColumn("dropped", F.when(~F.col(LATE), F.col("dropped"))).drop("_before", "_waits", "policy")
