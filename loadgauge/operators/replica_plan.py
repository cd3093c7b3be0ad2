"""The scaling controller: targets -> replicas, with scale-in held back by a cooldown.

A replica count depends on the one before, so the controller is a fold over a series and no window
function expresses it.  It is still run in parallel along the series.  The controller has few states
(replicas x cooldown), so a block of rows is a map from the state it is entered with to the state it
is left with:

1. each (series, row block) works out its map;
2. each series chains the maps of its blocks, one short array per block, which gives the state every
   block starts with;
3. each (series, row block) is replayed from its start state.

Steps 1 and 3 read the same shuffle.  A series of one block skips step 1's work.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..config import interval_minutes
from ..functions.timegrid import minute_index
from .blocks import BLOCK, POSITION, SERIES_ROWS, home_rows, in_block, row_blocks

BLOCK_ROWS = 8192

# Actions and reasons of a plan.
SCALE_OUT, SCALE_IN, HOLD = "scale_out", "scale_in", "hold"
ABOVE = "forecast above capacity threshold"
BELOW = "forecast below threshold and cooldown passed"
STABLE = "stable"

_LIMITS = ["_low", "_high", "_cool"]


def controller():
    """The controller's step function, for blocks and streams alike; local, so that workers need nothing but numpy and pandas."""

    def run(targets, alarms, gaps, replicas: int, counter: int, high: int, cool: int):
        """(replicas, replicas before, cooldown left of a held scale-in) per step, and the state after the last one.

        An alarm replaces the target by half again the current replicas.  A gap is the number of buckets missing
        before a step: nothing is decided in them, and they run the cooldown down.
        """
        now, before, waits = [], [], []
        for target, alarm, gap in zip(targets, alarms, gaps):
            counter = max(counter - gap, 0)
            goal = min(high, replicas * 3 // 2) if alarm else target
            before.append(replicas)
            waits.append(counter if goal < replicas else 0)
            if goal > replicas:
                replicas, counter = goal, cool
            else:
                replicas = goal if counter == 0 else replicas
                counter = max(counter - 1, 0)
            now.append(replicas)
        return now, before, waits, replicas, counter

    return run


def _with_gap(rows: DataFrame, keys: Sequence[str], interval: str | None) -> DataFrame:
    """Add the number of buckets missing before each row; rows carry the last one of the block before."""
    if interval is None:
        return rows.withColumn("_gap", F.lit(0))
    minute = minute_index(F.col("ds"))
    apart = (minute - F.lag(minute).over(in_block(keys))) / interval_minutes(interval) - 1
    return rows.withColumn("_gap", F.coalesce(F.greatest(apart, F.lit(0)), F.lit(0)).cast("int"))


def _block_maps(keys: list[str]):
    """Pandas function: the rows of one block -> its exit state for every entry state.

    A state is coded (replicas - low) * (cooldown + 1) + counter.  Entry states that have run
    together are carried on as one.
    """
    import numpy as np

    control = controller()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POSITION)
        head = pdf.iloc[0]
        low, high, cool = int(head["_low"]), int(head["_high"]), int(head["_cool"])
        block = int(head[BLOCK])
        codes = np.empty(0, dtype=np.int64)
        if not head["_final"]:
            states = (high - low + 1) * (cool + 1)
            every = np.arange(states if block else 1)
            replicas, counter = low + every // (cool + 1), every % (cool + 1)
            group = every
            steps = zip(pdf["_target"].tolist(), pdf["_alarm"].tolist(), pdf["_gap"].tolist())
            for i, (target, alarm, gap) in enumerate(steps):
                counter = np.maximum(counter - gap, 0)
                goal = np.minimum(high, replicas * 3 // 2) if alarm else np.full_like(replicas, target)
                out, held = goal > replicas, (goal < replicas) & (counter > 0)
                counter = np.where(out, cool, np.maximum(counter - 1, 0))
                replicas = np.where(held, replicas, goal)
                if i % 4 == 3:
                    merged, where = np.unique((replicas - low) * (cool + 1) + counter, return_inverse=True)
                    replicas, counter = low + merged // (cool + 1), merged % (cool + 1)
                    group = where[group]
                    if merged.size == 1:
                        break
            # From here on there is one state, if any rows are left.
            if replicas.size == 1:
                rest = list(zip(*steps)) or [(), (), ()]
                *_, one, wait = control(*rest, int(replicas[0]), int(counter[0]), high, cool)
                replicas, counter = np.array([one]), np.array([wait])
            codes = ((replicas - low) * (cool + 1) + counter)[group]
        out = pdf.iloc[:1][[*keys, BLOCK, *_LIMITS]].copy()
        out["_codes"] = [codes.astype("int32")]
        return out

    return run


def _chain(keys: list[str]):
    """Pandas function: the block maps of one series -> the state each block starts with."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLOCK)
        code, starts = 0, []
        for codes in pdf["_codes"]:
            starts.append(code)
            code = int(codes[code]) if len(codes) else code
        out = pdf[[*keys, BLOCK]].copy()
        width = pdf["_cool"] + 1
        out["_start"] = pdf["_low"] + pd.Series(starts, index=pdf.index) // width
        out["_counter"] = pd.Series(starts, index=pdf.index) % width
        return out

    return run


def _replay(columns: list[str]):
    """Pandas function: the rows of one block and its start state -> replicas per row."""
    control = controller()

    def run(rows: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(POSITION)
        replicas, counter = int(starts["_start"].iloc[0]), int(starts["_counter"].iloc[0])
        high, cool = int(rows["_high"].iloc[0]), int(rows["_cool"].iloc[0])
        steps = rows["_target"].tolist(), rows["_alarm"].tolist(), rows["_gap"].tolist()
        now, before, waits, _, _ = control(*steps, replicas, counter, high, cool)
        return rows[columns].assign(replicas=now, _before=before, _waits=waits)

    return run


def replica_plan(
    df: DataFrame,
    keys: Sequence[str] = (),
    target: str = "target",
    alarm: str | None = None,
    block_rows: int = BLOCK_ROWS,
    interval: str | None = None,
) -> DataFrame:
    """Add replicas, action and reason to rows that have a target, a position and a ``policy``.

    With an ``interval`` the buckets missing between rows run the cooldown down; without one the next row is the next bucket.

    Where ``alarm`` is TRUE the target is half again the current replicas instead.  The policy is used
    up: a struct per row is dear to hand to Python and back, and cheap to attach again.
    """
    keys = list(keys)
    carried = [c for c in df.columns if c not in ("policy", SERIES_ROWS, alarm)]
    rows = home_rows(_with_gap(row_blocks(df, 0 if interval is None else 1, block_rows).withColumn("_part", F.col(BLOCK)), keys, interval))
    rows = rows.withColumnRenamed("_part", BLOCK).select(
        *carried,
        BLOCK,
        (F.floor((F.col(SERIES_ROWS) - 1) / block_rows).cast("int") == F.col(BLOCK)).alias("_final"),
        F.col(target).cast("int").alias("_target"),
        (F.coalesce(F.col(alarm), F.lit(False)) if alarm else F.lit(False)).alias("_alarm"),
        "_gap",
        F.col("policy.min_replicas").alias("_low"),
        F.col("policy.max_replicas").alias("_high"),
        F.col("policy.cooldown_period").alias("_cool"),
    )
    schema = {f.name: f for f in rows.schema.fields}
    integer = T.IntegerType()

    def fields(names: Sequence[str], *more: T.StructField) -> T.StructType:
        return T.StructType([*[schema[n] for n in names], *more])

    maps = rows.groupBy(*keys, BLOCK).applyInPandas(
        _block_maps(keys),
        fields([*keys, BLOCK, *_LIMITS], T.StructField("_codes", T.ArrayType(integer))),
    )
    if keys:
        series = maps.groupBy(*keys)
    else:
        series = maps.groupBy(F.lit(0).alias("_all"))
    starts = series.applyInPandas(
        _chain(keys), fields([*keys, BLOCK], T.StructField("_start", integer), T.StructField("_counter", integer))
    )
    plan = (
        rows.groupBy(*keys, BLOCK)
        .cogroup(starts.groupBy(*keys, BLOCK))
        .applyInPandas(
            _replay(carried),
            fields(
                carried,
                T.StructField("replicas", integer),
                T.StructField("_before", integer),
                T.StructField("_waits", integer),
            ),
        )
    )
    return plan_actions(plan).drop("_before", "_waits")


def plan_actions(plan: DataFrame) -> DataFrame:
    """Name what the controller did; a held scale-in tells the cooldown that was left."""
    grew = F.col("replicas") > F.col("_before")
    shrank = F.col("replicas") < F.col("_before")
    waiting = F.format_string("cooldown active (%d)", F.col("_waits"))
    return plan.withColumns(
        {
            "action": F.when(grew, SCALE_OUT).when(shrank, SCALE_IN).otherwise(HOLD),
            "reason": F.when(grew, ABOVE).when(shrank, BELOW).when(F.col("_waits") > 0, waiting).otherwise(STABLE),
        }
    )
