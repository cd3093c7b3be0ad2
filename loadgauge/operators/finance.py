"""Cost, dropped demand and service level of replica plans (long tables, one row per strategy)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import capacity as C
from .blocks import BLOCK, POSITION, with_block_values
from .policy import of

REACTIVE, PREDICTIVE = "Reactive", "Predictive"


def with_cost(plan: DataFrame, hours: float | None = None) -> DataFrame:
    """Add dropped, infra, penalty and cost; ``hours`` per bucket makes the price an hourly one."""
    lost = C.dropped(F.col("y"), F.col("replicas"), of("server_capacity"))
    with_loss = plan.withColumn("dropped", lost)
    length = None if hours is None else F.lit(float(hours))
    infra, penalty, total = C.step_cost(
        F.col("replicas"), F.col("dropped"), of("server_cost"), of("sla_penalty"), length
    )
    return with_loss.withColumns({"infra": infra, "penalty": penalty, "cost": total})


def strategy_totals(backtest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cost, dropped and demand per strategy, and the share of demand dropped in percent."""
    sums = backtest.groupBy(*by, "strategy").agg(
        F.sum("cost").alias("total_cost"), F.sum("dropped").alias("total_dropped"), F.sum("y").alias("total_demand")
    )
    share = F.col("total_dropped") / F.col("total_demand") * 100
    return sums.withColumn("sla_violation", F.when(F.col("total_demand") > 0, share).otherwise(0.0))


def _per_strategy(column: str, strategy: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("strategy") == strategy, F.col(column))), F.lit(0.0))


def savings_report(backtest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reactive cost, predictive cost, what is saved, and that as percent of the reactive cost."""
    sums = backtest.groupBy(*by).agg(
        _per_strategy("cost", REACTIVE).alias("reactive_cost"),
        _per_strategy("cost", PREDICTIVE).alias("predictive_cost"),
    )
    saved = F.col("reactive_cost") - F.col("predictive_cost")
    return sums.withColumn("savings", saved).withColumn(
        "savings_pct", F.when(F.col("reactive_cost") > 0, F.col("savings") / F.col("reactive_cost") * 100).otherwise(0.0)
    )


def sla_report(backtest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Percent of demand served under each strategy, 100 without demand, and the difference."""
    sums = backtest.groupBy(*by).agg(
        _per_strategy("y", PREDICTIVE).alias("_demand"),
        _per_strategy("dropped", REACTIVE).alias("_reactive"),
        _per_strategy("dropped", PREDICTIVE).alias("_predictive"),
    )

    def served(lost: str) -> Column:
        return F.when(F.col("_demand") > 0, (1 - F.col(lost) / F.col("_demand")) * 100).otherwise(100.0)

    return sums.select(
        *by, served("_reactive").alias("reactive_sla"), served("_predictive").alias("predictive_sla")
    ).withColumn("sla_delta", F.col("predictive_sla") - F.col("reactive_sla"))


def running_total(df: DataFrame, column: str, name: str, keys: Sequence[str] = (), block_rows: int = 8192) -> DataFrame:
    """Running sum of ``column`` along each series.

    Summed inside row blocks; the blocks' own sums, a few per series, are added up to give each
    block's opening balance.  Reads a stored table, with positions, twice.
    """
    keys = list(keys)
    cut = df.withColumn(BLOCK, F.floor(F.col(POSITION) / block_rows).cast("long"))
    series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = series.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*keys, BLOCK).agg(F.sum(column).alias("_sum"))
    opening = sums.select(*keys, BLOCK, F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)).alias("_opening"))
    running = with_block_values(
        cut,
        opening,
        keys,
        POSITION,
        _inside=lambda window: F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return running.withColumn(name, F.col("_opening") + F.col("_inside")).drop("_opening", "_inside", BLOCK)


def unpivot_strategies(wide: DataFrame, labels: dict[str, str], name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Columns of a wide plan -> rows (strategy, ``name``), column names replaced by ``labels``."""
    long = wide.unpivot([*keys, "ds"], list(labels), "strategy", name)
    label = F.element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), F.col("strategy"))
    return long.withColumn("strategy", label)
