"""Replica targets and cost of one bucket.

Each function takes the policy's numbers as columns, so that one job can serve series with
different policies.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ceil_clip(x: Column, low: Column, high: Column) -> Column:
    """Next whole number, held within [low, high]."""
    return F.least(F.greatest(F.ceil(x), low.cast("long")), high.cast("long")).cast("int")


def reactive_target(previous: Column, capacity: Column, factor: Column, low: Column, high: Column) -> Column:
    """Replicas for the load seen one bucket ago plus a fixed margin."""
    return ceil_clip(previous / capacity * factor, low, high)


def predictive_target(yhat: Column, capacity: Column, buffer: Column, low: Column, high: Column) -> Column:
    """Replicas for the forecast load plus a buffer."""
    return ceil_clip(yhat / capacity * (F.lit(1.0) + buffer), low, high)


def reactive_plan_simple(previous: Column, capacity: Column, factor: Column) -> Column:
    """Reactive target with a floor of one replica, no ceiling and no cooldown."""
    return F.greatest(F.ceil(previous / capacity * factor), F.lit(1).cast("long")).cast("int")


def dropped(actual: Column, replicas: Column, capacity: Column) -> Column:
    """Demand beyond what the replicas can serve."""
    return F.greatest(F.lit(0.0), actual - replicas * capacity)


def step_cost(replicas: Column, lost: Column, cost: Column, penalty: Column, hours: Column | None = None):
    """(infrastructure, penalty, total) of a bucket; ``hours`` turns an hourly price into one per bucket."""
    infra = replicas * cost if hours is None else replicas * cost * hours
    fine = lost * penalty
    return infra, fine, infra + fine


def normalized_demand(actual: Column, capacity: Column) -> Column:
    return actual / capacity
