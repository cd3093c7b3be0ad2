"""Scaling policies as data: one ``policy`` struct per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, functions as F

from ..config import ScalingPolicy
from .blocks import attach


def policy_struct(policy: ScalingPolicy) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in asdict(policy).items()])


def with_policy(df: DataFrame, policy: ScalingPolicy = ScalingPolicy()) -> DataFrame:
    """The same policy for every row."""
    return df.withColumn("policy", policy_struct(policy))


def policy_join(
    df: DataFrame, overrides: DataFrame, keys: Sequence[str], policy: ScalingPolicy = ScalingPolicy()
) -> DataFrame:
    """A policy per series: non-NULL columns of ``overrides`` (one row per series) replace the defaults."""
    defaults = asdict(policy)
    given = [c for c in overrides.columns if c not in keys]
    unknown = set(given) - set(defaults)
    if unknown:
        raise ValueError(f"unknown policy fields: {sorted(unknown)}")
    renamed = overrides.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in given])
    values = []
    for name, value in defaults.items():
        default = F.lit(value)
        kind = {float: "double", int: "int"}[type(value)]
        chosen = F.coalesce(F.col(f"_o_{name}").cast(kind), default) if name in given else default
        values.append(chosen.alias(name))
    return attach(df, renamed, keys).withColumn("policy", F.struct(*values)).drop(*[f"_o_{c}" for c in given])


def of(name: str) -> Column:
    return F.col(f"policy.{name}")
