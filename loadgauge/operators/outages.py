"""Outages as a table: spans of time per series, or for all series, which may overlap and cross days.

A span is listed under each of its days, so buckets find theirs by an equi-join on (series, day); the lists of a day are gathered first, so
that no bucket is doubled however many outages it lies in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

START, END = "start", "end"
_DAY, _SPANS = "_day", "_spans"


def daily_spans(outages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(series, day, spans): the distinct outages that touch a day. Spans without both ends, or that end before they start, are none."""
    real = outages.where(F.col(START) <= F.col(END)).select(*keys, START, END)
    days = F.sequence(F.col(START).cast("date"), F.col(END).cast("date"))
    each = real.withColumn(_DAY, F.explode(days))
    return each.groupBy(*keys, _DAY).agg(F.collect_set(F.struct(START, END)).alias(_SPANS))


def _lies_in(spans: Column, ds: Column) -> Column:
    return F.coalesce(F.exists(spans, lambda s: ds.between(s[START], s[END])), F.lit(False))


def flag_outages(load: DataFrame, outages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``load`` with ``is_downtime`` set where a bucket's left edge lies in an outage, both ends included.

    ``outages`` has (start, end) and those of ``keys`` that tell whose outage it is; without any it is everyone's. A NULL series is one of
    its own, as everywhere else.
    """
    on = [k for k in keys if k in outages.columns]
    spans = daily_spans(outages, on).withColumnsRenamed({c: f"_o{c}" for c in (*on, _DAY)})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_o{k}")) for k in on], F.col("ds").cast("date") == F.col(f"_o{_DAY}"))
    joined = load.drop("is_downtime").join(spans, same, "left")
    columns = [c for c in load.columns if c != "is_downtime"]
    return joined.select(*columns, _lies_in(F.col(_SPANS), F.col("ds")).cast("int").alias("is_downtime"))


def exclude_outages(load: DataFrame, outages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return flag_outages(load, outages, keys).filter(F.col("is_downtime") == 0)
