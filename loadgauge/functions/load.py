"""Measures and predicates of a load bucket."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def is_client_error(status: Column) -> Column:
    return (status >= 400) & (status < 500)


def is_server_error(status: Column) -> Column:
    return status >= 500


def error_rate(client: Column, server: Column, requests: Column) -> Column:
    """Share of failed requests; the small constant keeps empty buckets at 0."""
    return (client + server) / (requests + F.lit(1e-8))


def intensity(total_bytes: Column, weight: float) -> Column:
    """Requests x mean bytes x weight, which is total bytes x weight."""
    return total_bytes * F.lit(float(weight))


def in_outage(ds: Column, outages: Sequence[tuple[str, str]]) -> Column:
    """TRUE when a bucket's left edge lies in an outage, both ends included."""
    spans = [ds.between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz")) for a, b in outages]
    return reduce(lambda x, y: x | y, spans, F.lit(False))


def clip_nonnegative(yhat: Column) -> Column:
    """Forecast with NULL as 0 and no value below 0."""
    return F.greatest(F.coalesce(yhat, F.lit(0.0)), F.lit(0.0))
