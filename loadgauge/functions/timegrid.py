"""Wall-clock time as whole minutes since 1970, free of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def minute_index(ts: Column) -> Column:
    """Minutes since 1970-01-01 00:00 of a TIMESTAMP_NTZ, BIGINT."""
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * F.lit(1440) + (F.hour(ts) * F.lit(60) + F.minute(ts)).cast("long")


def left_edge(minute: Column, minutes: int | Column) -> Column:
    """The bucket of ``minutes`` a minute falls in, named by its first minute."""
    width = F.lit(minutes) if isinstance(minutes, int) else minutes
    return minute - F.pmod(minute, width.cast("long"))


def to_timestamp(minute: Column) -> Column:
    """Inverse of :func:`minute_index`."""
    within = F.pmod(minute, F.lit(1440).cast("long"))
    days = F.expr(EPOCH) + F.make_dt_interval(((minute - within) / 1440).cast("int"))
    return days + F.make_dt_interval(F.lit(0), F.lit(0), within.cast("int"))
