"""Text access logs -> typed rows, and an account of the lines that are none."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import logline as G

# Why a line is no record.
NO_MATCH = "no match"
BAD_BYTES = "bytes not a number"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files as ``value`` rows; files are split, nothing is held whole."""
    return spark.read.text(path)


def _fields(lines: DataFrame, value: str) -> DataFrame:
    """Add ``_f``, the five fields of a line in log format and NULL for other lines, and ``_bytes``.

    The regular expression is most of the work on a log, so it must run once per line.  Exploding a
    one-element array makes its result a column of its own, which filters refer to and do not repeat.
    """
    line, unfolded = F.col("_line"), F.col("_unfolded")
    return (
        lines.withColumn("_line", G.readable(F.col(value)))
        .withColumn("_unfolded", F.explode(F.array(G.unfold(line))))
        .withColumn("_f", F.when(unfolded != line, F.split(unfolded, "\n")))
        .withColumn("_bytes", G.bytes_count(_field(4)))
    )


def _field(i: int) -> Column:
    return F.get(F.col("_f"), F.lit(i))


def _records(
    lines: DataFrame, value: str, keep: tuple[str, ...], name: str, time: Column, seen: Callable[[DataFrame], DataFrame] = lambda fields: fields
) -> DataFrame:
    record = F.struct(
        _field(0).alias("host"),
        time.alias(name),
        _field(2).alias("request"),
        _field(3).cast("int").alias("status"),
        F.col("_bytes").alias("bytes"),
    )
    # Exploded again, so that conditions on the record's columns do not reach back into its making.
    found = F.explode(F.when(F.col("_bytes").isNotNull(), F.array(record)))
    return seen(_fields(lines, value)).withColumn("_time", _field(1)).select(*keep, found.alias("_r")).select(*keep, "_r.*")


def parse_lines(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """(host, timestamp_text, request, status, bytes) of every line in log format.

    Everything is built-in columns on the scan's own tasks.  ``keep`` names further columns of
    ``lines`` to carry along.
    """
    return _records(lines, value, keep, "timestamp_text", F.col("_time"))


def access_log(
    lines: DataFrame, value: str = "value", keep: tuple[str, ...] = (), seen: Callable[[DataFrame], DataFrame] = lambda fields: fields
) -> DataFrame:
    """Lines -> access_log rows; a record whose time is no time stays, with NULL.

    ``seen`` gets the table of all lines on the way, to count them by :func:`line_measures` in the same pass.
    """
    return _records(lines, value, keep, "timestamp", G.normalize_time(F.col("_time")), seen)


def _reason() -> Column:
    return F.when(F.col("_f").isNull(), NO_MATCH).when(F.col("_bytes").isNull(), BAD_BYTES)


def rejects(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The lines :func:`parse_lines` leaves out, with the reason."""
    return _fields(lines, value).select(*keep, F.col(value), _reason().alias("reason")).filter(F.col("reason").isNotNull())


def line_measures() -> list[Column]:
    """Counts of lines: read, parsed, rejected by reason, and parsed ones without a usable time."""
    reason, timed = _reason(), G.normalize_time(_field(1))
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(reason.isNull()).alias("parsed"),
        F.count_if(F.coalesce(reason == NO_MATCH, F.lit(False))).alias("no_match"),
        F.count_if(F.coalesce(reason == BAD_BYTES, F.lit(False))).alias("bad_bytes"),
        F.count_if(reason.isNull() & timed.isNull()).alias("bad_time"),
    ]


def line_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row of :func:`line_measures`."""
    return _fields(lines, value).agg(*line_measures())
