"""What a bucket's decision may look back on: residual anomalies and the demand before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .blocks import POSITION, home_rows, in_block, row_blocks

BLOCK_ROWS = 8192


def _spike(window, rows: int, threshold: float) -> Column:
    """Residual above 0 and more than ``threshold`` population deviations from the mean of the last ``rows``."""
    e = F.col("_residual")
    frame = window.rowsBetween(-(rows - 1), 0)
    mean, std = F.avg(e).over(frame), F.stddev_pop(e).over(frame)
    z = F.try_divide(F.abs(e - mean), std)
    flagged = (F.col(POSITION) >= rows - 1) & (std > 0) & (z > threshold) & (e > 0)
    return F.coalesce(flagged, F.lit(False))


def look_back(
    df: DataFrame,
    keys: Sequence[str] = (),
    threshold: float = 3.0,
    window: int = 24,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``is_anomaly`` and ``previous`` (the row before's demand, NULL on the first row).

    Expects positions (:func:`blocks.with_position`) and columns y, yhat.  One shuffle by
    (series, row block) serves both; a block carries the ``window`` - 1 rows before it.
    """
    cut = row_blocks(df.withColumn("_residual", F.col("y") - F.col("yhat")), max(window - 1, 1), block_rows)
    order = in_block(keys)
    built = cut.withColumns(
        {"is_anomaly": _spike(order, window, threshold), "previous": F.lag("y", 1).over(order)}
    )
    return home_rows(built).drop("_residual")


def previous_demand(df: DataFrame, first: str = "y") -> DataFrame:
    """Fill the first row's missing ``previous``: with its own demand (replay) or forecast (``yhat``)."""
    return df.withColumn("previous", F.coalesce("previous", first))


def anomaly_rows(df: DataFrame) -> DataFrame:
    return df.filter("is_anomaly")
