"""Order-dependent work on a series without putting the series in one task.

Window functions need every row of a partition in one place, and one series may be all of the
data.  The helpers here cut a series into bounded blocks, hand each block the few rows before it
that its first rows look back on, and let the window run per (series, block):

* :func:`time_blocks` for windows that reach back a fixed *time*;
* :func:`with_position` + :func:`row_blocks` for windows that reach back a fixed number of *rows*.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.timegrid import minute_index

HOME = "_home"
BLOCK = "_block"
POSITION = "_pos"
SERIES_ROWS = "_rows"
DAY = 1440


def _with_overlap(df: DataFrame, at: Column, size: int, reach: int, last: Column | None = None) -> DataFrame:
    """Assign rows to blocks of ``size`` and copy a block's last ``reach`` rows to the next one."""
    if not 0 <= reach <= size:
        raise ValueError(f"a block of {size} cannot serve a look-back of {reach}")
    offset = F.pmod(at, F.lit(size).cast("long"))
    home = ((at - offset) / F.lit(size)).cast("long")
    copied = offset >= size - reach
    if last is not None:
        copied = copied & (at - offset + F.lit(size) <= last)
    blocks = F.when(copied, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn(HOME, home).withColumn(BLOCK, F.explode(blocks))


def time_blocks(df: DataFrame, reach_minutes: int, days: int, ds: str = "ds") -> DataFrame:
    """Blocks of ``days`` days, each with the rows of the ``reach_minutes`` before it."""
    return _with_overlap(df, minute_index(F.col(ds)), days * DAY, reach_minutes)


def row_blocks(df: DataFrame, reach_rows: int, size: int) -> DataFrame:
    """Blocks of ``size`` rows, each with the ``reach_rows`` rows before it; needs :func:`with_position`."""
    last = F.col(SERIES_ROWS) - F.lit(1)
    return _with_overlap(df, F.col(POSITION), size, reach_rows, last)


def home_rows(df: DataFrame) -> DataFrame:
    """Drop the copies again."""
    return df.filter(F.col(HOME) == F.col(BLOCK)).drop(HOME, BLOCK)


def attach(df: DataFrame, per_series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of a one-row-per-series table to every row of ``df``.

    Without series columns the table has one row and its values are scalar subqueries; with them it
    is an equi-join whose strategy Spark picks from the sizes it measures.
    """
    added = [c for c in per_series.columns if c not in keys]
    if not keys:
        return df.select("*", *[per_series.select(c).scalar().alias(c) for c in added])
    right = per_series.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *added)
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(right, condition, "left").drop(*[f"_r_{k}" for k in keys])


def with_block_values(
    df: DataFrame, per_block: DataFrame, keys: Sequence[str], order: str, **columns: Callable[[WindowSpec], Column]
) -> DataFrame:
    """Bring the columns of a one-row-per-block table to the rows of their (series, block).

    The block rows go through the shuffle the rows need anyway and sort ahead of them, so no join is
    needed.  ``columns`` adds further columns over the same window, in which a block's row comes first.
    """
    values = [c for c in per_block.columns if c not in (*keys, BLOCK)]
    both = df.withColumn("_head", F.lit(False)).unionByName(
        per_block.withColumn("_head", F.lit(True)), allowMissingColumns=True
    )
    window = Window.partitionBy(*keys, BLOCK).orderBy(F.desc("_head"), order)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    built = {c: F.first(c).over(so_far) for c in values} | {n: make(window) for n, make in columns.items()}
    return both.withColumns(built).filter(~F.col("_head")).drop("_head")


def with_position(df: DataFrame, keys: Sequence[str] = (), ds: str = "ds", days: int = 28) -> DataFrame:
    """Number each series' rows from 0 in time order, and give the series' row count.

    Rows are counted per (series, time block); adding up the few block counts of a series gives where
    each block starts.  ``df`` is read twice, so pass a stored table.
    """
    keys = list(keys)
    block = F.floor(minute_index(F.col(ds)) / F.lit(days * DAY)).cast("long")
    cut = df.withColumn(BLOCK, block)
    counts = cut.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = series.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *keys,
        BLOCK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(series).alias(SERIES_ROWS),
    )
    numbered = with_block_values(cut, starts, keys, ds, _at=lambda window: F.row_number().over(window))
    # The block's own row is number 1.
    return numbered.withColumn(POSITION, F.col("_start") + F.col("_at") - 2).drop("_start", "_at", BLOCK)


def in_block(keys: Sequence[str]):
    """Window of a (series, row block), in series order."""
    return Window.partitionBy(*keys, BLOCK).orderBy(POSITION)
