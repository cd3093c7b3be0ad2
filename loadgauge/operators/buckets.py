"""Access log -> regular load table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import LoadConfig, interval_minutes
from ..functions import load as L
from ..functions.timegrid import left_edge, minute_index, to_timestamp
from .blocks import DAY

COUNTS = ["y", "total_bytes", "error_4xx", "error_5xx"]
CHUNK = 1440


def request_counts(log: DataFrame, keys: Sequence[str], minutes: int) -> DataFrame:
    """Whole-number sums per (series, bucket) that has requests; rows without a time are in no bucket.

    Two-phase aggregation: a hot series or bucket is summed inside each map task before the shuffle.
    Integer sums make the result independent of how the rows are partitioned.
    """
    status = F.col("status")
    counts = (
        log.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, left_edge(minute_index(F.col("timestamp")), minutes).alias("_edge"))
        .agg(
            F.count("request").alias("y"),
            F.coalesce(F.sum("bytes"), F.lit(0).cast("long")).alias("total_bytes"),
            F.count_if(L.is_client_error(status)).alias("error_4xx"),
            F.count_if(L.is_server_error(status)).alias("error_5xx"),
        )
    )
    # Always true.  It keeps all four sums alive in every branch that reads this table, so that the
    # branches share one shuffle and the log is scanned once.
    return counts.filter(F.greatest(*COUNTS) >= 0)


def spans(edges: DataFrame, keys: Sequence[str], max_gap_days: int) -> DataFrame:
    """(series, _lo, _hi): the stretches of ``_edge`` values whose grid is filled, one per series unless days are far apart.

    A stretch ends with a day that is followed by more than ``max_gap_days`` days without rows, and another one begins with the next
    day that has rows.  Made of each series' distinct days in one aggregate: a few thousand numbers for decades.
    """
    lo, hi, days = F.col("_lo"), F.col("_hi"), F.col("_days")
    found = edges.groupBy(*keys).agg(
        F.min("_edge").alias("_lo"), F.max("_edge").alias("_hi"), F.array_sort(F.collect_set(left_edge(F.col("_edge"), DAY))).alias("_days")
    )
    pairs = F.greatest(F.size(days) - 1, F.lit(0))
    steps = F.zip_with(F.slice(days, F.lit(1), pairs), F.slice(days, F.lit(2), pairs), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    far = F.filter(steps, lambda s: s["b"] - s["a"] > F.lit((max_gap_days + 1) * DAY))
    begins = F.concat(F.array(lo), F.transform(far, lambda s: s["b"]))
    ends = F.concat(F.transform(far, lambda s: s["a"] + F.lit(DAY - 1)), F.array(hi))
    # An ungrouped min/max over no rows is one row of NULLs.
    stretches = found.filter(lo.isNotNull()).select(*keys, F.explode(F.arrays_zip(begins.alias("b"), ends.alias("e"))).alias("_s"))
    return stretches.select(*keys, F.col("_s.b").alias("_lo"), F.col("_s.e").alias("_hi"))


def long_gaps(edges: DataFrame, keys: Sequence[str], cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """(series, stretches): how many stretches a series' grid has, for the series that have more than one.

    ``edges`` has the minute of each row as ``_edge``, as :func:`request_counts` gives it.
    """
    return spans(edges, keys, cfg.max_gap_days).groupBy(*keys).agg(F.count(F.lit(1)).alias("stretches")).filter("stretches > 1")


def empty_edges(edges: DataFrame, keys: Sequence[str], max_gap_days: int, spread: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(series, width, _edge): the buckets of the grid (:func:`spans`) that no ``_edge`` falls in, at every width ``spread`` adds to a row.

    Only what is missing is made, between the edges of a day and between the days of a series, and nothing has to hold it afterwards: what
    a task keeps grows with the rows of ``edges``, not with the grid, which has many times as many when series are sparse.
    """
    width, found, days = F.col("width").cast("long"), F.col("_edges"), F.col("_days")
    by_day = edges.groupBy(*keys, left_edge(F.col("_edge"), DAY).alias("_day")).agg(F.array_sort(F.collect_set("_edge")).alias("_edges"))
    ends = F.struct(F.col("_day").alias("day"), F.element_at(found, 1).alias("first"), F.element_at(found, -1).alias("last"))
    by_series = by_day.groupBy(*keys).agg(F.array_sort(F.collect_list(ends)).alias("_days"))

    there = F.transform(found, lambda e: left_edge(e, width))
    within = F.array_except(F.sequence(F.element_at(there, 1), F.element_at(there, -1), width), there)
    inside = spread(by_day).withColumn("_edge", F.explode(within))

    pairs = F.greatest(F.size(days) - 1, F.lit(0))
    steps = F.zip_with(F.slice(days, F.lit(1), pairs), F.slice(days, F.lit(2), pairs), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    a, b = F.col("_s.a"), F.col("_s.b")
    after, before = left_edge(a["last"], width) + width, left_edge(b["first"], width) - width
    far = b["day"] - a["day"] > F.lit((max_gap_days + 1) * DAY)
    run = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    runs = F.when(far, F.array(run(after, a["day"] + F.lit(DAY) - width), run(b["day"], before))).otherwise(F.array(run(after, before)))
    between = spread(by_series.withColumn("_s", F.explode(steps))).withColumn("_r", F.explode(runs)).filter("_r.lo <= _r.hi")
    bounds = between.withColumns({"_lo": F.col("_r.lo"), "_hi": F.col("_r.hi")})
    made = spine(bounds, keys, width)
    return made.select(*inside.drop("_day", "_edges").columns).unionByName(inside.drop("_day", "_edges"))


def spine(bounds: DataFrame, keys: Sequence[str], minutes: Column) -> DataFrame:
    """Every bucket edge from ``_lo`` to ``_hi``, in two steps so that no row holds a long array."""
    width = minutes.cast("long")
    chunk = width * F.lit(CHUNK).cast("long")
    top = F.least(F.col("_hi"), F.col("_chunk") + chunk - width)
    return (
        bounds.withColumn("_chunk", F.explode(F.sequence("_lo", "_hi", chunk)))
        .withColumn("_edge", F.explode(F.sequence("_chunk", top, width)))
        .drop("_lo", "_hi", "_chunk")
    )


def measures(counts: DataFrame, keys: Sequence[str], cfg: LoadConfig) -> DataFrame:
    """Sums per bucket edge -> load columns."""
    y, total = F.col("y"), F.col("total_bytes")
    return counts.select(
        *keys,
        to_timestamp(F.col("_edge")).alias("ds"),
        *COUNTS[:2],
        F.coalesce(F.try_divide(total, y), F.lit(0.0)).alias("avg_bytes"),
        *COUNTS[2:],
    ).withColumns(
        {
            "error_rate": L.error_rate(F.col("error_4xx"), F.col("error_5xx"), y),
            "intensity": L.intensity(total, cfg.resource_weight),
            "is_downtime": L.in_outage(F.col("ds"), cfg.outages).cast("int"),
        }
    )


def load_by_interval(
    log: DataFrame, interval: str, keys: Sequence[str] = (), cfg: LoadConfig = LoadConfig()
) -> DataFrame:
    """Load per bucket; every bucket between a series' first and last request appears, empty ones as 0.

    But for gaps of more than ``cfg.max_gap_days`` days, which stay open (:func:`spans`).
    """
    return load_all_intervals(log, [interval], keys, cfg).drop("interval")


def load_all_intervals(
    log: DataFrame, intervals: Sequence[str], keys: Sequence[str] = (), cfg: LoadConfig = LoadConfig()
) -> DataFrame:
    """Load tables of several intervals, told apart by ``interval``, from one pass over the log.

    The log is summed once at the finest width; the wider tables are sums of those sums.
    """
    keys = list(keys)
    widths = {i: interval_minutes(i) for i in intervals}
    finest = min(widths.values())
    if any(w % finest for w in widths.values()):
        finest = 1
    base = request_counts(log, keys, finest)
    # One array literal per row: the interval's name and width.
    options = F.array(*[F.struct(F.lit(i).alias("interval"), F.lit(w).alias("width")) for i, w in widths.items()])
    width = F.col("width")

    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("_i", F.explode(options)).select("*", "_i.interval", "_i.width").drop("_i")

    group = [*keys, "interval"]
    counts = spread(base).withColumn("_edge", left_edge(F.col("_edge"), width)).select(*group, "_edge", *COUNTS)
    if set(widths.values()) != {finest}:
        counts = counts.groupBy(*group, "_edge").agg(*[F.sum(c).alias(c) for c in COUNTS])
    zeros = empty_edges(base, keys, cfg.max_gap_days, spread).withColumns({c: F.lit(0).cast("long") for c in COUNTS})
    counts = counts.unionByName(zeros.select(*group, "_edge", *COUNTS))
    return measures(counts, group, cfg)


def exclude_outages(load: DataFrame, cfg: LoadConfig = LoadConfig()) -> DataFrame:
    return load.filter(~L.in_outage(F.col("ds"), cfg.outages))


def bot_filter(load: DataFrame, cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """Keep buckets whose error rate is below the threshold."""
    return load.filter(F.col("error_rate") < cfg.bot_error_threshold)


def clean_load(load: DataFrame, cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """Outage filter, then bot filter, both on the finished buckets."""
    return bot_filter(exclude_outages(load, cfg), cfg)


def cleaning_measures(cfg: LoadConfig = LoadConfig()) -> list[Column]:
    """Counts of buckets: in, dropped as outage, dropped as bot traffic, and kept."""
    out = L.in_outage(F.col("ds"), cfg.outages)
    bot = F.col("error_rate") >= cfg.bot_error_threshold
    return [
        F.count(F.lit(1)).alias("buckets"),
        F.count_if(out).alias("outage_buckets"),
        F.count_if(~out & bot).alias("bot_buckets"),
        F.count_if(~out & ~bot).alias("kept_buckets"),
    ]


def cleaning_counts(load: DataFrame, keys: Sequence[str] = (), cfg: LoadConfig = LoadConfig()) -> DataFrame:
    return load.groupBy(*keys).agg(*cleaning_measures(cfg))


def spine_join(
    table: DataFrame, interval: str, keys: Sequence[str] = (), columns: Sequence[str] = ("intensity",), max_gap_days: int = LoadConfig.max_gap_days
) -> DataFrame:
    """Put a series back on its full grid, without gaps longer than ``max_gap_days``; buckets that were removed come back as NULL.

    ``table`` is read twice (its time span, its rows), so pass a stored table.
    """
    keys = list(keys)
    minutes = interval_minutes(interval)
    rows = table.select(*keys, minute_index(F.col("ds")).alias("_edge"), *columns)
    grid = spine(spans(rows, keys, max_gap_days), keys, F.lit(minutes))
    right = rows.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("_edge").alias("_r_edge"), *columns)
    condition = F.col("_edge") == F.col("_r_edge")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    joined = grid.join(right, condition, "left")
    return joined.select(*keys, to_timestamp(F.col("_edge")).alias("ds"), *columns)
