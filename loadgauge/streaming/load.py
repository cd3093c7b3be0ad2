"""Load buckets from a stream of access-log rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import LoadConfig, interval_minutes
from ..functions import load as L
from ..functions.timegrid import left_edge, minute_index, to_timestamp
from ..operators import buckets as B
from ..session import new_path


def stream_load(
    log: DataFrame, interval: str, keys: Sequence[str] = (), delay: str = "10 minutes", cfg: LoadConfig = LoadConfig()
) -> DataFrame:
    """Load per closed bucket; a bucket closes when the watermark passes its end.

    Watermarks want TIMESTAMP, so wall clocks are counted in seconds since 1970 and back, in whatever zone
    the session is.  Buckets without requests are not emitted.
    """
    status = F.col("status")
    wall = F.col("timestamp")
    seconds = minute_index(wall) * 60 + F.second(wall)
    timed = log.filter(wall.isNotNull()).withColumn("timestamp", F.timestamp_seconds(seconds))
    counts = (
        timed.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", f"{interval_minutes(interval)} minutes"), *keys)
        .agg(
            F.count("request").alias("y"),
            F.coalesce(F.sum("bytes"), F.lit(0).cast("long")).alias("total_bytes"),
            F.count_if(L.is_client_error(status)).alias("error_4xx"),
            F.count_if(L.is_server_error(status)).alias("error_5xx"),
        )
    )
    edge = F.floor(F.unix_seconds(F.col("window.start")) / 60).cast("long")
    return B.measures(counts.select(*keys, edge.alias("_edge"), *B.COUNTS), keys, cfg)


def stream_received(log: DataFrame, interval: str, keys: Sequence[str] = ()) -> DataFrame:
    """Requests per bucket and micro-batch, none left out: (series, ds, y, last), ``last`` being the latest second of them.

    Run it beside :func:`stream_load` on the same source.  The rows of a micro-batch share their time of arrival, which is the event
    time here, so that state holds the buckets of one micro-batch only.
    """
    edge = left_edge(minute_index(F.col("timestamp")), interval_minutes(interval))
    timed = log.filter(F.col("timestamp").isNotNull()).withColumns({"_edge": edge, "_arrived": F.current_timestamp()})
    counts = timed.withWatermark("_arrived", "0 seconds").groupBy("_arrived", *keys, "_edge")
    made = counts.agg(F.count("request").alias("y"), F.max(F.date_trunc("second", "timestamp").cast("timestamp_ntz")).alias("last"))
    return made.select(*keys, to_timestamp(F.col("_edge")).alias("ds"), "y", "last")


def load_account(received: DataFrame, loaded: DataFrame, interval: str, keys: Sequence[str] = (), delay: str = "10 minutes") -> DataFrame:
    """(series, ds, received, loaded, late, still_open): where each bucket's requests went; late + loaded + open = received.

    ``received`` and ``loaded`` are what :func:`stream_received` and :func:`stream_load` have written of the same source.  Requests of a
    bucket that the watermark had closed before they came are late; those of buckets it has not closed are open.
    """
    keys, no = list(keys), F.lit(0).cast("long")
    watermark = received.agg((F.max("last") - F.expr(f"INTERVAL {delay}")).alias("at")).scalar()
    both = received.select(*keys, "ds", F.col("y").alias("received"), no.alias("loaded")).unionByName(
        loaded.select(*keys, "ds", no.alias("received"), F.col("y").alias("loaded"))
    )
    sums = both.groupBy(*keys, "ds").agg(F.sum("received").alias("received"), F.sum("loaded").alias("loaded"))
    closed = F.col("ds") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(interval_minutes(interval))) <= watermark
    missing = F.col("received") - F.col("loaded")
    return sums.withColumns({"late": F.when(closed, missing).otherwise(no), "still_open": F.when(closed, no).otherwise(missing)})


def _fill(keys: list[str], minutes: int):
    """State: the minute of the last bucket seen."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).set_index("_edge").sort_index()
        seen = state.get[0] if state.exists else int(rows.index[0]) - minutes
        last = max(int(rows.index[-1]), seen)
        state.update((last,))
        # A bucket that comes late after all is passed on, not dropped.
        edges = rows.index.union(range(seen + minutes, last + minutes, minutes))
        counts = rows.drop(columns=keys).reindex(edges, fill_value=0)
        counts.index.name = "_edge"
        yield counts.reset_index().assign(**dict(zip(keys, key)))

    return step


def stream_fill(load: DataFrame, interval: str, keys: Sequence[str], cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """Add the empty buckets to a stream of closed load buckets.

    A gap is filled when the bucket after it arrives, so a series reaches up to its last closed bucket
    with requests, and up to there equals the batch table.  Buckets come in time order from batch to
    batch, as :func:`stream_load` closes them.
    """
    keys = list(keys)
    counts = load.select(*keys, minute_index(F.col("ds")).alias("_edge"), *B.COUNTS)
    state = T.StructType([T.StructField("last", T.LongType())])
    step = _fill(keys, interval_minutes(interval))
    filled = counts.groupBy(*keys).applyInPandasWithState(step, counts.schema, state, "append", GroupStateTimeout.NoTimeout)
    return B.measures(filled, keys, cfg)


def run_available(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run a stream over what its source holds now, into parquet, and read the result.

    Give ``path`` and ``checkpoint`` to go on where an earlier run stopped.
    """
    spark = stream.sparkSession
    path = path or new_path(spark, name)
    checkpoint = checkpoint or new_path(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
