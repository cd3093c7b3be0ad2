"""A stream that has run in several batches gives what the batch operators give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadgauge.config import LoadConfig, ScalingPolicy
from loadgauge.operators import buckets as B
from loadgauge.operators.anomaly import look_back
from loadgauge.operators.blocks import with_position
from loadgauge.operators.policy import with_policy
from loadgauge.operators.replica_plan import replica_plan
from loadgauge.plans import capacity as CP, pipeline as P
from loadgauge.session import new_path, stage
from loadgauge.sources import adapters as A
from loadgauge.streaming import load as SL, stateful as ST

POLICY = ScalingPolicy(server_capacity=5000.0)
CUTS = ["2024-01-01", "2024-01-10", "2024-01-11", "2024-01-20", "2024-02-01"]


def in_slices(table, ds, path):
    """Write ``table`` as one file per span of time; yields after each."""
    for a, b in zip(CUTS, CUTS[1:]):
        part = table.filter((F.col(ds) >= F.lit(a).cast("timestamp_ntz")) & (F.col(ds) < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(path)
        yield


def run(spark, table, ds, make, name):
    """Run the stream once per slice; state and output carry over."""
    source, out, state = (new_path(spark, f"{name}-{x}") for x in ("source", "out", "state"))
    for _ in in_slices(table, ds, source):
        stream = spark.readStream.schema(table.schema).parquet(source)
        result = SL.run_available(make(stream), name, out, state)
    return result


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.fixture(scope="module")
def forecast(spark, small):
    made = P.features_of(A.events_log(spark, small), "15min", ["site"], LoadConfig(outages=A.OUTAGES))
    return stage(made.select("site", "ds", F.col("intensity").alias("y"), F.col("lag_24h").alias("yhat")), "forecast")


def test_closed_buckets_equal_the_batch(spark, small):
    log = A.events_log(spark, small)
    got = run(spark, log, "timestamp", lambda s: SL.stream_load(s, "15min", ["site"]), "load")
    last = log.agg(F.max("timestamp")).scalar()
    end = F.col("ds") + F.expr("INTERVAL 25 MINUTES")
    want = B.load_by_interval(log, "15min", ["site"]).filter((F.col("y") > 0) & (end <= last))
    columns = ["site", "ds", "y", "total_bytes", "avg_bytes", "error_4xx", "error_5xx", "error_rate", "intensity", "is_downtime"]
    assert rows(got, *columns) == rows(want, *columns)


def test_gaps_are_filled_across_batches(spark, small):
    load = B.load_by_interval(A.events_log(spark, small), "15min", ["site"])
    got = run(spark, load.filter("y > 0"), "ds", lambda s: SL.stream_fill(s, "15min", ["site"]), "fill")
    assert rows(got, *load.columns) == rows(load, *load.columns)


def test_anomalies_equal_the_batch(spark, forecast):
    got = run(spark, forecast, "ds", lambda s: ST.stream_anomaly(s, ["site"], POLICY), "anomaly")
    want = look_back(with_position(forecast, ["site"]), ["site"])
    assert rows(got, "site", "ds", "is_anomaly") == rows(want, "site", "ds", "is_anomaly")
    assert got.filter("is_anomaly").count() > 0


def test_plans_equal_the_batch(spark, forecast):
    got = run(spark, forecast, "ds", lambda s: ST.stream_replica_plan(s, ["site"], POLICY), "plan")
    want = CP.scaling_recommendation(forecast, ["site"], POLICY)
    columns = ["site", "ds", "recommended_replicas", "action", "reason"]
    assert rows(got, *columns) == rows(want, *columns)


def test_backtests_equal_the_batch(spark, forecast):
    got = run(spark, forecast, "ds", lambda s: ST.stream_backtest(s, ["site"], POLICY), "backtest")
    want = CP.strategy_backtest(forecast, ["site"], POLICY)
    columns = ["site", *CP.BACKTEST, "target", "action", "reason", "infra", "penalty"]
    assert rows(got, *columns) == rows(want, *columns)


def bucket(day, minute, y, yhat):
    return (datetime(2024, 1, day) + timedelta(minutes=minute), y, yhat)


SERIES = "ds timestamp_ntz, y double, yhat double"


def in_batches(spark, parts, make):
    """A file per part, the stream run after each."""
    source, out, state = (new_path(spark, f"parts-{x}") for x in ("source", "out", "state"))
    for part in parts:
        spark.createDataFrame(part, SERIES).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SERIES).parquet(source)
        result = SL.run_available(make(stream), "parts", out, state)
    return result


def in_parts():
    """First half, its end mixed with what comes next; rows that are late by hours; a gap of some hours; the rest in reverse."""
    rng = random.Random(4)
    every = [bucket(1, 15 * i, 100.0 * rng.randint(1, 400), 100.0 * rng.randint(1, 400)) for i in range(200) if not 120 <= i < 140]
    late = [(ds, 1.0, 10.0**6) for ds, _, _ in every[20:25]]
    shuffled = every[:64] + every[66:70], [*every[64:66], *every[70:100], *late], every[100:][::-1]
    return every, late, shuffled


def test_late_rows_and_gaps_leave_the_plan_as_it_is(spark):
    every, late, parts = in_parts()
    for interval in (None, "15min"):
        got = in_batches(spark, parts, lambda s: ST.stream_replica_plan(s, [], POLICY, "2 hours", interval))
        made, too_late = ST.split_late(got)
        policy = with_policy(with_position(stage(spark.createDataFrame(every, SERIES), "every")), POLICY)
        want = replica_plan(policy.withColumn("target", CP.predictive()), [], interval=interval, block_rows=64)
        closed = want.filter(F.col("ds") <= F.lit(every[-1][0] - timedelta(hours=2)))
        assert rows(made, "ds", "recommended_replicas", "action", "reason") == rows(closed, "ds", "replicas", "action", "reason")
        assert rows(too_late, "ds", "y", "yhat") == sorted(late)
        assert not any(got.filter("late").select("recommended_replicas", "action", "reason").first())


def test_gaps_run_the_cooldown_down(spark):
    steps = [bucket(1, 0, 1.0, 20000.0), bucket(1, 15, 1.0, 1.0), bucket(1, 60, 1.0, 1.0), bucket(1, 75, 1.0, 1.0)]
    for interval, want in ((None, [5, 5, 5, 1]), ("15min", [5, 5, 1, 1])):
        got = in_batches(spark, [steps[:2], steps[2:]], lambda s: ST.stream_replica_plan(s, [], POLICY, interval=interval))
        assert [r.recommended_replicas for r in got.orderBy("ds").collect()] == want


def test_anomalies_and_backtests_under_late_rows(spark):
    every, late, parts = in_parts()
    table = stage(spark.createDataFrame(every, SERIES), "every")
    closed = F.col("ds") <= F.lit(every[-1][0] - timedelta(hours=2))
    policy = POLICY.override(anomaly_threshold=1.5)
    made, too_late = ST.split_late(in_batches(spark, parts, lambda s: ST.stream_anomaly(s, [], policy, "2 hours")))
    want = look_back(with_position(table), threshold=1.5)
    assert rows(made, "ds", "is_anomaly") == rows(want.filter(closed), "ds", "is_anomaly")
    assert made.filter("is_anomaly").count() > 0 and rows(too_late, "ds", "y", "yhat") == sorted(late)
    made, too_late = ST.split_late(in_batches(spark, parts, lambda s: ST.stream_backtest(s, [], policy, "2 hours")))
    want = CP.strategy_backtest(table, [], policy)
    assert rows(made, *CP.BACKTEST, "action", "reason") == rows(want.filter(closed), *CP.BACKTEST, "action", "reason")
    assert too_late.count() == len(late)


def test_late_requests_are_accounted_for(spark):
    """Late, loaded and open requests are all requests, also of buckets that only late ones are in and of a NULL series."""
    t0, schema = datetime(2024, 1, 1), "site int, timestamp timestamp_ntz, request string, status int, bytes bigint"
    deliveries = [
        [(0, 0), (0, 1), (0, 40), (None, 2)],  # the watermark goes to 00:30
        [(0, 5), (None, 16), (0, 31), (0, 70)],  # 5 and 16 are in closed buckets
        [(0, 50), (1, 3), (0, 71)],  # now it stood at 01:00
    ]
    source, a, a_state, b, b_state = (new_path(spark, f"account-{x}") for x in range(5))
    for minutes in deliveries:
        rows_ = [(s, t0 + timedelta(minutes=m, seconds=1), "GET /", 200, 1) for s, m in minutes]
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        loaded = SL.run_available(SL.stream_load(stream, "15min", ["site"]), "a", a, a_state)
        received = SL.run_available(SL.stream_received(stream, "15min", ["site"]), "b", b, b_state)
    got = {(r.site, (r.ds - t0).seconds // 60): (r.received, r.loaded, r.late, r.still_open) for r in SL.load_account(received, loaded, "15min", ["site"]).collect()}
    assert got == {
        (0, 0): (3, 2, 1, 0), (0, 30): (2, 2, 0, 0), (0, 45): (1, 0, 1, 0), (0, 60): (2, 0, 0, 2),
        (None, 0): (1, 1, 0, 0), (None, 15): (1, 0, 1, 0), (1, 0): (1, 0, 1, 0),
    }


def test_load_does_not_depend_on_the_session_zone(spark):
    """An hour that New York skipped in 2024 is an hour like any other in the log."""
    log = spark.sql(
        """SELECT timestamp, 'GET / HTTP/1.0' AS request, 200 AS status, 5L AS bytes FROM VALUES
        (TIMESTAMP_NTZ'2024-03-10 01:31:10'), (TIMESTAMP_NTZ'2024-03-10 02:31:20'), (TIMESTAMP_NTZ'2024-03-10 03:31:30'),
        (TIMESTAMP_NTZ'2024-03-11 00:00:00') AS t(timestamp)"""
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        source, out, state = (new_path(spark, f"zone-{x}") for x in ("source", "out", "state"))
        for part in (log.filter("timestamp < TIMESTAMP_NTZ'2024-03-11 00:00:00'"), log.filter("timestamp >= TIMESTAMP_NTZ'2024-03-11 00:00:00'")):
            part.coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(log.schema).parquet(source)
            result = SL.run_available(SL.stream_load(stream, "15min"), "zone", out, state)
        got = [(r.d, r.y) for r in result.selectExpr("CAST(ds AS STRING) AS d", "y").orderBy("d").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [(f"2024-03-10 0{h}:30:00", 1) for h in (1, 2, 3)]
