"""Buckets: edges, empty buckets, outages, sums, and how often the log is read."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadgauge.config import LoadConfig, interval_minutes
from loadgauge.functions.timegrid import left_edge, minute_index, to_timestamp
from loadgauge.operators import buckets as B, outages as OU
from loadgauge.sources import adapters as A

T0 = datetime(2024, 1, 12, 13, 0)
SCHEMA = "site int, host string, timestamp timestamp_ntz, request string, status int, bytes bigint"


def log(spark, rows):
    return spark.createDataFrame([(s, "h", t, "GET /", status, b) for s, t, status, b in rows], SCHEMA)


def test_grid_is_filled_and_left_closed(spark):
    rows = [(0, T0, 200, 10), (0, T0 + timedelta(minutes=14, seconds=59), 404, 5), (0, T0 + timedelta(minutes=45), 500, 7)]
    got = B.load_by_interval(log(spark, rows), "15min").orderBy("ds").collect()
    assert [(r.ds, r.y, r.total_bytes, r.error_4xx, r.error_5xx) for r in got] == [
        (T0, 2, 15, 1, 0), (T0 + timedelta(minutes=15), 0, 0, 0, 0), (T0 + timedelta(minutes=30), 0, 0, 0, 0),
        (T0 + timedelta(minutes=45), 1, 7, 0, 1),
    ]
    assert got[0].avg_bytes == 7.5 and got[0].intensity == 15 * 1.2 and got[1].avg_bytes == 0.0


def test_each_series_has_its_own_span(spark):
    rows = [(0, T0, 200, 1), (0, T0 + timedelta(hours=1), 200, 1), (1, T0 + timedelta(hours=5), 200, 1), (None, T0, 200, 1)]
    got = B.load_by_interval(log(spark, rows), "15min", ["site"]).groupBy("site").count().collect()
    assert {r.site: r["count"] for r in got} == {0: 5, 1: 1, None: 1}


def test_outage_is_tested_on_the_left_edge(spark):
    cfg = LoadConfig(outages=(("2024-01-12 13:25:00", "2024-01-12 14:00:00"),))
    rows = [(0, T0, 200, 1), (0, T0 + timedelta(hours=2), 200, 1)]
    load = B.load_by_interval(log(spark, rows), "15min", [], cfg)
    kept = [r.ds.strftime("%H:%M") for r in B.exclude_outages(load, cfg).orderBy("ds").collect()]
    assert kept == ["13:00", "13:15", "14:15", "14:30", "14:45", "15:00"]
    assert load.filter("is_downtime = 1").count() == 3


def test_bot_filter_is_strict(spark):
    rows = [(0, T0, 404, 1)] * 8 + [(0, T0, 200, 1)] * 2 + [(0, T0 + timedelta(minutes=15), 500, 1)]
    load = B.load_by_interval(log(spark, rows), "15min")
    # 8 / (10 + 1e-8) is just below 0.8, 1 / (1 + 1e-8) is not.
    assert [r.y for r in B.bot_filter(load).collect()] == [10]


def test_rows_without_time_are_in_no_bucket(spark):
    assert B.load_by_interval(log(spark, [(0, None, 200, 1), (0, T0, 200, 1)]), "5min").count() == 1
    assert B.load_by_interval(log(spark, [(0, None, 200, 1)]), "5min").count() == 0


def test_wider_buckets_sum_the_narrow_ones(spark, small):
    tables = B.load_all_intervals(A.events_log(spark, small), ["1min", "5min", "15min"], ["site"])
    sums = tables.groupBy("interval").agg(*[F.sum(c).alias(c) for c in B.COUNTS]).collect()
    assert len({tuple(r)[1:] for r in sums}) == 1
    assert sums[0].y == A.table(spark, small, "events").count()


def test_result_does_not_depend_on_partitioning(spark, small):
    def rows(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        table = B.load_by_interval(A.events_log(spark, small).repartition(int(partitions)), "15min", ["site"])
        return sorted(map(tuple, table.collect()))

    try:
        assert rows("1") == rows("8")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("keys", [[], ["site"]])
def test_the_log_is_scanned_once(spark, small, keys):
    load = B.clean_load(B.load_all_intervals(A.events_log(spark, small), ["1min", "15min"], keys))
    plan = final_plan(load)
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nothing_holds_the_grid_of_sparse_series(spark, small):
    """What is missing is made last, so no aggregate, sort or exchange has the grid's rows."""
    load = B.load_by_interval(A.events_log(spark, small), "60min", ["host"], LoadConfig(max_gap_days=1))
    above, _, below = final_plan(load).partition("Union")
    assert not any(step in above for step in ("Aggregate", "Exchange", "Sort")) and "Generate" in below


def expected_grid(rows, width, gap_days):
    """(series, minute, requests, bytes) of every bucket, made in Python."""
    out, series = set(), {s for s, *_ in rows}
    for s in series:
        minutes = sorted(int((t - datetime(1970, 1, 1)).total_seconds()) // 60 for x, t, _, _ in rows if x == s)
        days = sorted({m - m % 1440 for m in minutes})
        edges = {m - m % width for m in (minutes[0], minutes[-1])}
        for a, b in zip(days, days[1:]):
            edges |= set(range(a, a + 1440, width)) if b - a > (gap_days + 1) * 1440 else set(range(a, b, width))
        edges |= set(range(days[-1], days[-1] + 1440, width))
        for e in edges:
            if minutes[0] - minutes[0] % width <= e <= minutes[-1]:
                inside = [b for x, t, _, b in rows if x == s and 0 <= int((t - datetime(1970, 1, 1)).total_seconds()) // 60 - e < width]
                out.add((s, e, len(inside), sum(inside)))
    return out


@pytest.mark.parametrize("intervals", [["60min"], ["30min", "20min"], ["5min", "15min", "60min"]])
def test_every_bucket_of_the_grid_is_there_once(spark, intervals):
    """Requests at the first and last minute of days, twice at once, before 1970, of a null series, with gaps just within and beyond the limit."""
    at = lambda d, h=0, m=0: datetime(2024, 1, 1) + timedelta(days=d, hours=h, minutes=m)
    times = {
        0: [at(0, 23, 59), at(0, 23, 59), at(1), at(3, 12, 1), at(6, 7, 29), at(6, 23, 59)], 1: [at(0), at(20)], 2: [at(5, 5, 5)],
        3: [datetime(1969, 12, 30, 23, 59), datetime(1970, 1, 1, 0, 1)], None: [at(0, 3), at(0, 3, 59), at(2, 1), at(9), at(9, 0, 20)],
    }
    rows = [(s, t, 200, 10 * i + 1) for s, ts in times.items() for i, t in enumerate(ts)]
    for gap in (1, 30):
        got = B.load_all_intervals(log(spark, rows), intervals, ["site"], LoadConfig(max_gap_days=gap))
        got = got.select("interval", "site", minute_index(F.col("ds")).alias("e"), "y", "total_bytes").collect()
        want = {(i, *r) for i in intervals for r in expected_grid(rows, interval_minutes(i), gap)}
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_only_needed_columns_are_read(spark, small):
    plan = final_plan(B.load_by_interval(A.events_log(spark, small), "15min", ["site"]))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan
    assert "PushedFilters: [IsNotNull(ts)]" in plan


def test_spine_restores_removed_buckets_as_null(spark):
    table = spark.createDataFrame([(T0, 1.0), (T0 + timedelta(minutes=30), 2.0)], "ds timestamp_ntz, intensity double")
    got = B.spine_join(table, "15min").orderBy("ds").collect()
    assert [r.intensity for r in got] == [1.0, None, 2.0]


def test_long_spines_are_cut_into_short_arrays(spark):
    bounds = spark.range(1).select(F.lit(0).cast("long").alias("_lo"), F.lit(1440 * 400 * 5).cast("long").alias("_hi"))
    edges = B.spine(bounds, [], F.lit(5))
    row = edges.agg(F.count("*").alias("n"), F.count_distinct("_edge").alias("d"), F.max("_edge").alias("top")).first()
    assert row.n == row.d == 1440 * 400 + 1 and row.top == 1440 * 400 * 5


def test_an_absurd_date_does_not_fill_the_time_in_between(spark):
    far = datetime(9999, 12, 31, 23, 59)
    rows = [(0, T0, 200, 1), (0, T0 + timedelta(days=3), 200, 2), (0, far, 200, 4), (1, T0, 200, 8)]
    for interval, width in (("15min", 15), ("1min", 1)):
        got = B.load_by_interval(log(spark, rows), interval, ["site"]).filter("site = 0").orderBy("ds").collect()
        day = 1440 // width
        # From the first request to the end of the last day before the gap, and the whole of the far day.
        assert len(got) == 4 * day - T0.hour * 60 // width + day
        assert [(r.ds, r.y, r.total_bytes) for r in got if r.y] == [
            (T0, 1, 1), (T0 + timedelta(days=3), 1, 2), (far - timedelta(minutes=far.minute % width), 1, 4)
        ]
        assert sum(r.y for r in got) == 3
    edges = B.request_counts(log(spark, rows), ["site"], 1)
    assert [tuple(r) for r in B.long_gaps(edges, ["site"]).collect()] == [(0, 2)]


def test_a_gap_as_long_as_allowed_is_filled(spark):
    rows = [(0, T0, 200, 1), (0, T0 + timedelta(days=3), 200, 1)]
    filled, cut = (B.load_by_interval(log(spark, rows), "15min", [], LoadConfig(max_gap_days=n)) for n in (2, 1))
    assert (filled.count(), cut.count()) == (3 * 96 + 1, (96 - 52) + 53)


def test_spine_join_leaves_long_gaps_open(spark):
    table = spark.createDataFrame([(T0, 1.0), (datetime(9999, 1, 1), 2.0)], "ds timestamp_ntz, intensity double")
    got = B.spine_join(table, "15min")
    assert got.count() == (96 - 52) + 1 and got.agg(F.sum("intensity")).first()[0] == 3.0


@pytest.mark.parametrize("text", ["1969-12-31 23:59:59", "1970-01-01 00:00:00", "2024-02-29 12:34:56", "9999-12-31 23:59:59"])
def test_minute_index_round_trip(spark, text):
    ts = F.lit(text).cast("timestamp_ntz")
    row = spark.range(1).select(
        to_timestamp(minute_index(ts)).cast("string").alias("t"), left_edge(minute_index(ts), 15).alias("e")
    ).first()
    assert row.t == text[:17] + "00" and row.e % 15 == 0


def test_interval_names():
    assert interval_minutes("15min") == 15
    for bad in ("7min", "0min", "15", "1h", "min"):
        with pytest.raises(ValueError):
            interval_minutes(bad)


def test_outages_from_a_table(spark):
    """Overlapping, repeated, over midnight, of nobody, backwards, without an end; buckets are not doubled."""
    at = lambda d, h: datetime(2024, 1, d, h)
    load = spark.createDataFrame([(s, at(d, h), 9) for s in ("a", "b", None) for d in (1, 2, 3) for h in range(24)], "site string, ds timestamp_ntz, is_downtime int")
    spans = [("a", at(1, 22), at(3, 1)), ("a", at(2, 3), at(2, 5)), ("a", at(2, 3), at(2, 5)), (None, at(1, 0), at(1, 0)), ("b", at(3, 5), at(3, 4)), ("b", at(3, 5), None), ("b", None, at(3, 4))]
    outages = spark.createDataFrame(spans, "site string, start timestamp_ntz, end timestamp_ntz")
    got = OU.flag_outages(load, outages, ["site"])
    assert got.columns == ["site", "ds", "is_downtime"] and got.count() == load.count()
    down = {(r.site, r.ds) for r in got.filter("is_downtime = 1").collect()}
    assert down == {("a", at(1, h)) for h in (22, 23)} | {("a", at(2, h)) for h in range(24)} | {("a", at(3, h)) for h in (0, 1)} | {(None, at(1, 0))}
    everyone = OU.exclude_outages(load, outages.drop("site"), ["site"])
    assert everyone.count() == 3 * 72 - 3 * (28 + 1)
    assert OU.exclude_outages(load, outages.limit(0), ["site"]).count() == load.count()
