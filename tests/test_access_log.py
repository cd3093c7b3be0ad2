"""Hand-written log lines."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadgauge.functions import logline as G
from loadgauge.functions.logline import normalize_time, request_extension
from loadgauge.sources import access_log as AL, adapters as A

GOOD = 'host.a - - [01/Jul/1995:00:00:01 -0400] "GET /a.gif HTTP/1.0" 200 6245'
LINES = {
    GOOD: ("host.a", datetime(1995, 7, 1, 0, 0, 1), "GET /a.gif HTTP/1.0", 200, 6245),
    'h - - [31/Dec/1995:23:59:59 +0100] "GET / HTTP/1.0" 304 -': (
        "h", datetime(1995, 12, 31, 23, 59, 59), "GET / HTTP/1.0", 304, 0),
    'h - - [01/JUL/1995:00:00:01 -0400] "" 400 12': ("h", datetime(1995, 7, 1, 0, 0, 1), "", 400, 12),
    f"prefix {GOOD} suffix": ("host.a", datetime(1995, 7, 1, 0, 0, 1), "GET /a.gif HTTP/1.0", 200, 6245),
    'h - - [31/Feb/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 1': ("h", None, "GET /x HTTP/1.0", 200, 1),
    'h - - [01/Foo/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 1': ("h", None, "GET /x HTTP/1.0", 200, 1),
    'h - - [yesterday] "GET /x HTTP/1.0" 200 1': ("h", None, "GET /x HTTP/1.0", 200, 1),
    'h[1" - - [01/Jul/1995:00:00:01 -0400] "GET /a b" 200 5': ("h[1\"", datetime(1995, 7, 1, 0, 0, 1), "GET /a b", 200, 5),
}
REJECTED = {
    'h - - [01/Jul/1995:00:00:01 -0400] "GET "x" HTTP/1.0" 200 1': AL.NO_MATCH,
    'h - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 20 1': AL.NO_MATCH,
    "junk": AL.NO_MATCH,
    "": AL.NO_MATCH,
    'h - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 1k': AL.BAD_BYTES,
}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_lines(spark):
    rows = AL.access_log(frame(spark, LINES), keep=("value",)).collect()
    assert {r["value"]: tuple(r)[1:] for r in rows} == LINES


def test_rejects(spark):
    both = frame(spark, [*LINES, *REJECTED])
    assert {r["value"]: r["reason"] for r in AL.rejects(both).collect()} == REJECTED
    counts = AL.line_counts(both).first()
    assert counts.asDict() == {"lines": 13, "parsed": 8, "no_match": 4, "bad_bytes": 1, "bad_time": 3}


def test_undecodable_bytes_are_dropped(spark, tmp_path):
    line = GOOD.encode()
    (tmp_path / "log.txt").write_bytes(line.replace(b"/a.gif", b"/a\xff\xfe.gif") + b"\n" + line.replace(b"a.gif", "ä.gif".encode()))
    requests = [r.request for r in AL.access_log(AL.read_lines(spark, str(tmp_path))).collect()]
    assert sorted(requests) == ["GET /a.gif HTTP/1.0", "GET /ä.gif HTTP/1.0"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone):
    # 02:30 on that day does not exist in New York.
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = frame(spark, ["02/Apr/1995:02:30:00 -0500"]).select(normalize_time(F.col("value")).cast("string").alias("t"))
        assert row.first().t == "1995-04-02 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "request_line, kind",
    [
        ("GET /a.GIF HTTP/1.0", "gif"), ("GET /a.b/c HTTP/1.0", "b/c"), ("GET /a.gif?x=1 HTTP/1.0", "gif?x=1"),
        ("GET / HTTP/1.0", "unknown"), ("GET", "unknown"), ("", "unknown"), ("  GET   /x.txt", "txt"), ("GET /x. HTTP", ""),
        (None, "error"),
    ],
)
def test_request_extension(spark, request_line, kind):
    df = spark.createDataFrame([(request_line,)], "request string")
    assert df.select(request_extension(F.col("request"))).first()[0] == kind


def test_the_expression_runs_once_per_line(spark, tmp_path):
    (tmp_path / "log.txt").write_text(GOOD)
    log = AL.access_log(AL.read_lines(spark, str(tmp_path))).filter("timestamp IS NOT NULL AND bytes > 0")
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_sample_lines_parse_completely(spark, small):
    lines = A.events_lines(spark, small)
    counts = AL.line_counts(lines).first()
    assert counts.lines == counts.parsed == 1000 and counts.bad_time == 0


@pytest.mark.parametrize("junk", ["x" * 80_000, "a b c [" * 11_000, "a b c [d] " * 8_000, 'a b c [d] "' * 7_000])
def test_long_junk_takes_time_in_proportion(spark, junk):
    good = 'h - - [01/Jul/1995:00:00:01 -0400] "GET /a.gif HTTP/1.0" 200 6245'
    lines = spark.createDataFrame([(junk,), (junk + " " + good,)], "value string")
    lines.select(G.unfold(F.lit(good))).collect()
    start = time.perf_counter()
    got = [r[0] for r in lines.select(G.unfold(F.col("value"))).collect()]
    assert time.perf_counter() - start < 10
    assert got[0] == junk
    assert got[1].endswith("200\n6245") and got[1].count("\n") == 4
