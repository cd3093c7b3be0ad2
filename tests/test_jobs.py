"""All jobs in a row, from text logs to the savings report."""

import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadgauge.config import Settings
from loadgauge.operators import buckets as B
from loadgauge.plans import jobs
from loadgauge.session import new_path
from loadgauge.sources import adapters as A, tables as TB

T0 = datetime(2024, 1, 1)

SETTINGS = Settings.from_dict(
    json.loads(
        """{"intervals": ["5min", "15min"], "load": {"outages": [["2024-01-12 13:25:00", "2024-01-13 05:25:00"]]},
            "policy": {"server_capacity": 5000.0}, "trees": {"rounds": 3, "max_depth": 3, "learning_rate": 0.3},
            "sequence": {"n_lags": 5}}"""
    )
)


@pytest.fixture(scope="module")
def root(spark, small):
    root = new_path(spark, "jobs")
    lines = A.events_lines(spark, small).select("event_id", "value")
    # events are in time order, so a share of the ids is a share of time.
    lines.filter("event_id < 700").select("value").write.text(f"{root}/in/train")
    lines.filter("event_id >= 700").select("value").unionByName(
        A.table(spark, small, "pages").select(F.col("url").alias("value"))
    ).write.text(f"{root}/in/test")
    for part in (jobs.TRAIN, jobs.TEST):
        counts = jobs.parse(spark, f"{root}/in/{part}", root, part)
        assert counts == {"parsed": 700 if part == jobs.TRAIN else 300, "without_time": 0}
        assert jobs.aggregate(spark, root, part, SETTINGS)["buckets"] > 0
    jobs.report(spark, root)
    jobs.build_features(spark, root, SETTINGS)
    jobs.train(spark, root, SETTINGS)
    return root


def test_stored_load_equals_the_operators(spark, root):
    log = jobs.access_log(spark, root, jobs.TRAIN)
    want = B.clean_load(B.load_by_interval(log, "15min", [], SETTINGS.load), SETTINGS.load)
    got = jobs.load_table(spark, root, jobs.TRAIN, "15min")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_jobs_store_counts_and_rejects(spark, root, small):
    n = {(r.part, r.job, r.measure): r.n for r in jobs.stored_counts(spark, root).collect()}
    pages = A.table(spark, small, "pages").count()
    assert (n["train", "parse", "lines"], n["train", "parse", "no_match"]) == (700, 0)
    assert (n["test", "parse", "lines"], n["test", "parse", "parsed"], n["test", "parse", "no_match"]) == (300 + pages, 300, pages)
    assert n["train", "aggregate", "kept_buckets"] == sum(jobs.load_table(spark, root, jobs.TRAIN, i).count() for i in SETTINGS.intervals)
    assert n["train", "aggregate", "outage_buckets"] > 0
    rejects = spark.read.parquet(f"{root}/rejects")
    assert {(r.part, r.reason, r["count"]) for r in rejects.groupBy("part", "reason").count().collect()} == {("test", "no match", pages)}


def test_partitions_are_pruned(spark, root):
    plan = jobs.load_table(spark, root, jobs.TRAIN, "15min")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: []" in plan


def test_leaderboard_and_replay(spark, root):
    board = jobs.evaluate(spark, root, SETTINGS)
    assert board.count() == 12 and board.filter("rmse IS NULL OR mape IS NULL").count() == 0
    savings = jobs.simulate(spark, root, "15min", "prophet", SETTINGS).first()
    assert savings.savings == pytest.approx(savings.reactive_cost - savings.predictive_cost)
    totals = spark.read.parquet(f"{root}/finance/15min")
    assert {r.strategy for r in totals.collect()} == {"Reactive", "Predictive"}
    plan, used = jobs.recommend(spark, root, "15min", "lstm", 40, SETTINGS, buffer_ratio=0.5, max_replicas=None)
    assert plan.count() == 40 and used["buffer_ratio"] == 0.5 and used["max_replicas"] == 200
    jobs.register_views(spark, root, SETTINGS)
    n = spark.sql("SELECT count(DISTINCT model) AS n FROM predictions WHERE interval = '5min'").first().n
    assert n == 6


def test_reports(spark, root):
    hosts = spark.read.parquet(f"{root}/reports/top_hosts")
    assert hosts.columns == ["host", "request_count", "percentage"] and hosts.count() <= 20
    assert spark.read.parquet(f"{root}/reports/content").agg(F.sum("count")).first()[0] == 700


def test_settings_are_checked():
    assert SETTINGS.policy.server_capacity == 5000.0 and SETTINGS.policy.max_replicas == 200
    with pytest.raises(ValueError):
        Settings.from_dict({"nonsense": {}})
    with pytest.raises(TypeError):
        Settings.from_dict({"policy": {"nonsense": 1}})


def test_requests_for_what_is_not_stored_are_errors(spark, tmp_path):
    rows = [(m, T0 + timedelta(minutes=15 * i), 4000.0, 5000.0) for m in ("naive", "boosted_tree") for i in range(4)]
    made = spark.createDataFrame(rows, "model string, ds timestamp_ntz, y double, yhat double")
    whole = made.filter((F.col("model") == "naive") | (F.minute("ds") != 30)).select("ds", "y", "model", "yhat")
    root = str(tmp_path)
    TB.write_table(whole.select(*TB.PREDICTIONS.names), f"{root}/predictions/predictions_15min")
    for ask in (lambda m, i: jobs.recommend(spark, root, i, m), lambda m, i: jobs.simulate(spark, root, i, m)):
        for model, interval in (("prophet", "15min"), ("naive", "5min")):
            with pytest.raises(LookupError, match="no stored forecasts"):
                ask(model, interval)
    plan, _ = jobs.recommend(spark, root, "15min", "naive")
    assert plan.count() == 4
    # One bucket has no row of the other model.
    jobs.simulate(spark, root, "15min", "naive")
    assert spark.read.parquet(f"{root}/backtest/15min").select("ds").distinct().count() == 3


def test_series_of_a_log_in_folders(spark, tmp_path, small):
    """Two servers, one of them with half the requests and a day later: everything is per server, and as if each were alone."""
    root, settings = str(tmp_path), replace(SETTINGS, series=("server",), intervals=("15min",))
    lines = A.events_lines(spark, small).select("event_id", "value")
    for part, where in ((jobs.TRAIN, "event_id < 700"), (jobs.TEST, "event_id >= 700")):
        for server, share in (("web1", 1), ("7", 2)):
            lines.filter(f"{where} AND event_id % {share} = 0").select("value").write.text(f"{root}/in/{part}/server={server}")
        counts = jobs.parse(spark, f"{root}/in/{part}", root, part, settings)
        assert counts["parsed"] == (1050 if part == jobs.TRAIN else 450)
        jobs.aggregate(spark, root, part, settings)
    log = jobs.access_log(spark, root, jobs.TRAIN, settings)
    assert log.columns == ["server", *TB.ACCESS_LOG.names] and log.schema["server"].dataType.simpleString() == "string"
    stored = jobs.load_table(spark, root, jobs.TRAIN, "15min", settings)
    for server in ("web1", "7"):
        alone = B.clean_load(B.load_by_interval(log.filter(F.col("server") == server), "15min", [], SETTINGS.load), SETTINGS.load)
        assert sorted(map(tuple, stored.filter(F.col("server") == server).drop("server").collect())) == sorted(map(tuple, alone.collect()))
    jobs.build_features(spark, root, settings)
    jobs.train(spark, root, settings)
    board = jobs.evaluate(spark, root, settings)
    assert board.count() == 6 and board.filter("rmse IS NULL").count() == 0
    plan, _ = jobs.recommend(spark, root, "15min", "lstm", 10, settings)
    assert {(r.server, r["count"]) for r in plan.groupBy("server").count().collect()} == {("web1", 10), ("7", 10)}
    savings = jobs.simulate(spark, root, "15min", "naive", settings)
    assert {r.server for r in savings.collect()} == {"web1", "7"}
    jobs.register_views(spark, root, settings)
    rows = spark.sql("SELECT server, strategy, sum(y) AS y FROM backtest WHERE interval = '15min' GROUP BY ALL").collect()
    assert len(rows) == 4 and spark.sql("SELECT * FROM finance").count() == 4 and spark.sql("SELECT * FROM leaderboard").count() == 6


def test_a_log_without_the_series_folders_is_an_error(spark, tmp_path):
    spark.range(1).selectExpr("'x' AS value").write.text(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="server="):
        jobs.parse(spark, f"{tmp_path}/in", str(tmp_path), jobs.TRAIN, replace(SETTINGS, series=("server",)))
