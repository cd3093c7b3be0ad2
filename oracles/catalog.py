"""SQL per query name."""

from __future__ import annotations

from . import pieces as X
from .pieces import BACKTEST, DAY_FORECAST, FEATURES, FEATURES_15, LOG, SEEN, SPLIT, r, select

SQL: dict[str, str] = {}

LOADED = [LOG, X.load(15)]
LOADED_ALL = [LOG, X.load(15, keyed=False)]
PREDICTED = [*FEATURES_15, X.baselines()]
FEATURE_OUT = "ds, " + r("intensity", *[f for f in FEATURES if f != "is_weekend"]) + ", is_weekend"
EXTENSION = r"""CASE WHEN request IS NULL THEN 'error'
  WHEN contains(regexp_extract(request, '^\s*\S+\s+(\S+)', 1), '.')
  THEN lower(regexp_extract(regexp_extract(request, '^\s*\S+\s+(\S+)', 1), '([^.]*)$', 1)) ELSE 'unknown' END"""
REQUESTS = "reqs AS (SELECT 'GET ' || url || ' HTTP/1.0' AS request FROM pages UNION ALL SELECT request FROM log)"
METRICS = """sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg((y - yhat) * (y - yhat)) AS mse, avg(abs(y - yhat)) AS mae,
  coalesce(avg(CASE WHEN y > 0 THEN abs((y - yhat) / y) END) * 100, 0) AS mape"""
# The nudge makes exact halves, which these means often are, round up in either engine.
METRICS_OUT = ", ".join(f"round({c} + 1e-7, 4) AS {c}" for c in ("rmse", "mse", "mae", "mape"))


def cut(rows: str, source: str = "pred") -> str:
    """CTE kept: without each series' first rows, unless there are no more than those."""
    return f"""kept AS (
  SELECT site, model, interval, ds, y, greatest(coalesce(yhat, 0), 0) AS yhat, yhat AS raw_yhat FROM (
    SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY site, model, interval) AS n
    FROM (SELECT *, {rows} AS cut FROM {source}) WINDOW w AS (PARTITION BY site, model, interval ORDER BY ds)
  ) WHERE n <= cut OR rn > cut
)"""


NAMED = "named AS (SELECT *, '15min' AS interval FROM pred)"


def first_rows(n: int, model: str) -> str:
    return f"""points AS (
  SELECT site, ds, y, greatest(coalesce(yhat, 0), 0) AS yhat FROM pred WHERE model = '{model}'
  QUALIFY row_number() OVER (PARTITION BY site ORDER BY ds) <= {n}
)"""


# --- sources and sinks
SQL["access_log_parse"] = select(X.LINES, X.PARSED_LOG, body='SELECT host, "timestamp", request, status, bytes FROM log')
SQL["access_log_rejects"] = select(
    X.MIXED,
    X.parsed("mixed"),
    body="""SELECT reason, count(*) AS lines FROM (
  SELECT CASE WHEN NOT hit THEN 'no match' WHEN f5 <> '-' AND TRY_CAST(f5 AS BIGINT) IS NULL THEN 'bytes not a number' END AS reason
  FROM fields) WHERE reason IS NOT NULL GROUP BY reason""",
)
SQL["row_counts"] = select(
    X.MIXED,
    X.parsed("mixed"),
    body="""SELECT count(*) AS lines, count(*) FILTER (hit AND good) AS parsed, count(*) FILTER (NOT hit) AS no_match,
  count(*) FILTER (hit AND NOT good) AS bad_bytes,
  count(*) FILTER (hit AND good AND try_strptime(substr(f2, 1, 20), '%d/%b/%Y:%H:%M:%S') IS NULL) AS bad_time
FROM (SELECT *, f5 = '-' OR TRY_CAST(f5 AS BIGINT) IS NOT NULL AS good FROM fields)""",
)
SQL["table_scan"] = select(*LOADED_ALL, body=f"SELECT ds, {X.LOAD_OUT} FROM load")
SQL["table_sink"] = select(
    LOG,
    X.load(1, p="one_"),
    X.load(5, p="five_"),
    X.load(15),
    body=f"""SELECT CASE WHEN ds < {SPLIT} THEN 'train' ELSE 'test' END AS split, interval, site, count(*) AS buckets,
  CAST(sum(y) AS BIGINT) AS requests, CAST(sum(total_bytes) AS BIGINT) AS total_bytes
FROM (SELECT '1min' AS interval, * FROM one_clean UNION ALL SELECT '5min', * FROM five_clean UNION ALL SELECT '15min', * FROM clean) GROUP BY ALL""",
)
SQL["prediction_file_scan"] = select(
    LOG,
    X.load(1, p="one_"),
    X.features(1, source="one_clean", p="one_"),
    X.load(5, p="five_"),
    X.features(5, source="five_clean", p="five_"),
    X.load(15),
    X.features(15),
    X.baselines("one_feat").replace("pred AS", "one_pred AS", 1),
    X.baselines("five_feat").replace("pred AS", "five_pred AS", 1),
    X.baselines(),
    body=f"""SELECT site, model, ds, {r('y', 'yhat')}, interval FROM (
  SELECT *, '1min' AS interval FROM one_pred UNION ALL SELECT *, '5min' FROM five_pred UNION ALL SELECT *, '15min' FROM pred)""",
)

# --- projections and predicates
SQL["normalize_time"] = select(X.LINES, X.PARSED_LOG, body='SELECT event_id, timestamp_text, "timestamp" FROM log')
SQL["cast_measures"] = select(X.LINES, X.PARSED_LOG, body="SELECT event_id, status, bytes FROM log")
SQL["request_extension"] = select(LOG, REQUESTS, body=f"SELECT request, {EXTENSION} AS file_type FROM reqs")
SQL["error_rate"] = select(*LOADED, body=f"SELECT site, ds, {r('error_rate', digits=6)} FROM load")
SQL["intensity"] = select(*LOADED, body=f"SELECT site, ds, y, {r('avg_bytes', 'intensity')} FROM load")
SQL["downtime_flag"] = select(*LOADED_ALL, body="SELECT ds, is_downtime FROM load")
SQL["exclude_downtime"] = select(
    *LOADED,
    body="""SELECT site, count(*) AS buckets, count(*) FILTER (is_downtime = 1) AS outage_buckets,
  count(*) FILTER (is_downtime = 0 AND error_rate >= 0.8) AS bot_buckets,
  count(*) FILTER (is_downtime = 0 AND error_rate < 0.8) AS kept_buckets FROM load GROUP BY site""",
)
SQL["bot_filter"] = select(*LOADED_ALL, body=f"SELECT ds, y, {r('error_rate')} FROM load WHERE error_rate < 0.8")
LAGS = ["lag_1step", "lag_1h", "lag_24h", "lag_7d"]
SQL["fill_zero"] = select(
    *FEATURES_15,
    body="SELECT site, ds, " + ", ".join(f"round(coalesce({c}, 0), 4) AS {c}" for c in LAGS) + " FROM raw WHERE intensity IS NOT NULL",
)
SQL["drop_null"] = select(
    *FEATURES_15,
    body=f"""SELECT site, ds, {r('intensity', 'lag_7d')} FROM raw
WHERE intensity IS NOT NULL AND lag_24h IS NOT NULL AND roll_mean_4h IS NOT NULL""",
)
SQL["clip_nonnegative"] = select(
    *FEATURES_15,
    body="""SELECT site, ds, round(lag_1step - lag_24h, 4) + 0.0 AS swing,
  round(greatest(coalesce(lag_1step - lag_24h, 0), 0), 4) + 0.0 AS yhat FROM raw WHERE intensity IS NOT NULL""",
)
SQL["prune_columns"] = select(*LOADED_ALL, body=f"SELECT ds, {r('intensity')} FROM clean")
SQL["time_split"] = select(
    *FEATURES_15,
    body=f"SELECT site, ds, {r('intensity')}, CASE WHEN ds < {SPLIT} THEN 'train' ELSE 'test' END AS split FROM feat",
)
SQL["context_tail"] = select(LOG, X.train_test(15), body=f"SELECT site, ds, {r('intensity')} FROM context")
SQL["positive_actual_mask"] = select(
    *PREDICTED,
    body="""SELECT site, model, count(*) FILTER (y > 0) AS positive_rows,
  round(coalesce(avg(CASE WHEN y > 0 THEN abs((y - yhat) / y) END) * 100, 0), 4) AS mape FROM pred GROUP BY site, model""",
)
SQL["anomaly_rows"] = select(
    *FEATURES_15, DAY_FORECAST, SEEN, body=f"SELECT site, ds, {r('y', 'yhat')} FROM seen WHERE is_anomaly"
)

# --- joins
SQL["spine_join"] = select(*FEATURES_15, body=f"SELECT site, ds, {r('intensity')} FROM grid")
SQL["predictions_align"] = select(*PREDICTED, body=f"SELECT site, ds, model, {r('y', 'yhat')} FROM pred")
SQL["share_of_total"] = select(
    LOG,
    body="""SELECT host, count(*) AS request_count, round(count(*) * 100.0 / (SELECT count(*) FROM log), 4) AS percentage
FROM log GROUP BY host""",
)


def scaled(source: str, columns: list[str]) -> str:
    return ", ".join(
        f"round((f.{c} - s.{c}_mean) / s.{c}_scale, 4) + 0.0 AS {c}" for c in columns
    )


def stats(source: str, columns: list[str]) -> str:
    parts = ", ".join(
        f"avg({c}) AS {c}_mean, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS {c}_scale" for c in columns
    )
    return f"stats AS (SELECT site, {parts} FROM {source} GROUP BY site)"


SQL["apply_scaler"] = select(
    LOG,
    X.train_test(15),
    stats("tr_feat", FEATURES),
    body=f"SELECT f.site, f.ds, {scaled('te_feat', FEATURES)} FROM te_feat f JOIN stats s USING (site)",
)
SQL["scaler_fit"] = select(
    *FEATURES_15,
    stats("feat", ["intensity", *FEATURES]),
    body="SELECT site, " + r(*[f"{c}_{p}" for c in ["intensity", *FEATURES] for p in ("mean", "scale")]) + " FROM stats",
)
OVERRIDES = """policy AS (
  SELECT site, CASE WHEN site % 2 = 1 THEN floor(sum(bytes) / 1000.0) ELSE 5000.0 END AS server_capacity,
         CASE WHEN site = 2 THEN 1 ELSE 2 END AS cooldown_period FROM log GROUP BY site)"""
SQL["policy_join"] = select(
    LOG,
    OVERRIDES,
    body="""SELECT site, CAST(server_capacity AS DOUBLE) AS server_capacity, cooldown_period, 200 AS max_replicas,
  CAST(0.25 AS DOUBLE) AS buffer_ratio FROM policy""",
)

# --- aggregations
SQL["load_by_interval"] = select(
    X.LINES, X.PARSED_LOG, X.load(15, keyed=False), body=f"SELECT ds, {X.LOAD_OUT} FROM load"
)
SQL["load_by_interval_keyed"] = select(*LOADED, body=f"SELECT site, ds, {X.LOAD_OUT} FROM load")
SQL["load_long_gaps"] = select(
    LOG,
    """cnt AS (
  SELECT host, time_bucket(INTERVAL '60 minutes', "timestamp") AS ds, count(*) AS y, CAST(sum(bytes) AS BIGINT) AS total_bytes FROM log GROUP BY ALL)""",
    "days AS (SELECT DISTINCT host, date_trunc('day', ds) AS day FROM cnt)",
    """runs AS (
  SELECT *, sum(jump) OVER (PARTITION BY host ORDER BY day) AS run
  FROM (SELECT *, CAST(coalesce(date_diff('day', lag(day) OVER (PARTITION BY host ORDER BY day), day) > 2, FALSE) AS INTEGER) AS jump FROM days))""",
    "ends AS (SELECT host, min(ds) AS lo, max(ds) AS hi FROM cnt GROUP BY host)",
    """grid AS (
  SELECT host, unnest(generate_series(greatest(lo, CAST(a AS TIMESTAMP)), least(hi, CAST(b AS TIMESTAMP) + INTERVAL 23 HOUR), INTERVAL 1 HOUR)) AS ds
  FROM (SELECT host, run, min(day) AS a, max(day) AS b FROM runs GROUP BY host, run) JOIN ends USING (host))""",
    body="SELECT host, ds, coalesce(y, 0) AS y, coalesce(total_bytes, 0) AS total_bytes FROM grid LEFT JOIN cnt USING (host, ds)",
)
SQL["status_class_counts"] = select(
    LOG,
    body="""SELECT site, count(*) FILTER (status BETWEEN 400 AND 499) AS error_4xx, count(*) FILTER (status >= 500) AS error_5xx
FROM log GROUP BY site""",
)
SQL["load_all_intervals"] = select(
    LOG,
    X.load(1, False, p="one_"),
    X.load(5, False, p="five_"),
    X.load(15, False),
    body=f"""SELECT interval, ds, {X.LOAD_OUT} FROM (SELECT '1min' AS interval, * FROM one_clean
  UNION ALL SELECT '5min', * FROM five_clean UNION ALL SELECT '15min', * FROM clean)""",
)
SQL["top_hosts"] = SQL["share_of_total"] + " ORDER BY request_count DESC, host LIMIT 20"
SQL["content_report"] = select(
    LOG,
    REQUESTS,
    body=f"""SELECT file_type, count(*) AS count FROM (SELECT {EXTENSION} AS file_type FROM reqs)
GROUP BY file_type ORDER BY count DESC, file_type LIMIT 15""",
)
SQL["forecast_metrics"] = select(
    *PREDICTED, NAMED, cut("96", "named"),
    body=f"SELECT interval, model, {METRICS_OUT} FROM (SELECT interval, model, {METRICS} FROM kept GROUP BY ALL)",
)
SQL["forecast_metrics_compat_warmup"] = select(
    *PREDICTED, NAMED, cut("288", "named"),
    body=f"SELECT site, interval, model, {METRICS_OUT} FROM (SELECT site, interval, model, {METRICS} FROM kept GROUP BY ALL)",
)
SQL["leaderboard"] = select(
    LOG,
    X.load(1, p="one_"),
    X.features(1, source="one_clean", p="one_"),
    X.load(5, p="five_"),
    X.features(5, source="five_clean", p="five_"),
    X.load(15),
    X.features(15),
    X.baselines("one_feat").replace("pred AS", "one_pred AS", 1),
    X.baselines("five_feat").replace("pred AS", "five_pred AS", 1),
    X.baselines(),
    "named AS (SELECT *, '1min' AS interval FROM one_pred UNION ALL SELECT *, '5min' FROM five_pred UNION ALL SELECT *, '15min' FROM pred)",
    cut("CASE interval WHEN '1min' THEN 1440 WHEN '5min' THEN 288 ELSE 96 END", "named"),
    body=f"""SELECT interval, model, {METRICS_OUT} FROM (SELECT interval, model, {METRICS} FROM kept GROUP BY ALL)
ORDER BY interval, rmse, model""",
)
SQL["strategy_totals"] = select(
    *BACKTEST, recursive=True,
    body=f"""SELECT site, strategy, {r('total_cost', 'total_dropped', 'total_demand')},
  round(CASE WHEN total_demand > 0 THEN total_dropped / total_demand * 100 ELSE 0 END, 4) AS sla_violation
FROM (SELECT site, strategy, sum(cost) AS total_cost, sum(dropped) AS total_dropped, sum(y) AS total_demand FROM costed GROUP BY ALL)""",
)
SQL["savings_report"] = select(
    *BACKTEST, recursive=True,
    body=f"""SELECT site, {r('reactive_cost', 'predictive_cost')}, round(reactive_cost - predictive_cost, 4) + 0.0 AS savings,
  round(CASE WHEN reactive_cost > 0 THEN (reactive_cost - predictive_cost) / reactive_cost * 100 ELSE 0 END, 4) + 0.0 AS savings_pct
FROM (SELECT site, sum(cost) FILTER (strategy = 'Reactive') AS reactive_cost,
             sum(cost) FILTER (strategy = 'Predictive') AS predictive_cost FROM costed GROUP BY site)""",
)
SQL["sla_report"] = select(
    *BACKTEST, recursive=True,
    body="""SELECT site, round(a, 4) AS reactive_sla, round(b, 4) AS predictive_sla, round(b - a, 4) + 0.0 AS sla_delta FROM (
  SELECT site, (1 - sum(dropped) FILTER (strategy = 'Reactive') / sum(y) FILTER (strategy = 'Reactive')) * 100 AS a,
         (1 - sum(dropped) FILTER (strategy = 'Predictive') / sum(y) FILTER (strategy = 'Predictive')) * 100 AS b
  FROM costed GROUP BY site)""",
)
SQL["forecast_mae"] = select(
    *PREDICTED, first_rows(200, "seasonal_day"), body="SELECT site, round(avg(abs(y - yhat)), 4) AS mae FROM points GROUP BY site"
)

# --- windows
SQL["lag_features"] = select(*FEATURES_15, body=f"SELECT site, ds, {r('intensity', *LAGS)} FROM raw WHERE intensity IS NOT NULL")
SQL["rolling_features"] = select(
    *FEATURES_15,
    body=f"SELECT site, ds, {r('roll_mean_4h', 'roll_std_4h', 'roll_max_4h')} FROM raw WHERE intensity IS NOT NULL",
)
SQL["calendar_features"] = select(
    *LOADED_ALL,
    X.features(15, False, "load", "all_"),
    body=f"SELECT ds, {r('hour_sin', 'hour_cos', 'day_sin', 'day_cos')}, is_weekend FROM all_raw",
)
SQL["feature_table"] = select(*LOADED_ALL, X.features(15, False), body=f"SELECT {FEATURE_OUT} FROM feat")
SQL["feature_table_keyed"] = select(*FEATURES_15, body=f"SELECT site, {FEATURE_OUT} FROM feat")
SQL["test_feature_table"] = select(LOG, X.train_test(15), body=f"SELECT site, {FEATURE_OUT} FROM te_feat")
SQL["save_load_model"] = select(LOG, X.train_test(15), body="SELECT site, ds, TRUE AS same FROM te_feat")
SQL["previous_demand"] = select(*FEATURES_15, DAY_FORECAST, SEEN, body=f"SELECT site, ds, {r('y', 'previous')} FROM seen")
SQL["residual_anomaly"] = select(
    *FEATURES_15, DAY_FORECAST, SEEN, body=f"SELECT site, ds, {r('y', 'yhat')}, is_anomaly FROM seen"
)
SQL["cumulative_cost"] = select(
    *BACKTEST, recursive=True,
    body=f"""SELECT site, strategy, ds, {r('cost')},
  round(sum(cost) OVER (PARTITION BY site, strategy ORDER BY ds ROWS UNBOUNDED PRECEDING), 4) AS cumulative_cost FROM costed""",
)
SQL["sequence_windows"] = select(
    *FEATURES_15,
    body=f"""SELECT site, ds, {r('target', digits=2)}, rows, {r('oldest_lag', 'lag_sum', digits=2)} FROM (
  SELECT site, ds, intensity AS target, CAST(count(*) OVER w AS INTEGER) AS rows,
         first_value(lag_1step) OVER w AS oldest_lag, sum(lag_1step) OVER w AS lag_sum
  FROM feat WINDOW w AS (PARTITION BY site ORDER BY ds ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
) WHERE rows = 30""",
)
CELLS = " + ".join(f"{j} * {f}" for j, f in enumerate(FEATURES, 1))
SQL["sequence_windows"] = select(
    *FEATURES_15,
    f"placed AS (SELECT *, {CELLS} AS cells, row_number() OVER (PARTITION BY site ORDER BY ds) AS rn FROM feat)",
    body=f"""SELECT site, ds, {r('target', digits=2)}, rows, {r('oldest_lag', 'lag_sum', digits=2)}, round(placed_sum - (rn - 31) * cell_sum, 1) + 0.0 AS weighted_sum FROM (
  SELECT site, ds, rn, intensity AS target, CAST(count(*) OVER w AS INTEGER) AS rows,
         first_value(lag_1step) OVER w AS oldest_lag, sum(lag_1step) OVER w AS lag_sum,
         sum(cells) OVER w AS cell_sum, sum(rn * cells) OVER w AS placed_sum
  FROM placed WINDOW w AS (PARTITION BY site ORDER BY ds ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
) WHERE rows = 30""",
)
SQL["warmup_cut"] = select(
    *PREDICTED, NAMED, cut("96", "named"), body="SELECT site, model, ds, round(y, 4) AS y, round(raw_yhat, 4) AS yhat FROM kept"
)
SQL["tail_align"] = select(
    *FEATURES_15,
    body=f"""SELECT site, ds, {r('y', 'yhat')} FROM (SELECT site, ds, intensity AS y, lag_1step AS yhat,
  row_number() OVER (PARTITION BY site ORDER BY ds) AS rn FROM feat) WHERE rn > 30""",
)
SQL["backfill_head"] = select(
    *FEATURES_15,
    """known AS (SELECT site, ds, intensity AS y, lag_7d AS yhat FROM raw WHERE intensity IS NOT NULL AND lag_24h IS NOT NULL)""",
    """firsts AS (SELECT site, arg_min(yhat, ds) AS made FROM known WHERE yhat IS NOT NULL GROUP BY site)""",
    body="""SELECT site, ds, round(y, 4) AS y, round(coalesce(yhat, made, 0), 4) AS yhat FROM known LEFT JOIN firsts USING (site)""",
)

# --- sort, limit, sets, shape
SQL["sort_by_time"] = select(LOG, body='SELECT site, host, "timestamp", request, status, bytes FROM log ORDER BY "timestamp", host, request, bytes')
SQL["top_k"] = select(
    LOG, body="SELECT request, count(*) AS requests FROM log GROUP BY request ORDER BY requests DESC, request LIMIT 20"
)
SQL["horizon_limit"] = select(
    *FEATURES_15, DAY_FORECAST,
    body=f"SELECT site, ds, {r('y', 'yhat')} FROM fc QUALIFY row_number() OVER (PARTITION BY site ORDER BY ds) <= 100",
)
SQL["zoom_slice"] = select(
    *BACKTEST, recursive=True, body=f"SELECT site, strategy, ds, {r('y')}, replicas FROM costed WHERE rn <= 288"
)
SQL["context_union"] = select(LOG, X.train_test(15), body=f"SELECT site, ds, {r('intensity')} FROM both_parts")
SQL["dedup_latest"] = """SELECT CAST(user_id % 4 AS INTEGER) AS site, date_trunc('minute', ts) AS ds, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id % 4, date_trunc('minute', ts) ORDER BY event_id DESC) = 1"""
SQL["unpivot_strategies"] = select(
    *BACKTEST, recursive=True,
    body="""SELECT site, ds, CASE strategy WHEN 'Predictive' THEN 'Forecast-based' ELSE 'Load-based' END AS strategy, replicas
FROM costed""",
)
SQL["pivot_predictions"] = select(
    *FEATURES_15,
    body="""SELECT site, ds, round(intensity, 4) AS y, round(lag_1step, 4) AS naive, round(lag_24h, 4) AS seasonal_day,
  round(lag_7d, 4) AS seasonal_week FROM feat""",
)

# --- forecasts
SQL["naive_forecast"] = select(*PREDICTED, body=f"SELECT site, ds, {r('y', 'yhat')} FROM pred WHERE model = 'naive'")
SQL["seasonal_naive_forecast"] = select(
    *PREDICTED, body=f"SELECT site, ds, {r('y', 'yhat')}, model FROM pred WHERE model LIKE 'seasonal%'"
)
SQL["trend_fit"] = select(
    *LOADED,
    body="""SELECT site, round(regr_slope(intensity, x), 3) AS slope, round(regr_intercept(intensity, x), 3) AS intercept
FROM (SELECT *, epoch(ds - TIMESTAMP '2024-01-01') / 86400.0 AS x FROM clean) GROUP BY site""",
)
SQL["scale_transform"] = select(
    *FEATURES_15,
    stats("feat", ["intensity"]),
    body="""SELECT site, ds, round((intensity - intensity_mean) / intensity_scale, 4) + 0.0 AS score, round(intensity, 4) AS intensity
FROM feat JOIN stats USING (site)""",
)
SQL["rolling_validation"] = select(
    *PREDICTED,
    "folds(fold, cutoff) AS (VALUES (1, TIMESTAMP '2024-01-15'), (2, TIMESTAMP '2024-01-18'), (3, TIMESTAMP '2024-01-21'))",
    body=f"""SELECT fold, model, {METRICS_OUT} FROM (SELECT fold, model, {METRICS} FROM pred
  JOIN folds ON ds >= cutoff AND ds < cutoff + INTERVAL 5 DAY GROUP BY ALL)""",
)

# --- capacity
SQL["ceil_clip"] = select(*LOADED, body=f"SELECT site, ds, {X.target('intensity / 5000.0', '2', '6')} AS replicas FROM clean")
SQL["normalized_demand"] = select(*BACKTEST, recursive=True, body="SELECT site, strategy, ds, round(y / 5000.0, 4) AS demand FROM costed")
SQL["reactive_target"] = select(*FEATURES_15, DAY_FORECAST, SEEN, body=f"SELECT site, ds, {X.REACTIVE} AS target FROM seen")
SQL["predictive_target"] = select(*FEATURES_15, DAY_FORECAST, body=f"SELECT site, ds, {X.PREDICTIVE} AS target FROM fc")
SQL["emergency_target"] = select(
    *BACKTEST, recursive=True, body="SELECT site, ds, replicas FROM costed WHERE is_anomaly AND strategy = 'Predictive'"
)
SQL["replica_plan"] = select(*BACKTEST, recursive=True, body="SELECT site, strategy, ds, target, replicas FROM costed")
SQL["plan_actions"] = select(
    *FEATURES_15, DAY_FORECAST, SEEN, X.TARGETS, X.fold(), X.ACTIONS, recursive=True,
    body="SELECT site, strategy, ds, replicas, action, reason FROM acted JOIN steps USING (site, strategy, rn)",
)
COSTS = ["dropped", "infra", "penalty", "cost"]
SQL["step_cost"] = select(*BACKTEST, recursive=True, body=f"SELECT site, strategy, ds, {r(*COSTS)} FROM costed")
SIMPLE = f"""simple AS (
  SELECT site, ds, y, CAST(greatest(ceil(previous / {X.CAPACITY} * CAST(1.2 AS DOUBLE)), 1) AS INTEGER) AS replicas FROM (
    SELECT *, coalesce(lag(y) OVER (PARTITION BY site ORDER BY ds), yhat) AS previous FROM fc))"""
SQL["reactive_plan_simple"] = select(*FEATURES_15, DAY_FORECAST, SIMPLE, body="SELECT site, ds, replicas FROM simple")
FORECAST_STEPS = f"""forecast_steps AS MATERIALIZED (
  SELECT site, ds, y, yhat, row_number() OVER (PARTITION BY site ORDER BY ds) AS rn, 'Predictive' AS strategy,
         {X.PREDICTIVE} AS target, FALSE AS alarm FROM fc)"""
SQL["prorated_cost"] = select(
    *FEATURES_15, DAY_FORECAST, SIMPLE, FORECAST_STEPS, X.fold("forecast_steps"), recursive=True,
    body=f"""SELECT site, strategy, ds, replicas, {r(*COSTS)} FROM (
  SELECT *, infra + penalty AS cost FROM (
    SELECT *, dropped * CAST(0.0001 AS DOUBLE) AS penalty FROM (
      SELECT *, greatest(0.0, y - replicas * {X.CAPACITY}) AS dropped, replicas * CAST(0.05 AS DOUBLE) * 0.25 AS infra FROM (
        SELECT site, 'Reactive' AS strategy, ds, y, replicas FROM simple
        UNION ALL SELECT site, 'Predictive', ds, y, p.replicas FROM forecast_steps JOIN plan p USING (site, strategy, rn)))))""",
)
SQL["strategy_backtest"] = select(
    *BACKTEST, recursive=True,
    body=f"SELECT site, ds, {r('y')}, is_anomaly, strategy, replicas, {r('cost', 'dropped')} FROM costed",
)


def per_policy(piece: str, capacity: str = "server_capacity") -> str:
    return piece.replace(X.CAPACITY, capacity)


POLICY_TARGETS = per_policy(X.TARGETS).replace(
    "SELECT site, ds, y, yhat, rn, is_anomaly,", "SELECT site, ds, y, yhat, rn, is_anomaly, server_capacity, cooldown_period,"
).replace("FROM seen", "FROM seen JOIN policy USING (site)")
SQL["policy_backtest"] = select(
    *FEATURES_15, OVERRIDES, DAY_FORECAST, SEEN, POLICY_TARGETS,
    X.fold(cool="cooldown_period").replace("SELECT s.site, s.strategy, s.rn,", "SELECT s.site, s.strategy, s.rn, s.cooldown_period,"),
    per_policy(X.COSTED, "s.server_capacity"),
    recursive=True,
    body=SQL["strategy_totals"][SQL["strategy_totals"].rindex("SELECT site, strategy, round(total_cost"):],
)
SQL["forecast_points"] = select(*PREDICTED, first_rows(150, "naive"), body=f"SELECT site, ds, {r('y', 'yhat')} FROM points")
SQL["scaling_recommendation"] = select(
    *PREDICTED,
    first_rows(150, "seasonal_day"),
    FORECAST_STEPS.replace("FROM fc", "FROM points").replace("CAST(1.25 AS DOUBLE)", "(CAST(1.0 AS DOUBLE) + CAST(0.1 AS DOUBLE))"),
    X.fold("forecast_steps"),
    X.ACTIONS,
    recursive=True,
    body=f"""SELECT site, ds, {r('yhat', 'y')}, replicas AS recommended_replicas, action, reason
FROM acted JOIN forecast_steps USING (site, strategy, rn)""",
)

# --- streams: what a finished run has emitted
SQL["stream_load"] = select(
    *LOADED,
    body=f"""SELECT site, ds, {X.LOAD_OUT} FROM load
WHERE y > 0 AND ds + INTERVAL 15 MINUTE <= (SELECT max("timestamp") FROM log) - INTERVAL 10 MINUTE""",
)
SQL["stream_late"] = select(
    LOG,
    """marked AS (
  SELECT site, time_bucket(INTERVAL '15 minutes', "timestamp") AS ds, "timestamp" AS moment, CAST(substr(host, 2) AS BIGINT) % 50 = 0 AS behind FROM log)""",
    "ends AS (SELECT max(moment) FILTER (WHERE NOT behind) - INTERVAL 10 MINUTE AS first_end, max(moment) - INTERVAL 10 MINUTE AS last_end FROM marked)",
    """judged AS (
  SELECT site, ds, coalesce(behind AND ds + INTERVAL 15 MINUTE <= first_end, FALSE) AS late, ds + INTERVAL 15 MINUTE <= last_end AS closed FROM marked, ends)""",
    body="""SELECT site, ds, count(*) AS received, count(*) FILTER (WHERE closed AND NOT late) AS loaded, count(*) FILTER (WHERE late) AS late,
       count(*) FILTER (WHERE NOT closed) AS still_open
FROM judged GROUP BY site, ds""",
)
SQL["stream_fill"] = select(
    *LOADED,
    """closed AS (
  SELECT site, max(ds) AS until FROM load
  WHERE y > 0 AND ds + INTERVAL 15 MINUTE <= (SELECT max("timestamp") FROM log) - INTERVAL 10 MINUTE GROUP BY site)""",
    body=f"SELECT site, ds, {X.LOAD_OUT} FROM load JOIN closed USING (site) WHERE ds <= until",
)
SQL["stream_anomaly"] = SQL["residual_anomaly"]
SQL["stream_replica_plan"] = select(
    *FEATURES_15, DAY_FORECAST, FORECAST_STEPS, X.fold("forecast_steps"), X.ACTIONS, recursive=True,
    body=f"""SELECT site, ds, {r('y', 'yhat')}, replicas AS recommended_replicas, action, reason
FROM acted JOIN forecast_steps USING (site, strategy, rn)""",
)
SQL["stream_backtest"] = select(
    *BACKTEST, X.ACTIONS, recursive=True,
    body=f"""SELECT site, ds, {r('y')}, is_anomaly, strategy, c.replicas, {r('cost', 'dropped')}, action, reason
FROM costed c JOIN acted a USING (site, strategy, rn)""",
)
ON_TIME = """
first_run AS (SELECT site, max(ds) AS until FROM fc WHERE day(ds) % 7 <> 0 GROUP BY site),
told AS MATERIALIZED (SELECT fc.*, day(ds) % 7 = 0 AND until IS NOT NULL AND ds <= until AS late FROM fc LEFT JOIN first_run USING (site)),
on_time AS MATERIALIZED (SELECT * FROM told WHERE NOT late)"""
SQL["stream_late_rows"] = select(
    *FEATURES_15, DAY_FORECAST, ON_TIME, FORECAST_STEPS.replace("FROM fc", "FROM on_time"), X.fold("forecast_steps"), X.ACTIONS, recursive=True,
    body=f"""SELECT site, ds, {r('y', 'yhat')}, FALSE AS late, replicas AS recommended_replicas, action
FROM acted JOIN forecast_steps USING (site, strategy, rn)
UNION ALL SELECT site, ds, {r('y', 'yhat')}, TRUE, NULL, NULL FROM told WHERE late""",
)
# --- models: at the solution the gradients of the penalised error are 0
TERMS = ["level", "trend", *[f"bend{i}" for i in range(1, 13)]]
TERMS += [f"{n}_{f}{i}" for n, k in (("daily", 4), ("weekly", 3)) for i in range(1, k + 1) for f in ("sin", "cos")] + list(X.FEATURES)
SQL["additive_fit"] = select(
    X.LOG, X.train_test(15), "terms(term) AS (VALUES " + ", ".join(f"('{t}')" for t in TERMS) + ")",
    body="SELECT site, term, n, CAST(0.0 AS DOUBLE) AS gradient FROM (SELECT site, count(*) AS n FROM tr_feat GROUP BY site), terms",
)
SQL["rolling_refit"] = select(
    *FEATURES_15,
    "folds(fold, cutoff) AS (VALUES (1, TIMESTAMP '2024-01-15'), (2, TIMESTAMP '2024-01-18'), (3, TIMESTAMP '2024-01-21'))",
    body="""SELECT site, fold, count(*) FILTER (WHERE ds < cutoff) AS n_train, CAST(0.0 AS DOUBLE) AS gradient,
  count(*) FILTER (WHERE ds >= cutoff AND ds < cutoff + INTERVAL 5 DAY) AS n_test
FROM feat, folds GROUP BY site, fold HAVING n_train > 0 AND n_test > 0""",
)
SQL["pipeline_counts"] = select(
    X.MIXED,
    X.parsed("mixed"),
    """checked AS (
  SELECT *, f5 = '-' OR TRY_CAST(f5 AS BIGINT) IS NOT NULL AS good, try_strptime(substr(f2, 1, 20), '%d/%b/%Y:%H:%M:%S') AS stamp FROM fields),
log AS (
  SELECT CAST(CAST(substr(f1, 2) AS BIGINT) % 4 AS INTEGER) AS site, stamp AS "timestamp", f3 AS request, CAST(f4 AS INTEGER) AS status,
         CASE WHEN f5 = '-' THEN 0 ELSE TRY_CAST(f5 AS BIGINT) END AS bytes
  FROM checked WHERE hit AND good)""",
    X.load(15, where=f'"timestamp" < {SPLIT}', p="tr_"),
    X.load(15, where=f'"timestamp" >= {SPLIT} - INTERVAL 1 DAY', p="te_"),
    "tail AS (SELECT site, ds FROM tr_clean QUALIFY ds > max(ds) OVER (PARTITION BY site) - INTERVAL 8 DAY)",
    "every AS (SELECT site, ds FROM tail UNION SELECT site, ds FROM te_clean)",
    body="\nUNION ALL ".join(
        [
            f"SELECT 'log' AS stage, '{m}' AS measure, count(*) FILTER ({c}) AS n FROM checked"
            for m, c in (("lines", "TRUE"), ("parsed", "hit AND good"), ("no_match", "NOT hit"), ("bad_bytes", "hit AND NOT good"), ("bad_time", "hit AND good AND stamp IS NULL"))
        ]
        + [
            f"SELECT '{part}', '{m}', count(*) FILTER ({c}) FROM {p}_load"
            for part, p in (("train", "tr"), ("test", "te"))
            for m, c in (
                ("buckets", "TRUE"), ("outage_buckets", X.OUTAGE), ("bot_buckets", f"NOT ({X.OUTAGE}) AND error_rate >= 0.8"), ("kept_buckets", f"NOT ({X.OUTAGE}) AND error_rate < 0.8"),
            )
        ]
        + [f"SELECT '{name}', 'rows', count(*) FROM {table}" for name, table in (("context", "tail"), ("own", "te_clean"), ("series", "every"))]
    ),
)
SQL["outage_table"] = select(
    *LOADED,
    """failed AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS site, ts AS a, ts + to_minutes(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS b FROM events
  WHERE event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 = 0)""",
    body=f"""SELECT site, ds, y, {r('intensity')}, CAST(EXISTS (SELECT 1 FROM failed f WHERE f.site = load.site AND load.ds BETWEEN a AND b) AS INTEGER) AS is_downtime
FROM load""",
)
