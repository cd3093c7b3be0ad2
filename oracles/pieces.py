"""Building blocks (common table expressions) of the reference SQL."""

from __future__ import annotations

OUTAGE = "ds BETWEEN TIMESTAMP '2024-01-12 13:25:00' AND TIMESTAMP '2024-01-13 05:25:00'"
SPLIT = "TIMESTAMP '2024-01-22 00:00:00'"
CAPACITY = "5000.0"

FEATURES = [
    "hour_sin", "hour_cos", "day_sin", "day_cos", "is_weekend", "lag_1step", "lag_1h", "lag_24h", "lag_7d",
    "roll_mean_4h", "roll_std_4h", "roll_max_4h",
]


def r(*columns: str, digits: int = 4) -> str:
    """Rounded columns under their own names; + 0.0 turns a negative zero into zero."""
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)


def select(*ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + f"\n{body}"


EVENTS = r"""
ev AS (
  SELECT *, CASE WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 500 ELSE 404 END
                 WHEN event_type = 'signup' THEN 302 ELSE 200 END AS status,
         'GET /' || event_type || '/' || k || '.' || CASE k % 5 WHEN 0 THEN 'gif' WHEN 1 THEN 'html' WHEN 2 THEN 'jpg'
              WHEN 3 THEN 'txt' ELSE 'GIF' END || ' HTTP/1.0' AS request,
         CAST(round(value * 100) AS BIGINT) AS size
  FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events)
)"""

LOG = (
    EVENTS
    + """,
log AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS site, 'u' || user_id AS host, ts AS "timestamp", request, status,
         CASE WHEN status = 404 THEN 0 ELSE size END AS bytes
  FROM ev
)"""
)

_LINE = """'u' || user_id || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "' || request || '" ' || status || ' ' || """

LINES = EVENTS + f""",
lines AS (SELECT event_id, {_LINE} CASE WHEN status = 404 THEN '-' ELSE CAST(size AS VARCHAR) END AS value FROM ev)"""

MIXED = EVENTS + f""",
mixed AS (
  SELECT {_LINE} CAST(size AS VARCHAR) || CASE WHEN event_type = 'signup' AND k % 10 = 0 THEN 'B' ELSE '' END AS value FROM ev
  UNION ALL SELECT url FROM pages
  UNION ALL SELECT text FROM conversations
)"""

PATTERN = r"""'(\S+) \S+ \S+ \[([^\]]+)\] "([^"]*)" (\d{3}) (\S+)'"""


def parsed(source: str) -> str:
    fields = ", ".join(f"regexp_extract(value, {PATTERN}, {i}) AS f{i}" for i in range(1, 6))
    return f"fields AS (SELECT *, regexp_matches(value, {PATTERN}) AS hit, {fields} FROM {source})"


PARSED_LOG = parsed("lines") + """,
log AS (
  SELECT event_id, f1 AS host, CAST(CAST(substr(f1, 2) AS BIGINT) % 4 AS INTEGER) AS site,
         strptime(substr(f2, 1, 20), '%d/%b/%Y:%H:%M:%S') AS "timestamp", f2 AS timestamp_text, f3 AS request,
         CAST(f4 AS INTEGER) AS status, CASE WHEN f5 = '-' THEN 0 ELSE TRY_CAST(f5 AS BIGINT) END AS bytes
  FROM fields WHERE hit AND (f5 = '-' OR TRY_CAST(f5 AS BIGINT) IS NOT NULL)
)"""


def load(minutes: int, keyed: bool = True, where: str = "TRUE", p: str = "") -> str:
    """CTEs {p}load (every bucket) and {p}clean (outage and bot buckets removed)."""
    site, group, using = ("site, ", "GROUP BY site", "site, ds") if keyed else ("", "", "ds")
    return f"""
{p}cnt AS (
  SELECT {site}time_bucket(INTERVAL '{minutes} minutes', "timestamp") AS ds, count(*) AS y,
         CAST(sum(bytes) AS BIGINT) AS total_bytes,
         count(*) FILTER (status >= 400 AND status < 500) AS error_4xx, count(*) FILTER (status >= 500) AS error_5xx
  FROM log WHERE {where} GROUP BY ALL
),
{p}load AS (
  SELECT {site}ds, coalesce(y, 0) AS y, coalesce(total_bytes, 0) AS total_bytes,
         coalesce(total_bytes / CAST(y AS DOUBLE), 0) AS avg_bytes, coalesce(error_4xx, 0) AS error_4xx,
         coalesce(error_5xx, 0) AS error_5xx,
         coalesce((error_4xx + error_5xx) / (y + 1e-8), 0) AS error_rate, coalesce(total_bytes * CAST(1.2 AS DOUBLE), 0) AS intensity,
         CAST({OUTAGE} AS INTEGER) AS is_downtime
  FROM (SELECT {site}unnest(generate_series(min(ds), max(ds), INTERVAL '{minutes} minutes')) AS ds FROM {p}cnt {group})
  LEFT JOIN {p}cnt USING ({using})
),
{p}clean AS (SELECT * FROM {p}load WHERE NOT ({OUTAGE}) AND error_rate < 0.8)"""


LOAD_COLUMNS = ["y", "total_bytes", "avg_bytes", "error_4xx", "error_5xx", "error_rate", "intensity", "is_downtime"]
LOAD_OUT = f"y, total_bytes, {r('avg_bytes')}, error_4xx, error_5xx, {r('error_rate', 'intensity')}, is_downtime"


def features(minutes: int, keyed: bool = True, source: str = "clean", p: str = "", keep: str = "TRUE") -> str:
    """CTEs {p}raw (features on the restored grid) and {p}feat (cleaned) from ``source`` (ds, intensity)."""
    s = 60 // minutes
    site, group, using, part = ("site, ", "GROUP BY site", "site, ds", "PARTITION BY site") if keyed else ("", "", "ds", "")
    lags = ", ".join(
        f"lag(intensity, {k}) OVER w AS {n}"
        for n, k in (("lag_1step", 1), ("lag_1h", s), ("lag_24h", 24 * s), ("lag_7d", 168 * s))
    )
    full = f"count(intensity) OVER b = {4 * s}"
    cleaned = ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURES)
    return f"""
{p}grid AS (
  SELECT {site}ds, intensity
  FROM (SELECT {site}unnest(generate_series(min(ds), max(ds), INTERVAL '{minutes} minutes')) AS ds FROM {source} {group})
  LEFT JOIN (SELECT {site}ds, intensity FROM {source}) USING ({using})
),
{p}raw AS (
  SELECT {site}ds, intensity,
         sin(2 * pi() * hour(ds) / 24) AS hour_sin, cos(2 * pi() * hour(ds) / 24) AS hour_cos,
         sin(2 * pi() * (isodow(ds) - 1) / 7) AS day_sin, cos(2 * pi() * (isodow(ds) - 1) / 7) AS day_cos,
         CAST(isodow(ds) >= 6 AS INTEGER) AS is_weekend, {lags},
         CASE WHEN {full} THEN avg(intensity) OVER b END AS roll_mean_4h,
         CASE WHEN {full} THEN stddev_samp(intensity) OVER b END AS roll_std_4h,
         CASE WHEN {full} THEN max(intensity) OVER b END AS roll_max_4h
  FROM {p}grid
  WINDOW w AS ({part} ORDER BY ds), b AS ({part} ORDER BY ds ROWS BETWEEN {4 * s} PRECEDING AND 1 PRECEDING)
),
{p}feat AS (
  SELECT {site}ds, intensity, {cleaned} FROM {p}raw
  WHERE intensity IS NOT NULL AND lag_24h IS NOT NULL AND roll_mean_4h IS NOT NULL AND {keep}
)"""


def train_test(minutes: int) -> str:
    """CTEs feat-tables of the two parts, keyed: tr_feat and te_feat (with the training tail as context)."""
    return (
        load(minutes, where=f'"timestamp" < {SPLIT}', p="tr_")
        + ","
        + features(minutes, source="tr_clean", p="tr_")
        + ","
        + load(minutes, where=f'"timestamp" >= {SPLIT}', p="te_")
        + f""",
context AS (
  SELECT site, ds, intensity FROM tr_feat
  QUALIFY ds > max(ds) OVER (PARTITION BY site) - INTERVAL 8 DAY
),
both_parts AS (
  SELECT site, ds, intensity FROM (
    SELECT *, 0 AS part FROM context UNION ALL SELECT site, ds, intensity, 1 FROM te_clean
  ) QUALIFY row_number() OVER (PARTITION BY site, ds ORDER BY part) = 1
),"""
        + features(minutes, source="both_parts", p="te_all_")
        + """,
te_feat AS (
  SELECT f.* FROM te_all_feat f
  JOIN (SELECT site, min(ds) AS start FROM te_clean GROUP BY site) s ON f.site = s.site AND f.ds >= s.start
)"""
    )


def baselines(source: str = "feat", site: str = "site, ") -> str:
    """CTE pred: the three baselines in long form."""
    parts = [
        f"SELECT {site}ds, intensity AS y, '{m}' AS model, {c} AS yhat FROM {source}"
        for m, c in (("naive", "lag_1step"), ("seasonal_day", "lag_24h"), ("seasonal_week", "lag_7d"))
    ]
    return "pred AS (" + " UNION ALL ".join(parts) + ")"


# Forecast table the capacity queries run on.
DAY_FORECAST = "fc AS MATERIALIZED (SELECT site, ds, intensity AS y, lag_24h AS yhat FROM feat)"

SEEN = """
seen AS MATERIALIZED (
  SELECT *, coalesce(rn >= 24 AND dev > 0 AND e > 0 AND abs(e - mean) / nullif(dev, 0) > 3, FALSE) AS is_anomaly,
         coalesce(lag(y) OVER (PARTITION BY site ORDER BY ds), y) AS previous
  FROM (
    SELECT *, row_number() OVER (PARTITION BY site ORDER BY ds) AS rn, avg(e) OVER w AS mean, stddev_pop(e) OVER w AS dev
    FROM (SELECT *, y - yhat AS e FROM fc)
    WINDOW w AS (PARTITION BY site ORDER BY ds ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
  )
)"""


def target(expression: str, low: str = "1", high: str = "200") -> str:
    return f"CAST(least(greatest(ceil({expression}), {low}), {high}) AS INTEGER)"


REACTIVE = target(f"previous / {CAPACITY} * CAST(1.2 AS DOUBLE)")
PREDICTIVE = target(f"yhat / {CAPACITY} * CAST(1.25 AS DOUBLE)")

TARGETS = f"""
steps AS MATERIALIZED (
  SELECT site, ds, y, yhat, rn, is_anomaly, 'Reactive' AS strategy, {REACTIVE} AS target, FALSE AS alarm FROM seen
  UNION ALL
  SELECT site, ds, y, yhat, rn, is_anomaly, 'Predictive', {PREDICTIVE}, is_anomaly FROM seen
)"""


def fold(steps: str = "steps", low: str = "1", high: str = "200", cool: str = "2") -> str:
    """CTE plan: the controller, one recursion step per bucket."""
    goal = f"CASE WHEN s.alarm THEN least({high}, CAST(floor(p.replicas * 1.5) AS INTEGER)) ELSE s.target END"
    return f"""
plan AS (
  SELECT site, strategy, CAST(0 AS BIGINT) AS rn, CAST({low} AS INTEGER) AS replicas, CAST(0 AS INTEGER) AS cd, CAST({low} AS INTEGER) AS before, CAST(0 AS INTEGER) AS cd_before,
         CAST({low} AS INTEGER) AS goal
  FROM {steps} WHERE rn = 1
  UNION ALL
  SELECT site, strategy, rn,
         CASE WHEN goal > cur THEN goal WHEN goal < cur AND cd <= 0 THEN goal ELSE cur END,
         CASE WHEN goal > cur THEN {cool} WHEN goal < cur THEN CASE WHEN cd <= 0 THEN cd ELSE cd - 1 END ELSE greatest(0, cd - 1) END,
         cur, cd, goal
  FROM (
    SELECT s.site, s.strategy, s.rn, p.replicas AS cur, p.cd, {goal} AS goal
    FROM plan p JOIN {steps} s ON s.site = p.site AND s.strategy = p.strategy AND s.rn = p.rn + 1
  )
)"""


COSTED = f"""
costed AS (
  SELECT s.site, s.ds, s.y, s.yhat, s.rn, s.is_anomaly, s.strategy, p.replicas, s.target,
         greatest(0.0, s.y - p.replicas * {CAPACITY}) AS dropped, p.replicas * CAST(0.05 AS DOUBLE) AS infra,
         greatest(0.0, s.y - p.replicas * {CAPACITY}) * CAST(0.0001 AS DOUBLE) AS penalty,
         p.replicas * CAST(0.05 AS DOUBLE) + greatest(0.0, s.y - p.replicas * {CAPACITY}) * CAST(0.0001 AS DOUBLE) AS cost
  FROM steps s JOIN plan p USING (site, strategy, rn)
)"""

ACTIONS = """
acted AS (
  SELECT p.*, CASE WHEN replicas > before THEN 'scale_out' WHEN replicas < before THEN 'scale_in' ELSE 'hold' END AS action,
         CASE WHEN replicas > before THEN 'forecast above capacity threshold'
              WHEN replicas < before THEN 'forecast below threshold and cooldown passed'
              WHEN goal < before THEN 'cooldown active (' || cd_before || ')' ELSE 'stable' END AS reason
  FROM plan p WHERE rn > 0
)"""

FEATURES_15 = [LOG, load(15), features(15)]
BACKTEST = [*FEATURES_15, DAY_FORECAST, SEEN, TARGETS, fold(), COSTED]
