"""Independent DuckDB SQL for every named plan (tables pre-registered as views).

The SQL restates each operator's semantics directly over the ``events`` table:
the payload adapter becomes a plain projection (records that would be
rejected are left out), each event is unnested into its five hopping windows,
and rules become filtered aggregates. Parameters are those of
``DRIVER_RULES``.
"""

from __future__ import annotations

# The adapter as SQL: what parse_events must return for the driver's table.
EV = """
src AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events
),
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         'usr_' || CAST(user_id AS VARCHAR) AS user_id,
         'sess_' || CAST(user_id AS VARCHAR) AS session_id,
         '10.0.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(k % 4 AS VARCHAR) AS ip_address,
         (['phone', 'laptop', 'kiosk'])[k % 3 + 1] AS device_type,
         (['NO', 'PT', 'KE', 'PE'])[user_id % 4 + 1] AS location_country,
         (['Bergen', 'Porto', 'Nairobi', 'Lima'])[user_id % 4 + 1] AS location_city,
         CASE event_type WHEN 'error' THEN 'login_failed'
                         WHEN 'purchase' THEN 'transaction_success'
                         WHEN 'view' THEN 'page_view'
                         WHEN 'click' THEN 'product_click'
                         WHEN 'signup' THEN 'login_success'
                         ELSE event_type END AS action,
         '/' || event_type AS url_path,
         CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0.0 AS DOUBLE) END AS amount,
         'agent/1' AS user_agent,
         ts AS event_time
  FROM src
  WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
)"""

EV_COLUMNS = ("event_id, \"timestamp\", user_id, session_id, ip_address, device_type, location_country, "
              "location_city, action, url_path, amount, user_agent, event_time")

# Hopping windows of 5 days sliding by 1 day: each event is in the five windows
# starting 0..4 days before its epoch-aligned day.
WINDOWED = EV + """,
win AS (
  SELECT time_bucket(INTERVAL '1 day', event_time, TIMESTAMP '1970-01-01') - to_days(CAST(i AS INTEGER))
           AS window_start, *
  FROM (SELECT *, UNNEST(range(5)) AS i FROM ev)
),
agg AS (
  SELECT window_start, window_start + INTERVAL 5 DAY AS window_end, user_id, ip_address,
         count(*) FILTER (WHERE action = 'login_failed') AS n_login,
         count(*) FILTER (WHERE action = 'transaction_success') AS n_txn,
         sum(amount) FILTER (WHERE action = 'transaction_success' AND NOT isnan(amount)) AS txn_amount,
         count(*) FILTER (WHERE action IN ('page_view', 'product_click')) AS n_click
  FROM win
  GROUP BY window_start, user_id, ip_address
)"""

LOGIN_ROWS = """
  SELECT window_start, window_end, user_id, ip_address,
         'CREDENTIAL_STUFFING_BRUTE_FORCE' AS anomaly_type, 'HIGH' AS severity,
         CAST(n_login AS INTEGER) AS event_count, CAST(0.0 AS DOUBLE) AS total_amount,
         'Multiple failed login attempts exceeding security threshold' AS details
  FROM agg WHERE n_login >= 3"""

TXN_ROWS = """
  SELECT window_start, window_end, user_id, ip_address,
         'TRANSACTION_VELOCITY_SPIKE' AS anomaly_type, 'CRITICAL' AS severity,
         CAST(n_txn AS INTEGER) AS event_count, txn_amount AS total_amount,
         'High volume or high cumulative transaction amount in window' AS details
  FROM agg WHERE n_txn > 0 AND (n_txn >= 3 OR txn_amount >= 200.0)"""

CLICK_ROWS = """
  SELECT window_start, window_end, user_id, ip_address,
         'BOT_SCRAPING_BURST' AS anomaly_type, 'MEDIUM' AS severity,
         CAST(n_click AS INTEGER) AS event_count, CAST(0.0 AS DOUBLE) AS total_amount,
         'Rapid clickstream request frequency matching bot signature' AS details
  FROM agg WHERE n_click >= 4"""

ALERT_OUT = ("window_start, window_end, user_id, ip_address, anomaly_type, severity, event_count, "
             "round(total_amount, 2) AS total_amount, details")


def _alerts_cte(*branches: str) -> str:
    return "WITH " + WINDOWED + ",\nalerts AS (" + "\n  UNION ALL".join(branches) + "\n)\n"


ALL_ALERTS = _alerts_cte(LOGIN_ROWS, TXN_ROWS, CLICK_ROWS)
# Alerts with detection_timestamp = window_end (the data-derived stamp).
STAMPED = ALL_ALERTS.rstrip() + ",\nstamped AS (SELECT *, window_end AS detection_timestamp FROM alerts)\n"

TRAILING = "WITH " + EV + """,
rng AS (
  SELECT *, (SELECT max(event_time) FROM ev) AS as_of FROM ev
  WHERE event_time >= (SELECT max(event_time) FROM ev) - INTERVAL 7200 MINUTE
),
pair AS (
  SELECT user_id, ip_address, any_value(as_of) AS as_of,
         count(*) FILTER (WHERE action = 'login_failed') AS n_login,
         count(*) FILTER (WHERE action = 'transaction_success') AS n_txn,
         coalesce(sum(amount) FILTER (WHERE action = 'transaction_success' AND NOT isnan(amount)),
                  CAST(0.0 AS DOUBLE)) AS txn_amount
  FROM rng GROUP BY user_id, ip_address
),
per_ip AS (
  SELECT ip_address, any_value(as_of) AS as_of, count(*) AS n_click
  FROM rng WHERE action IN ('page_view', 'product_click') GROUP BY ip_address
)
SELECT as_of - INTERVAL 7200 MINUTE AS window_start, as_of AS window_end, user_id, ip_address,
       'CREDENTIAL_STUFFING_BRUTE_FORCE' AS anomaly_type, 'HIGH' AS severity,
       CAST(n_login AS INTEGER) AS event_count, CAST(0.0 AS DOUBLE) AS total_amount,
       CAST(n_login AS VARCHAR) || ' failed login attempts in 7200-minute sliding window' AS details,
       as_of AS detection_timestamp
FROM pair WHERE n_login >= 3
UNION ALL
SELECT as_of - INTERVAL 7200 MINUTE, as_of, user_id, ip_address,
       'TRANSACTION_VELOCITY_SPIKE', 'CRITICAL', CAST(n_txn AS INTEGER), round(txn_amount, 2),
       'Rapid sequence: ' || CAST(n_txn AS VARCHAR) || ' transactions totaling $' || format('{:,.2f}', txn_amount),
       as_of
FROM pair WHERE n_txn > 0 AND (n_txn >= 3 OR txn_amount >= 200.0)
UNION ALL
SELECT as_of - INTERVAL 7200 MINUTE, as_of, 'automated_client', ip_address,
       'BOT_SCRAPING_BURST', 'MEDIUM', CAST(n_click AS INTEGER), CAST(0.0 AS DOUBLE),
       'Volumetric spike: ' || CAST(n_click AS VARCHAR) || ' requests within window',
       as_of
FROM per_ip WHERE n_click >= 20
"""

ORDER_ALERTS = ("detection_timestamp DESC NULLS LAST, window_start DESC NULLS LAST, anomaly_type ASC NULLS FIRST, "
                "user_id ASC NULLS FIRST, ip_address ASC NULLS FIRST")

# One-day tumbling windows.
TUMBLING = EV + """,
tagg AS (
  SELECT time_bucket(INTERVAL '1 day', event_time, TIMESTAMP '1970-01-01') AS window_start, user_id, ip_address,
         count(*) FILTER (WHERE action = 'login_failed') AS n_login,
         count(*) FILTER (WHERE action = 'transaction_success') AS n_txn,
         sum(amount) FILTER (WHERE action = 'transaction_success' AND NOT isnan(amount)) AS txn_amount,
         count(*) FILTER (WHERE action IN ('page_view', 'product_click')) AS n_click
  FROM ev GROUP BY 1, 2, 3
),
agg AS (SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, * EXCLUDE (window_start) FROM tagg)"""

# Transactions per (5-day window, user), IP not a key.
PER_USER = EV + """,
win AS (
  SELECT time_bucket(INTERVAL '1 day', event_time, TIMESTAMP '1970-01-01') - to_days(CAST(i AS INTEGER))
           AS window_start, *
  FROM (SELECT *, UNNEST(range(5)) AS i FROM ev)
),
agg AS (
  SELECT window_start, window_start + INTERVAL 5 DAY AS window_end, user_id, CAST(NULL AS VARCHAR) AS ip_address,
         count(*) AS n_txn, sum(amount) FILTER (WHERE NOT isnan(amount)) AS txn_amount
  FROM win WHERE action = 'transaction_success'
  GROUP BY window_start, user_id
)"""

# Windows of 10 days sliding by 12 hours, per user, with thresholds of their own.
LONG = EV + """,
win AS (
  SELECT time_bucket(INTERVAL '12 hours', event_time, TIMESTAMP '1970-01-01') - to_hours(CAST(12 * i AS BIGINT))
           AS window_start, *
  FROM (SELECT *, UNNEST(range(20)) AS i FROM ev)
),
agg AS (
  SELECT window_start, window_start + INTERVAL 10 DAY AS window_end, user_id, CAST(NULL AS VARCHAR) AS ip_address,
         count(*) FILTER (WHERE action = 'login_failed') AS n_login,
         count(*) FILTER (WHERE action = 'transaction_success') AS n_txn,
         sum(amount) FILTER (WHERE action = 'transaction_success' AND NOT isnan(amount)) AS txn_amount,
         count(*) FILTER (WHERE action IN ('page_view', 'product_click')) AS n_click
  FROM win GROUP BY window_start, user_id
)"""
LONG_ALERTS = ("WITH " + LONG + ",\nalerts AS (" + "\n  UNION ALL".join((
    LOGIN_ROWS.replace("n_login >= 3", "n_login >= 6"),
    TXN_ROWS.replace("n_txn >= 3 OR txn_amount >= 200.0", "n_txn >= 6 OR txn_amount >= 600.0"),
    CLICK_ROWS.replace("n_click >= 4", "n_click >= 10"))) + "\n)\n")

# The table in three slices: equal parts of its time, but every eleventh event comes with the last one. A slice meets the
# watermark of the slices before it; a window that ends at or before that is closed to its events.
SLICED = EV + """,
span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
sev AS (
  SELECT ev.*, CASE WHEN e.event_id % 11 = 0 THEN 2 ELSE ((epoch_us(e.ts) - lo) * 3) // (hi - lo + 1) END AS slice
  FROM ev JOIN events e ON ev.event_id = CAST(e.event_id AS VARCHAR), span
),
wm AS (
  SELECT s, (SELECT date_trunc('milliseconds', max(event_time)) FROM sev WHERE slice < s) - INTERVAL 10 MINUTE AS mark
  FROM range(4) r(s)
),
swin AS (
  SELECT *, window_start + INTERVAL 5 DAY AS window_end FROM (
    SELECT time_bucket(INTERVAL '1 day', event_time, TIMESTAMP '1970-01-01') - to_days(CAST(i AS INTEGER)) AS window_start, *
    FROM (SELECT *, UNNEST(range(5)) AS i FROM sev))
),
met AS (SELECT swin.*, mark IS NOT NULL AND window_end <= mark AS late FROM swin JOIN wm ON wm.s = slice)"""
SLICED_AGG = """
  SELECT window_start, window_end, user_id, ip_address,
         count(*) FILTER (WHERE action = 'login_failed') AS n_login,
         count(*) FILTER (WHERE action = 'transaction_success') AS n_txn,
         sum(amount) FILTER (WHERE action = 'transaction_success' AND NOT isnan(amount)) AS txn_amount,
         count(*) FILTER (WHERE action IN ('page_view', 'product_click')) AS n_click
  FROM met WHERE NOT late"""
ALL_RULES = "\n  UNION ALL".join((LOGIN_ROWS, TXN_ROWS, CLICK_ROWS))
SLICED_ALERTS = ("WITH " + SLICED + f",\nagg AS ({SLICED_AGG}\n  GROUP BY ALL),\nalerts AS ({ALL_RULES}\n),\n"
                 "closed AS (SELECT * FROM alerts WHERE window_end <= (SELECT mark FROM wm WHERE s = 3))\n")
# What each window amounts to after each slice; the version that fires first is the one that is logged.
SLICED_FIRST = ("WITH " + SLICED + f""",
after0 AS ({SLICED_AGG} AND slice <= 0 GROUP BY ALL), after1 AS ({SLICED_AGG} AND slice <= 1 GROUP BY ALL), after2 AS ({SLICED_AGG} GROUP BY ALL),
versions AS (
  SELECT 0 AS batch, * FROM ({ALL_RULES.replace("FROM agg", "FROM after0")})
  UNION ALL SELECT 1, * FROM ({ALL_RULES.replace("FROM agg", "FROM after1")})
  UNION ALL SELECT 2, * FROM ({ALL_RULES.replace("FROM agg", "FROM after2")})
),
alerts AS (SELECT * EXCLUDE (batch) FROM versions QUALIFY row_number() OVER (
  PARTITION BY user_id, ip_address, anomaly_type, window_end ORDER BY batch) = 1)
""")


# Records with single fields missing: field i is left out where the event id is a multiple of 101 + i.
_FIELDS = ("event_id", "timestamp", "user_id", "session_id", "ip_address", "device_type", "location_country",
           "location_city", "action", "url_path", "amount", "user_agent")
_CORE = ("event_id", "timestamp", "user_id", "session_id", "ip_address", "action")
_NO_JSON = "event_id % 97 = 0"


def _lacks(field: str) -> str:
    return f"event_id % {101 + _FIELDS.index(field)} = 0"


def _partial_rejected(required: tuple[str, ...]) -> str:
    kept = {"event_id": "CAST(event_id AS VARCHAR)", "user_id": "'usr_' || CAST(user_id AS VARCHAR)",
            "action": "CASE event_type WHEN 'error' THEN 'login_failed' WHEN 'purchase' THEN 'transaction_success' "
                      "WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_click' WHEN 'signup' THEN 'login_success' ELSE event_type END"}
    columns = ", ".join(f"CASE WHEN {_NO_JSON} OR {_lacks(n)} THEN NULL ELSE {e} END AS {n}" for n, e in kept.items())
    missing = " OR ".join(_lacks(f) for f in required)
    return f"""
SELECT {columns}, CASE WHEN {_NO_JSON} THEN 'not_json_object' WHEN event_id % 89 = 0 OR {_lacks("timestamp")} THEN 'bad_timestamp'
       ELSE 'missing_fields' END AS reject_reason
FROM events WHERE {_NO_JSON} OR event_id % 89 = 0 OR {missing}"""


def _partial_errors() -> str:
    strict = [f for f in _FIELDS if f != "amount"]
    parts = [f"SELECT '{level}' AS level, '{f}' AS field, CAST(count(*) AS INTEGER) AS n_events FROM events WHERE {_NO_JSON} OR {_lacks(f)}"
             for level, fields in (("core", _CORE), ("strict", strict)) for f in fields]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n_events > 0"


def _default_amounts() -> str:
    names = ", ".join(f"CASE WHEN {_lacks(f)} THEN '{f}' END" for f in _FIELDS if f not in ("amount", "timestamp"))
    return f"""
SELECT CASE WHEN {_lacks("event_id")} THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id, ts AS event_time,
       CASE WHEN event_type = 'purchase' AND NOT ({_lacks("amount")}) THEN value ELSE CAST(0.0 AS DOUBLE) END AS amount,
       concat_ws(',', {names}) AS errors
FROM events WHERE NOT ({_NO_JSON}) AND event_id % 89 <> 0 AND NOT ({_lacks("timestamp")})"""


def _sliced_trailing() -> str:
    """The trailing rules over the slices so far, as of their latest event."""
    body = TRAILING[TRAILING.index("rng AS"):]
    parts = []
    for n in range(3):
        part = body.replace("FROM ev", f"FROM (SELECT * FROM sev WHERE slice <= {n})")
        ctes, _, select = part.partition("\nSELECT as_of - INTERVAL")
        parts.append(f"SELECT *, {n} AS batch_id FROM (WITH {ctes} SELECT as_of - INTERVAL{select})")
    return "WITH " + SLICED + "\n" + "\nUNION ALL ".join(parts)


ORACLE_SQL = {
    "parse_events": f"WITH {EV}\nSELECT {EV_COLUMNS} FROM ev",
    "rejected_events": """
SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'usr_' || CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN event_id % 97 = 0 THEN NULL
            ELSE CASE event_type WHEN 'error' THEN 'login_failed'
                                 WHEN 'purchase' THEN 'transaction_success'
                                 WHEN 'view' THEN 'page_view'
                                 WHEN 'click' THEN 'product_click'
                                 WHEN 'signup' THEN 'login_success'
                                 ELSE event_type END END AS action,
       CASE WHEN event_id % 97 = 0 THEN 'not_json_object' ELSE 'bad_timestamp' END AS reject_reason
FROM events
WHERE event_id % 97 = 0 OR event_id % 89 = 0""",
    "validation_errors": """
WITH fields(level, field) AS (VALUES
  ('core', 'event_id'), ('core', 'timestamp'), ('core', 'user_id'), ('core', 'session_id'),
  ('core', 'ip_address'), ('core', 'action'),
  ('strict', 'event_id'), ('strict', 'timestamp'), ('strict', 'user_id'), ('strict', 'session_id'),
  ('strict', 'ip_address'), ('strict', 'device_type'), ('strict', 'location_country'),
  ('strict', 'location_city'), ('strict', 'action'), ('strict', 'url_path'), ('strict', 'user_agent'))
SELECT level, field, CAST((SELECT count(*) FROM events WHERE event_id % 97 = 0) AS INTEGER) AS n_events
FROM fields WHERE (SELECT count(*) FROM events WHERE event_id % 97 = 0) > 0""",
    "brute_force": _alerts_cte(LOGIN_ROWS) + f"SELECT {ALERT_OUT} FROM alerts",
    "transaction_velocity": _alerts_cte(TXN_ROWS) + f"SELECT {ALERT_OUT} FROM alerts",
    "click_burst": _alerts_cte(CLICK_ROWS) + f"SELECT {ALERT_OUT} FROM alerts",
    "detect_alerts": ALL_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "detect_alerts_union": ALL_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "pane_alerts": ALL_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "pane_alerts_long_windows": LONG_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "per_user_velocity": "WITH " + PER_USER + ",\nalerts AS (" + TXN_ROWS + "\n)\n" + f"SELECT {ALERT_OUT} FROM alerts",
    "tumbling_alerts": "WITH " + TUMBLING + ",\nalerts AS (" + "\n  UNION ALL".join((LOGIN_ROWS, TXN_ROWS, CLICK_ROWS))
                       + "\n)\n" + f"SELECT {ALERT_OUT} FROM alerts",
    "split_valid_events": f"WITH {EV}\nSELECT {EV_COLUMNS} FROM ev",
    "trailing_alerts": TRAILING,
    "first_alerts": STAMPED + f"""
SELECT {ALERT_OUT}, detection_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, anomaly_type, window_end
                               ORDER BY detection_timestamp, window_start, ip_address) AS rn
  FROM stamped) WHERE rn = 1""",
    "new_alerts": STAMPED + f"""
SELECT {ALERT_OUT}, detection_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, anomaly_type, window_end
                               ORDER BY detection_timestamp, window_start, ip_address) AS rn
  FROM stamped) f
WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM stamped r
  WHERE epoch(r.window_start) < (SELECT (min(epoch(window_start)) + max(epoch(window_start))) / 2 FROM stamped)
    AND r.user_id IS NOT DISTINCT FROM f.user_id AND r.anomaly_type IS NOT DISTINCT FROM f.anomaly_type
    AND r.window_end IS NOT DISTINCT FROM f.window_end)""",
    "latest_alerts": STAMPED + f"SELECT {ALERT_OUT}, detection_timestamp FROM stamped",
    "recent_alerts": STAMPED + f"SELECT {ALERT_OUT}, detection_timestamp FROM stamped ORDER BY {ORDER_ALERTS} LIMIT 200",
    "alert_feed": STAMPED + f"""
SELECT detection_timestamp, anomaly_type, severity, user_id, ip_address, event_count,
       round(total_amount, 2) AS total_amount, details
FROM stamped ORDER BY {ORDER_ALERTS} LIMIT 30""",
    "recent_events": f"WITH {EV}\nSELECT {EV_COLUMNS} FROM ev ORDER BY event_time DESC, event_id DESC LIMIT 1000",
    "alert_kpis": ALL_ALERTS + """
SELECT CAST(count(*) AS BIGINT) AS total_alerts,
       CAST(count(*) FILTER (WHERE severity = 'CRITICAL') AS BIGINT) AS critical_alerts,
       CAST(count(*) FILTER (WHERE severity = 'HIGH') AS BIGINT) AS high_alerts,
       CAST(count(DISTINCT CASE WHEN ip_address <> '' THEN ip_address END) AS BIGINT) AS flagged_ips
FROM alerts""",
    "buffer_kpis": STAMPED + f"""
SELECT CAST(count(*) AS BIGINT) AS total_alerts,
       CAST(count(*) FILTER (WHERE severity = 'CRITICAL') AS BIGINT) AS critical_alerts,
       CAST(count(*) FILTER (WHERE severity = 'HIGH') AS BIGINT) AS high_alerts,
       CAST(count(DISTINCT CASE WHEN ip_address <> '' THEN ip_address END) AS BIGINT) AS flagged_ips
FROM (SELECT * FROM stamped ORDER BY {ORDER_ALERTS} LIMIT 200)""",
    "event_count": f"WITH {EV}\nSELECT CAST(count(*) AS BIGINT) AS total_events FROM ev",
    "alerts_by_type": ALL_ALERTS + """
SELECT anomaly_type, CAST(count(*) AS BIGINT) AS alert_count FROM alerts
WHERE anomaly_type IS NOT NULL GROUP BY anomaly_type""",
    "top_ips": ALL_ALERTS + """
SELECT ip_address, CAST(count(*) AS BIGINT) AS alert_count FROM alerts
WHERE ip_address IS NOT NULL GROUP BY ip_address
ORDER BY alert_count DESC, ip_address ASC LIMIT 6""",
    "encode_alerts_roundtrip": ALL_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "encode_events_roundtrip": f"WITH {EV}\nSELECT {EV_COLUMNS} FROM ev",
    "stream_events_parquet": f"WITH {EV}\nSELECT {EV_COLUMNS} FROM ev",
    "backfill_from_sink": ALL_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "stream_alerts_update": ALL_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "pipeline_alerts_from_events": ALL_ALERTS + f"""
SELECT {ALERT_OUT} FROM alerts
WHERE window_end <= (SELECT max(event_time) FROM ev) - INTERVAL 10 MINUTE""",
    "stream_first_alerts": ALL_ALERTS + f"""
SELECT {ALERT_OUT} FROM alerts
WHERE window_end <= (SELECT max(event_time) FROM ev) - INTERVAL 10 MINUTE""",
    "stream_alerts_append": ALL_ALERTS + f"""
SELECT {ALERT_OUT} FROM alerts
WHERE window_end <= (SELECT max(event_time) FROM ev) - INTERVAL 10 MINUTE""",
    "split_rejected_events": _partial_rejected(_CORE),
    "partial_rejected_events": _partial_rejected(tuple(f for f in _FIELDS if f != "amount")),
    "partial_validation_errors": _partial_errors(),
    "default_amounts": _default_amounts(),
    "alert_stamps": ALL_ALERTS + """
SELECT anomaly_type, CAST(count(*) AS BIGINT) AS n_alerts, CAST(1 AS BIGINT) AS n_stamps, true AS stamped_now
FROM alerts GROUP BY anomaly_type""",
    "sliced_compacted_events": f"WITH {EV}\nSELECT {EV_COLUMNS} FROM ev",
    "sliced_alerts_append": SLICED_ALERTS + f"SELECT {ALERT_OUT} FROM closed",
    "sliced_window_store": SLICED_ALERTS + f"SELECT {ALERT_OUT} FROM closed",
    "sliced_late_rows": "WITH " + SLICED + """
SELECT event_id, user_id, action, event_time, CAST(count(*) FILTER (WHERE late) AS INTEGER) AS n_closed,
       bool_and(late) AS dropped, CAST(slice AS INTEGER) AS batch_id
FROM met WHERE action IN ('login_failed', 'transaction_success', 'page_view', 'product_click')
GROUP BY event_id, user_id, action, event_time, slice HAVING bool_or(late)""",
    "sliced_alert_log": SLICED_FIRST + f"SELECT {ALERT_OUT} FROM alerts",
    "sliced_latest_view": SLICED_ALERTS + f"SELECT {ALERT_OUT} FROM alerts",
    "sliced_recent_events": f"WITH {EV}\nSELECT {EV_COLUMNS} FROM ev ORDER BY event_time DESC, event_id DESC LIMIT 1000",
    "sliced_recent_alerts": SLICED_ALERTS + f"""
SELECT {ALERT_OUT}, detection_timestamp FROM (SELECT *, window_end AS detection_timestamp FROM closed)
ORDER BY {ORDER_ALERTS} LIMIT 200""",
    "sliced_trailing_alerts": _sliced_trailing(),
    "sliced_fan_out": SLICED_ALERTS + f"""
SELECT {ALERT_OUT}, 'alerts' AS sink FROM closed UNION ALL SELECT {ALERT_OUT}, 'updates' AS sink FROM alerts""",
}
