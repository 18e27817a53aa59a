"""DuckDB oracle SQL for every registered query (driver correctness gate).

Each statement rebuilds the telemetry mapping of
:mod:`shopfloor.sources.testdata` from the raw tables in plain SQL and
computes the expected answer independently of the Spark code: scoring with
window frames, dedup with ``QUALIFY``, normalization straight from the
columns the raw payloads were made of.
"""

from __future__ import annotations

# Fixed values of the domain, written out here so that a wrong constant in
# the library can't make both sides agree.
METRICS = ("temperature", "vibration", "rpm", "pressure", "power_kw", "current_a", "voltage_v", "humidity", "flow_rate")
LIMITS = (  # metric, lowest, highest, z threshold
    ("temperature", 0, 200, 3.0), ("vibration", 0, 5.0, 3.5), ("rpm", 0, 10000, 3.0), ("pressure", 0, 500, 3.0),
    ("power_kw", 0, 100, 3.0), ("current_a", 0, 200, 3.0), ("voltage_v", 200, 500, 2.5))


def _d(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


BASE = f"""
ev AS (
  SELECT event_id AS eid, user_id AS uid, event_type AS et, value AS val,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts
  FROM events
),
orig AS (
  SELECT 'M-' || CAST(uid AS VARCHAR) AS machine_id,
         'P-' || CAST(uid % 3 AS VARCHAR) AS plant_id,
         'L-' || CAST(uid % 7 AS VARCHAR) AS line_id,
         CASE eid % 3 WHEN 0 THEN 'mqtt' WHEN 1 THEN 'modbus' ELSE 'opcua' END AS source_protocol,
         'E-' || CAST(eid AS VARCHAR) AS event_id,
         ts AS "timestamp",
         CASE WHEN k % 10 <> 9 AND et = 'click' THEN val END AS temperature,
         CASE WHEN k % 10 <> 9 AND et = 'view' THEN val / {_d(100)} END AS vibration,
         CASE WHEN k % 10 <> 9 AND et = 'signup' THEN val * {_d(20)} END AS rpm,
         CASE WHEN et = 'error' THEN {_d(101.3)} END AS pressure,
         CASE WHEN k % 10 <> 9 AND et = 'purchase' THEN val END AS power_kw,
         CAST(NULL AS DOUBLE) AS current_a,
         CASE WHEN k % 10 <> 9 AND et = 'error' THEN val + {_d(200)} END AS voltage_v,
         CASE WHEN k % 3 = 0 THEN CAST(k AS DOUBLE) END AS humidity,
         CAST(NULL AS DOUBLE) AS flow_rate,
         CASE et WHEN 'click' THEN 'running' WHEN 'view' THEN 'idle'
                 WHEN 'purchase' THEN 'maintenance' WHEN 'error' THEN 'fault'
                 ELSE 'unknown' END AS status,
         'phase3-runtime-v1' AS pipeline_version,
         eid * 2 AS seq
  FROM ev
),
arrivals AS (
  SELECT * FROM orig
  UNION ALL
  SELECT * REPLACE ('redelivered' AS pipeline_version, seq + 1 AS seq) FROM orig WHERE seq % 20 = 0
)"""


def _iso(col: str) -> str:
    return (f"(strftime({col}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({col}) % 1000000 <> 0 "
            f"THEN '.' || lpad(CAST(epoch_us({col}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END "
            f"|| '+00:00')")


def _event_id(protocol: str, time: str) -> str:
    """sha256 of the canonical JSON text: keys in order, null metrics left out."""
    text = lambda c: f"COALESCE('\"' || {c} || '\"', 'null')"
    metrics = ", ".join(f"'\"{m}\":' || CAST({m} AS VARCHAR)" for m in sorted(METRICS))
    return (f"sha256('{{\"line_id\":' || {text('line_id')} || ',\"machine_id\":' || {text('machine_id')} || "
            f"',\"metrics\":{{' || concat_ws(',', {metrics}) || '}},\"plant_id\":' || {text('plant_id')} || "
            f"',\"source_protocol\":\"' || {protocol} || '\",\"status\":\"' || status || "
            f"'\",\"timestamp\":\"' || {_iso(time)} || '\"}}')")


def _cfg_values() -> str:
    rows = []
    for name, low, high, threshold in LIMITS:
        rows.append(f"('{name}', {_d(low)}, {_d(high)}, {_d(threshold)})")
    return ", ".join(rows)


def scoring(src: str, p: str, window: int = 60) -> str:
    """CTEs ``{p}_scores(machine_id, seq, anomaly_score, anomaly_flags)``
    scoring every row of CTE ``src`` with fresh state."""
    fw = 10  # values in a flat run
    unpivot = "\n  UNION ALL\n  ".join(
        f"SELECT machine_id, seq, '{m}' AS metric, {m} AS value FROM {src} WHERE {m} IS NOT NULL"
        for m in METRICS)
    return f"""
{p}_long AS (
  {unpivot}
),
{p}_cfg(metric, lo, hi, thr) AS (VALUES {_cfg_values()}),
{p}_w AS (
  SELECT l.*, count(value) OVER pw AS n, avg(value) OVER pw AS mean, stddev_pop(value) OVER pw AS sd,
         count(value) OVER fw AS fn, max(value) OVER fw - min(value) OVER fw AS fspan
  FROM {p}_long l
  WINDOW pw AS (PARTITION BY machine_id, metric ORDER BY seq ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING),
         fw AS (PARTITION BY machine_id, metric ORDER BY seq ROWS BETWEEN {fw - 1} PRECEDING AND CURRENT ROW)
),
{p}_z AS (
  SELECT w.*, c.lo, c.hi, COALESCE(c.thr, {_d(3)}) AS thr,
         CASE WHEN n >= 10 THEN
           CASE WHEN sd < 1e-09 THEN abs(value - mean) ELSE abs(value - mean) / sd END END AS z
  FROM {p}_w w LEFT JOIN {p}_cfg c ON c.metric = w.metric
),
{p}_sig AS (
  SELECT machine_id, seq,
    CASE WHEN lo IS NOT NULL AND value < lo THEN {_d(0.8)}
         WHEN hi IS NOT NULL AND value > hi THEN {_d(0.9)} END AS s_range,
    CASE WHEN z > thr * {_d(1.5)} THEN least({_d(1.0)}, z / (thr * {_d(3.0)}))
         WHEN z > thr THEN least({_d(0.7)}, z / (thr * {_d(2.0)})) END AS s_z,
    CASE WHEN {window} >= {fw} AND fn >= {fw} AND fspan < {_d(0.0001)} THEN {_d(0.4)} END AS s_flat,
    COALESCE((lo IS NOT NULL AND value < lo) OR (hi IS NOT NULL AND value > hi), false) AS f_range,
    COALESCE(z > thr * {_d(1.5)}, false) AS f_spike,
    COALESCE(z > thr AND NOT (z > thr * {_d(1.5)}), false) AS f_drift,
    COALESCE({window} >= {fw} AND fn >= {fw} AND fspan < {_d(0.0001)}, false) AS f_flat
  FROM {p}_z
),
{p}_scores AS (
  SELECT a.machine_id, a.seq,
    round(COALESCE(max(greatest(s.s_range, s.s_z, s.s_flat)), {_d(0)}), 4) AS anomaly_score,
    concat_ws(',', CASE WHEN bool_or(s.f_drift) THEN 'DRIFT' END,
                   CASE WHEN bool_or(s.f_flat) THEN 'FLATLINE' END,
                   CASE WHEN bool_or(s.f_range) THEN 'OUT_OF_RANGE' END,
                   CASE WHEN bool_or(s.f_spike) THEN 'SPIKE' END) AS anomaly_flags
  FROM {src} a LEFT JOIN {p}_sig s ON s.machine_id = a.machine_id AND s.seq = a.seq
  GROUP BY a.machine_id, a.seq
)"""


STORE = f"""{BASE},
{scoring('arrivals', 'a')},
live AS (
  SELECT a.*, s.anomaly_score, s.anomaly_flags
  FROM arrivals a JOIN a_scores s ON s.machine_id = a.machine_id AND s.seq = a.seq
),
store AS (
  SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq) = 1
)"""


def _with(body: str, ctes: str = STORE) -> str:
    return f"WITH {ctes}\n{body}"


def _mqtt_ctes() -> str:
    return """
mq AS (
  SELECT eid AS arrival_seq, uid, val, k, k % 8 AS kind, ts FROM ev
),
mq_good AS (
  SELECT arrival_seq,
    CASE WHEN uid % 11 = 0 THEN 'unknown' ELSE 'M-' || CAST(uid AS VARCHAR) END AS machine_id,
    'P' || CAST(uid % 3 AS VARCHAR) AS plant_id,
    CASE WHEN uid % 11 = 0 THEN NULL ELSE 'L' || CAST(uid % 7 AS VARCHAR) END AS line_id,
    CASE kind WHEN 0 THEN 'running' WHEN 1 THEN 'idle' WHEN 4 THEN 'fault'
              WHEN 7 THEN 'maintenance' ELSE 'unknown' END AS status,
    epoch_us(date_trunc('second', ts)) AS ts_us, date_trunc('second', ts) AS seen,
    CASE WHEN kind IN (0, 1, 2) THEN val END AS temperature,
    CASE WHEN kind = 1 THEN CAST(0.5 AS DOUBLE) END AS vibration,
    CASE WHEN kind = 4 THEN val END AS rpm,
    CAST(NULL AS DOUBLE) AS pressure,
    CASE WHEN kind = 3 THEN val END AS power_kw,
    CASE WHEN kind = 7 THEN CAST(0.0 AS DOUBLE) END AS current_a,
    CASE WHEN kind = 7 THEN val END AS voltage_v,
    CASE WHEN kind = 4 THEN CAST(k AS DOUBLE) END AS humidity,
    CASE WHEN kind = 3 THEN CAST(1.0 AS DOUBLE) END AS flow_rate,
    CASE WHEN kind IN (0, 2) THEN 1 WHEN kind IN (1, 3, 4, 7) THEN 2 END AS n_metrics
  FROM mq WHERE kind NOT IN (5, 6)
)"""


def _modbus_ctes() -> str:
    return f"""
dev AS (
  SELECT s_suppkey, r_name AS plant_id, n_name AS line_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
mb_raw AS (
  SELECT l_orderkey * 8 + l_linenumber AS arrival_seq, l_suppkey, CAST(l_shipdate AS TIMESTAMP) AS seen,
         CAST(floor(l_quantity) AS INTEGER) AS r1,
         CAST(floor(l_discount * 1000 + 0.5) AS INTEGER) AS r2,
         CAST(l_partkey % 10000 AS INTEGER) AS r3,
         CAST(floor(l_tax * 1000 + 0.5) AS INTEGER) AS r4,
         CAST(floor(l_extendedprice) AS INTEGER) AS r5,
         l_linenumber % 5 AS code
  FROM lineitem WHERE l_orderkey % 50 <> 0
),
mb AS (
  SELECT arrival_seq, seen, epoch_us(seen) AS ts_us, 'S-' || CAST(l_suppkey AS VARCHAR) AS machine_id, plant_id, line_id,
    CASE code WHEN 0 THEN 'idle' WHEN 1 THEN 'running' WHEN 2 THEN 'fault'
              WHEN 3 THEN 'maintenance' ELSE 'unknown' END AS status,
    CAST(r1 AS DOUBLE) * {_d(0.1)} AS temperature,
    CAST(r2 AS DOUBLE) * {_d(0.001)} AS vibration,
    CAST(r3 AS DOUBLE) * {_d(1.0)} AS rpm,
    CASE WHEN l_suppkey % 4 <> 0 THEN CAST(r4 AS DOUBLE) * {_d(0.1)} END AS pressure,
    CASE WHEN l_suppkey % 4 <> 0 THEN CAST(r5 AS DOUBLE) * {_d(0.01)} END AS power_kw,
    CASE WHEN l_suppkey % 4 <> 0 THEN CAST(0 AS DOUBLE) * {_d(0.01)} END AS current_a,
    CASE WHEN l_suppkey % 4 <> 0 THEN CAST(0 AS DOUBLE) * {_d(0.1)} END AS voltage_v,
    CAST(NULL AS DOUBLE) AS humidity, CAST(NULL AS DOUBLE) AS flow_rate,
    CASE WHEN l_suppkey % 4 <> 0 THEN 7 ELSE 3 END AS n_metrics
  FROM mb_raw JOIN dev ON dev.s_suppkey = mb_raw.l_suppkey
)"""


def _opcua_ctes() -> str:
    return f"""
ua AS (
  SELECT eid AS arrival_seq, 'O-' || CAST(uid % 40 AS VARCHAR) AS machine_id, ts AS seen, epoch_us(ts) AS ts_us,
    CAST(NULL AS VARCHAR) AS plant_id, CAST(NULL AS VARCHAR) AS line_id,
    CASE et WHEN 'error' THEN 'fault' WHEN 'view' THEN 'idle' ELSE 'running' END AS status,
    CASE WHEN k % 5 = 0 THEN CAST(k AS DOUBLE) ELSE val END AS temperature,
    CAST(NULL AS DOUBLE) AS vibration,
    CAST(k * 10 AS DOUBLE) AS rpm,
    CAST(NULL AS DOUBLE) AS pressure,
    CASE WHEN k % 4 <> 0 THEN val / {_d(10)} END AS power_kw,
    CAST(NULL AS DOUBLE) AS current_a, CAST(NULL AS DOUBLE) AS voltage_v,
    CAST(NULL AS DOUBLE) AS humidity, CAST(NULL AS DOUBLE) AS flow_rate,
    CASE WHEN k % 4 <> 0 THEN 3 ELSE 2 END AS n_metrics
  FROM ev
)"""


_M = ", ".join(METRICS)

SQL = {
    "score_readings": _with("SELECT seq, machine_id, anomaly_score, anomaly_flags FROM a_scores"),
    "score_readings_split": _with("SELECT seq, machine_id, anomaly_score, anomaly_flags FROM a_scores"),
    "score_skewed": _with(
        "SELECT seq, NULLIF(machine_id, '') AS machine_id, anomaly_score, anomaly_flags FROM k_scores",
        BASE + """,
skewed AS (
  SELECT * REPLACE (
    CASE WHEN (seq // 2) % 3 = 0 THEN 'M-HOT' WHEN (seq // 2) % 25 = 1 THEN '' ELSE machine_id END AS machine_id,
    seq + CASE WHEN seq % 4000 >= 2000 THEN 1099511627776 ELSE 0 END AS seq) FROM arrivals
),
""" + scoring("skewed", "k")),
    "dedup_store": _with("SELECT seq, event_id, machine_id, pipeline_version, anomaly_score, "
                         "anomaly_flags FROM store"),
    "public_view": _with(
        f"SELECT seq, event_id, machine_id, plant_id, line_id, source_protocol, "
        f"{_iso('\"timestamp\"')} AS \"timestamp\", {_iso('\"timestamp\"')} AS ingested_at, status, "
        f"anomaly_score, anomaly_flags, pipeline_version, 'rules-v1' AS detector_version, "
        f"{_M} FROM store"),
    "manual_ingest": _with(
        f"SELECT seq, CASE WHEN seq % 6 IN (0, 2) THEN {_event_id('source_protocol', '\"timestamp\"')} ELSE event_id END AS event_id, "
        "'manual-ingest' AS pipeline_version, "
        f"'rules-v1' AS detector_version, anomaly_score, "
        "CAST(NULL AS VARCHAR) AS error FROM live"),
    "pipeline_stats": _with(
        "SELECT count(*) AS total_readings, count(*) FILTER (WHERE anomaly_flags <> '') AS total_anomalies, "
        "count(DISTINCT machine_id) AS active_machines, arg_max(event_id, seq) AS last_event_id FROM store"),
    "protocol_counts": _with("SELECT source_protocol, count(*) AS readings FROM store GROUP BY source_protocol"),
    "active_machines": _with("SELECT DISTINCT machine_id FROM arrivals", BASE),
    "anomalous_readings": _with(f"SELECT seq, machine_id, anomaly_score FROM store "
                                f"WHERE anomaly_score >= {_d(0.5)}"),
    "machine_list": _with(
        "SELECT machine_id, arg_max(plant_id, seq) AS plant_id, arg_max(line_id, seq) AS line_id, "
        "arg_max(source_protocol, seq) AS protocol, arg_max(status, seq) AS status, "
        f"{_iso('arg_max(\"timestamp\", seq)')} AS last_seen, count(*) AS reading_count, "
        "arg_max(event_id, seq) AS event_id FROM store GROUP BY machine_id ORDER BY machine_id"),
    "recent_readings": _with(
        f"SELECT machine_id, seq, rank, event_id, {_iso('\"timestamp\"')} AS \"timestamp\", anomaly_score "
        "FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY seq DESC) AS rank FROM store) "
        f"WHERE rank <= 50"),
    "latest_reading": _with(
        f"SELECT machine_id, seq, event_id, status, {_iso('\"timestamp\"')} AS \"timestamp\", anomaly_score, "
        "anomaly_flags FROM store QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY seq DESC) = 1"),
    "recent_anomalies": _with(
        "SELECT seq, event_id, machine_id, anomaly_score, anomaly_flags FROM store "
        "WHERE anomaly_flags <> '' AND anomaly_score >= CAST(0.5 AS DOUBLE) ORDER BY seq DESC LIMIT 500"),
    "recent_anomalies_retained": _with(
        f"SELECT seq, event_id, machine_id, anomaly_score, anomaly_flags FROM "
        f"(SELECT * FROM store WHERE anomaly_flags <> '' ORDER BY seq DESC LIMIT 1000) "
        f"WHERE anomaly_score >= {_d(0.5)} ORDER BY seq DESC LIMIT 500"),
    "cursor_tail": _with(
        "SELECT seq, event_id, machine_id FROM store WHERE seq > COALESCE((SELECT max(seq) FROM store "
        f"WHERE event_id = 'E-5000'), -1) ORDER BY seq LIMIT 100"),
    "replay_window": _with(
        f"SELECT s.seq, s.machine_id, s.anomaly_score, s.anomaly_flags, "
        f"'replay-v1' AS pipeline_version, 'rules-replay-v1' AS detector_version "
        "FROM r_scores s",
        STORE + ",\nsel AS (SELECT * FROM store WHERE \"timestamp\" >= TIMESTAMP '2024-01-10 00:00:00' "
        "AND \"timestamp\" <= TIMESTAMP '2024-01-20 00:00:00'),\n" + scoring("sel", "r")),
    "replay_summary": _with(
        "SELECT count(*) AS replayed, count(*) FILTER (WHERE anomaly_flags <> '') AS anomalies, "
        f"CAST(NULL AS VARCHAR) AS machine_id, 'rules-replay-v1' AS detector_version, "
        "CAST(NULL AS VARCHAR) AS output_path, CAST(0 AS BIGINT) AS exported FROM r_scores",
        STORE + ",\n" + scoring("store", "r")),
    "sql_recent": _with(
        "SELECT machine_id, seq, rank FROM (SELECT machine_id, seq, row_number() OVER "
        "(PARTITION BY machine_id ORDER BY \"timestamp\" DESC, seq DESC) AS rank FROM store) "
        f"WHERE rank <= 100"),
    "sql_anomalies": _with(
        "SELECT seq, machine_id, anomaly_score, epoch_us(\"timestamp\") AS ts_us FROM store "
        f"WHERE anomaly_score >= {_d(0.5)} AND \"timestamp\" > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR "
        "ORDER BY anomaly_score DESC, \"timestamp\" DESC, seq DESC LIMIT 500"),
    "points_pivot": _with(
        "SELECT event_id, machine_id, epoch_us(\"timestamp\") AS ts_us, "
        + ", ".join(METRICS) + ", anomaly_score, CAST(0 AS BIGINT) AS n_extra FROM store "
        "WHERE \"timestamp\" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 960 HOUR "
        "AND \"timestamp\" <= TIMESTAMP '2024-01-31 00:00:00'"),
    "metrics_view": _with(
        "SELECT metric, protocol, value FROM ("
        "SELECT 'total_readings' AS metric, '' AS protocol, CAST(count(*) AS DOUBLE) AS value FROM store "
        "UNION ALL SELECT 'total_anomalies', '', CAST(count(*) FILTER (WHERE anomaly_flags <> '') AS DOUBLE) FROM store "
        "UNION ALL SELECT 'active_machines', '', CAST(count(DISTINCT machine_id) AS DOUBLE) FROM store "
        "UNION ALL SELECT 'total_duplicates', '', CAST((SELECT count(*) FROM live) - "
        "(SELECT count(*) FROM store) AS DOUBLE) "
        "UNION ALL SELECT 'failed_events', '', CAST((SELECT count(*) FROM ev WHERE k % 8 IN (5, 6)) AS DOUBLE) "
        "UNION ALL SELECT 'readings_per_protocol', source_protocol, CAST(count(*) AS DOUBLE) FROM store "
        "GROUP BY source_protocol)"),
    "wide_rows": _with(
        f"SELECT event_id, epoch_us(\"timestamp\") AS ts_us, machine_id, plant_id, line_id, "
        f"source_protocol AS protocol, status, {_M}, anomaly_score, anomaly_flags, pipeline_version, "
        f"'rules-v1' AS detector_version FROM store"),
    "point_tags": _with(
        "SELECT event_id, 'machine_readings' AS measurement, COALESCE(NULLIF(plant_id, ''), 'unknown') AS plant_tag, "
        "COALESCE(NULLIF(line_id, ''), 'unknown') AS line_tag, source_protocol AS protocol_tag, status AS status_tag, "
        "CASE WHEN anomaly_flags = '' THEN 'none' ELSE anomaly_flags END AS flags_field, "
        "CAST(" + " + ".join(f"CASE WHEN {m} IS NULL THEN 0 ELSE 1 END" for m in METRICS)
        + " AS BIGINT) AS n_metric_fields, anomaly_score AS score_field, " + _M + ", epoch_us(\"timestamp\") * 1000 AS time_ns FROM store"),
    "ingest_accounting": _with(
        "SELECT b.*, COALESCE(f.failed, 0) AS failed, f.last_error FROM ("
        "SELECT batch_id, count(*) AS received, count(*) FILTER (WHERE is_new) AS processed, "
        "count(*) FILTER (WHERE NOT is_new) AS duplicates, "
        "count(*) FILTER (WHERE is_new AND anomaly_flags <> '') AS anomalies, "
        + ", ".join(f"count(*) FILTER (WHERE is_new AND source_protocol = '{p}') AS {p}" for p in ("mqtt", "modbus", "opcua"))
        + ", arg_max(event_id, seq) FILTER (WHERE is_new) AS last_event_id, "
        "arg_max(pipeline_version, seq) FILTER (WHERE is_new) AS pipeline_version, "
        "'rules-v1' AS detector_version FROM ("
        "SELECT *, CAST(floor(seq / 2000) AS BIGINT) AS batch_id, "
        "row_number() OVER (PARTITION BY event_id ORDER BY seq) = 1 AS is_new FROM live) GROUP BY batch_id) b LEFT JOIN ("
        "SELECT CAST(floor(eid * 2 / 2000) AS BIGINT) AS batch_id, count(*) AS failed, "
        "'payload is not a JSON object' AS last_error FROM ev WHERE k % 8 IN (5, 6) GROUP BY 1) f USING (batch_id)"),
    "event_id_groups": _with(
        "SELECT copies, count(*) AS ids FROM (SELECT count(*) AS copies FROM arrivals GROUP BY "
        f"machine_id, plant_id, line_id, source_protocol, \"timestamp\", {_M}, status) GROUP BY copies",
        BASE),
    "event_ids": _with(
        f"SELECT seq, {_event_id('source_protocol', '\"timestamp\"')} AS event_id FROM arrivals", BASE),
    "wide_append_twice": _with(
        f"SELECT event_id, epoch_us(\"timestamp\") AS ts_us, machine_id, source_protocol AS protocol, status, {_M}, "
        "anomaly_score, anomaly_flags, pipeline_version FROM store"),
    "log_round_trip": _with(
        f"SELECT seq, event_id, machine_id, {_iso('\"timestamp\"')} AS \"timestamp\", {_M}, status, anomaly_score, "
        "anomaly_flags, pipeline_version FROM store"),
    "raw_to_scored": _with(
        f"SELECT q.seq, q.machine_id, q.ts_us, q.status, {_event_id("'mqtt'", 'seen')} AS event_id, "
        "epoch_us(TIMESTAMP '2024-02-01 12:00:00') AS ingested_us, 'raw-1' AS pipeline_version, "
        "s.anomaly_score, s.anomaly_flags FROM landed q JOIN q_scores s USING (machine_id, seq)",
        BASE + "," + _mqtt_ctes() + ",\nlanded AS (SELECT *, arrival_seq AS seq FROM mq_good "
        "WHERE machine_id <> 'unknown'),\n" + scoring("landed", "q")),
    "normalize_mqtt": _with(
        f"SELECT arrival_seq, machine_id, plant_id, line_id, status, ts_us, {_event_id('\'mqtt\'', 'seen')} AS event_id, "
        f"{_M} FROM mq_good",
        BASE + "," + _mqtt_ctes()),
    "mqtt_rejects": _with(
        "SELECT eid AS arrival_seq, 'payload is not a JSON object' AS error FROM ev WHERE k % 8 IN (5, 6)",
        BASE),
    "normalize_modbus": _with(
        f"SELECT arrival_seq, machine_id, plant_id, line_id, status, ts_us, {_event_id('\'modbus\'', 'seen')} AS event_id, "
        f"{_M} FROM mb",
        BASE + "," + _modbus_ctes()),
    "normalize_opcua": _with(
        f"SELECT arrival_seq, machine_id, status, ts_us, {_event_id('\'opcua\'', 'seen')} AS event_id, {_M} FROM ua", BASE + "," + _opcua_ctes()),
    "normalize_union": _with(
        " UNION ALL ".join(
            f"SELECT '{protocol}' AS source_protocol, arrival_seq AS seq, machine_id, plant_id, line_id, status, ts_us, "
            f"{_event_id(f"'{protocol}'", 'seen')} AS event_id, {_M} FROM {table}"
            for protocol, table in (("mqtt", "mq_good"), ("modbus", "mb"), ("opcua", "ua"))),
        BASE + "," + _mqtt_ctes() + "," + _modbus_ctes() + "," + _opcua_ctes()),
    "points_round_trip": _with(
        f"SELECT event_id, machine_id, epoch_us(\"timestamp\") AS ts_us, {_M}, anomaly_score, "
        "plant_id || ' =,\"\\ ' AS plant_tag, status AS status_tag, "
        "CASE WHEN anomaly_flags = '' THEN 'none' ELSE anomaly_flags END AS flags_field, "
        "' =,\"\\ ' || pipeline_version AS version_field FROM store "
        "WHERE \"timestamp\" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 960 HOUR "
        "AND \"timestamp\" <= TIMESTAMP '2024-01-31 00:00:00'"),
    "fan_out": _with(
        "SELECT event_id, seq, CAST(floor(seq / (floor((SELECT max(seq) FROM live) / 3) + 1)) AS BIGINT) AS batch_id, "
        "CAST(1 AS BIGINT) AS wide_rows, CAST(1 AS BIGINT) AS points, CAST(1 AS BIGINT) AS log_lines FROM store"),
}
SQL["kept_machine_list"] = SQL["machine_list"]
SQL["kept_stats"] = SQL["pipeline_stats"]
SQL["replay_export"] = SQL["replay_window"]
