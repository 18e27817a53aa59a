"""Canonical reading schema, domains and the fixed lookup values.

The values under "FIXED VALUES" must equal the behaviour being matched
(alias names, register addresses and scales, node names, status codes,
detector limits); they are stated plainly and in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour exactly)
# --------------------------------------------------------------------------

PROTOCOLS = ("mqtt", "modbus", "opcua")
STATUSES = ("running", "idle", "fault", "maintenance", "unknown")
FLAGS = ("SPIKE", "DRIFT", "FLATLINE", "OUT_OF_RANGE")

# The nine named metrics of the wide (SQL-store) row shape, in column order.
METRIC_COLUMNS = ("temperature", "vibration", "rpm", "pressure", "power_kw",
                  "current_a", "voltage_v", "humidity", "flow_rate")

# MQTT payload key (lower-cased) -> canonical metric name.
MQTT_ALIASES = {
    "temp": "temperature",
    "temperature": "temperature",
    "vib": "vibration",
    "vibration": "vibration",
    "rpm": "rpm",
    "speed": "rpm",
    "pres": "pressure",
    "pressure": "pressure",
    "pwr": "power_kw",
    "power": "power_kw",
    "power_kw": "power_kw",
    "current": "current_a",
    "current_a": "current_a",
    "voltage": "voltage_v",
    "voltage_v": "voltage_v",
    "humidity": "humidity",
    "hum": "humidity",
    "flow": "flow_rate",
    "flow_rate": "flow_rate",
}

# Modbus holding register -> (metric, scale).
MODBUS_REGISTERS = {
    40001: ("temperature", 0.1),
    40002: ("vibration", 0.001),
    40003: ("rpm", 1.0),
    40004: ("pressure", 0.1),
    40005: ("power_kw", 0.01),
    40006: ("current_a", 0.01),
    40007: ("voltage_v", 0.1),
}
MODBUS_STATUS_REGISTER = 40010
# Modbus status code -> status; a missing status register reads as code 0.
MODBUS_STATUS_CODES = {0: "idle", 1: "running", 2: "fault", 3: "maintenance"}
# Register 40001 is read at offset 0 of the holding-register space.
MODBUS_BASE_ADDRESS = 40001

# OPC-UA node name (lower-cased, spaces -> '_') -> canonical metric name.
OPCUA_NODE_NAMES = {
    "temperature": "temperature",
    "temp": "temperature",
    "vibration": "vibration",
    "vib": "vibration",
    "spindle_speed": "rpm",
    "rpm": "rpm",
    "pressure": "pressure",
    "power": "power_kw",
    "active_power": "power_kw",
    "current": "current_a",
    "voltage": "voltage_v",
    "humidity": "humidity",
    "flow_rate": "flow_rate",
}
OPCUA_STATUS_NODE = "machine_status"
OPCUA_GOOD_QUALITY = "Good"

# MQTT topic filter of the live source.
DEFAULT_TOPIC_FILTER = "factory/+/+/+/telemetry"

# Version stamps.
DEFAULT_PIPELINE_VERSION = "phase3-runtime-v1"
DEFAULT_DETECTOR_VERSION = "rules-v1"
MANUAL_INGEST_PIPELINE_VERSION = "manual-ingest"
REPLAY_DETECTOR_VERSION = "rules-replay-v1"
REPLAY_PIPELINE_VERSION = "replay-v1"

# Point-store measurement name and the tag value used for a missing plant/line.
POINT_MEASUREMENT = "machine_readings"
POINT_MISSING_TAG = "unknown"
POINT_NO_FLAGS = "none"

# Detector defaults.
DEFAULT_WINDOW = 60          # rolling values kept per (machine, metric)
ZSCORE_MIN_VALUES = 10       # no z-score before this many prior values
ZERO_STD = 1e-9              # below this std the z-score is |v - mean|
OUT_OF_RANGE_LOW_SCORE = 0.8
OUT_OF_RANGE_HIGH_SCORE = 0.9
FLATLINE_SCORE = 0.4
SPIKE_FACTOR = 1.5           # spike when z > 1.5 * threshold
SPIKE_SCALE = 3.0            # spike score = min(1, z / (3 * threshold))
DRIFT_SCALE = 2.0            # drift score = min(0.7, z / (2 * threshold))
DRIFT_CAP = 0.7
SCORE_DIGITS = 4
ANOMALY_THRESHOLD = 0.5

# Query defaults.
RETENTION_PER_MACHINE = 500
RETENTION_ANOMALIES = 1000
DEFAULT_QUERY_LIMIT = 50
TAIL_PAGE = 100
SQL_RECENT_LIMIT = 100
SQL_ANOMALY_LIMIT = 500


@dataclass(frozen=True)
class MetricConfig:
    """Per-metric detector limits (None = no range check)."""

    min_value: float | None = None
    max_value: float | None = None
    zscore_threshold: float = 3.0
    flatline_tolerance: float = 0.0001
    flatline_window: int = 10


DEFAULT_METRIC_CONFIG = MetricConfig()

DEFAULT_METRIC_CONFIGS = {
    "temperature": MetricConfig(min_value=0, max_value=200, zscore_threshold=3.0),
    "vibration": MetricConfig(min_value=0, max_value=5.0, zscore_threshold=3.5),
    "rpm": MetricConfig(min_value=0, max_value=10000, zscore_threshold=3.0),
    "pressure": MetricConfig(min_value=0, max_value=500, zscore_threshold=3.0),
    "power_kw": MetricConfig(min_value=0, max_value=100, zscore_threshold=3.0),
    "current_a": MetricConfig(min_value=0, max_value=200, zscore_threshold=3.0),
    "voltage_v": MetricConfig(min_value=200, max_value=500, zscore_threshold=2.5),
}

# --------------------------------------------------------------------------
# Spark schemas
# --------------------------------------------------------------------------

METRICS_TYPE = T.MapType(T.StringType(), T.DoubleType(), True)

READING_SCHEMA = T.StructType([
    T.StructField("machine_id", T.StringType(), False),
    T.StructField("plant_id", T.StringType(), True),
    T.StructField("line_id", T.StringType(), True),
    T.StructField("source_protocol", T.StringType(), False),
    T.StructField("event_id", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
    T.StructField("metrics", METRICS_TYPE, True),
    T.StructField("status", T.StringType(), True),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("anomaly_score", T.DoubleType(), True),
    T.StructField("anomaly_flags", T.ArrayType(T.StringType()), True),
    T.StructField("pipeline_version", T.StringType(), True),
    T.StructField("detector_version", T.StringType(), True),
    T.StructField("seq", T.LongType(), True),
])

READING_COLUMNS = tuple(f.name for f in READING_SCHEMA.fields)

# Schema of one JSONL event-log line (keys sorted as written; seq is ours and
# optional, older logs have none and get it from file position).
EVENT_LOG_SCHEMA = T.StructType(sorted(READING_SCHEMA.fields, key=lambda f: f.name))

MQTT_RAW_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("payload", T.StringType(), True),
    T.StructField("arrival_seq", T.LongType(), True),
    T.StructField("arrived_at", T.TimestampType(), True),
])

MODBUS_RAW_SCHEMA = T.StructType([
    T.StructField("machine_id", T.StringType(), True),
    T.StructField("unit_id", T.IntegerType(), True),
    T.StructField("start_address", T.IntegerType(), True),
    T.StructField("registers", T.ArrayType(T.IntegerType()), True),
    T.StructField("is_error", T.BooleanType(), True),
    T.StructField("arrival_seq", T.LongType(), True),
    T.StructField("arrived_at", T.TimestampType(), True),
])

OPCUA_NODE_TYPE = T.StructType([
    T.StructField("node_id", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("value", T.StringType(), True),   # JSON text of the value
    T.StructField("status", T.StringType(), True),
])

OPCUA_RAW_SCHEMA = T.StructType([
    T.StructField("machine_id", T.StringType(), True),
    T.StructField("nodes", T.ArrayType(OPCUA_NODE_TYPE), True),
    T.StructField("arrival_seq", T.LongType(), True),
    T.StructField("arrived_at", T.TimestampType(), True),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("machine_id", T.StringType(), False),
    T.StructField("protocol", T.StringType(), True),
    T.StructField("host", T.StringType(), True),
    T.StructField("endpoint", T.StringType(), True),
    T.StructField("port", T.IntegerType(), True),
    T.StructField("unit_id", T.IntegerType(), True),
    T.StructField("plant_id", T.StringType(), True),
    T.StructField("line_id", T.StringType(), True),
    T.StructField("poll_interval", T.DoubleType(), True),
    T.StructField("register_addresses", T.ArrayType(T.IntegerType()), True),
    T.StructField("nodes", T.MapType(T.StringType(), T.StringType()), True),
])

METRIC_CONFIG_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), False),
    T.StructField("min_value", T.DoubleType(), True),
    T.StructField("max_value", T.DoubleType(), True),
    T.StructField("zscore_threshold", T.DoubleType(), False),
    T.StructField("flatline_tolerance", T.DoubleType(), False),
    T.StructField("flatline_window", T.IntegerType(), False),
])


def default_modbus_addresses() -> list[int]:
    """Registers polled when a device lists none: the mapped ones + status."""
    return list(MODBUS_REGISTERS) + [MODBUS_STATUS_REGISTER]
