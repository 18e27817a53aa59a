"""Raw message sources (OP-01..03) and the device registry (OP-07).

Device protocol clients are not part of this package: messages are landed
by whatever bridge the plant runs (files, or a Kafka topic fed by an MQTT
bridge) and read here as tables or streams with fixed schemas -- no schema
inference, so a stream's schema never drifts.
"""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shopfloor import schema as S

SCHEMAS = {"mqtt": S.MQTT_RAW_SCHEMA, "modbus": S.MODBUS_RAW_SCHEMA, "opcua": S.OPCUA_RAW_SCHEMA}


def read_raw(spark: SparkSession, kind: str, path: str, fmt: str = "parquet",
             stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """OP-01..03: landed raw frames (``kind`` = mqtt | modbus | opcua) as a
    batch table or a file stream (one micro-batch per new file group)."""
    schema = SCHEMAS[kind]
    if stream:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.schema(schema).format(fmt).load(path)


def read_mqtt_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
                    max_offsets_per_trigger: int | None = None) -> DataFrame:
    """OP-01 from a Kafka topic fed by an MQTT bridge (key = MQTT topic,
    value = payload). Arrival order is per Kafka partition, so keying the
    Kafka topic by machine keeps each machine's order; ``arrival_seq`` packs
    (partition, offset). Needs the Kafka connector on the classpath."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(
        F.col("key").cast("string").alias("topic"),
        F.col("value").cast("string").alias("payload"),
        (F.shiftleft(F.col("partition").cast("long"), 40) + F.col("offset")).alias("arrival_seq"),
        F.col("timestamp").alias("arrived_at"))


def _yaml(text: str) -> dict | None:
    import yaml  # only registries in YAML need it; without it this raises
    return yaml.safe_load(text)


REGISTRY_FORMATS = {".json": json.loads, ".yaml": _yaml, ".yml": _yaml}


def _registry(spark: SparkSession, path: str | None) -> dict:
    """The registry's content by the file's suffix, from any store that Spark reads; nothing if there is no
    path or no file."""
    if not path:
        return {}
    suffix = posixpath.splitext(path)[1].lower()
    parse = REGISTRY_FORMATS.get(suffix)
    if parse is None:
        raise ValueError(f"registry {path}: one of {', '.join(REGISTRY_FORMATS)} expected")
    try:
        file = spark.read.text(path, wholetext=True).first()
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return (parse(file["value"]) if file else None) or {}


def load_registry(spark: SparkSession, path: str | None) -> tuple[DataFrame, dict | None]:
    """OP-07: registry file -> (device rows, MQTT source settings or None).

    The file is configuration (a handful of devices), read by Spark from
    wherever it is (a local path, ``file://``, ``s3://``) and parsed on the
    driver; missing path or file -> no devices. JSON or YAML by the
    suffix. Device defaults: port 502, unit 1, poll
    interval 1.0 s, no address list (= the default register set)."""
    payload = _registry(spark, path)
    rows = []
    for d in payload.get("modbus_devices", []) or []:
        rows.append((d["machine_id"], "modbus", d.get("host"), None, int(d.get("port", 502)),
                     int(d.get("unit_id", 1)), d.get("plant_id"), d.get("line_id"),
                     float(d.get("poll_interval", 1.0)),
                     [int(a) for a in d.get("register_addresses", []) or []], None))
    for d in payload.get("opcua_devices", []) or []:
        rows.append((d["machine_id"], "opcua", None, d.get("endpoint"), None, None,
                     d.get("plant_id"), d.get("line_id"), float(d.get("poll_interval", 1.0)),
                     None, {str(k): str(v) for k, v in (d.get("nodes") or {}).items()}))
    mqtt = payload.get("mqtt") or None
    return spark.createDataFrame(rows, S.REGISTRY_SCHEMA), mqtt
