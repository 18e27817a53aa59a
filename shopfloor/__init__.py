"""shopfloor: Spark-native factory telemetry analytics.

Raw machine messages (MQTT JSON, Modbus register blocks, OPC-UA node lists)
become one canonical reading schema, get scored with row-framed rolling
statistics per machine and metric, are de-duplicated by event id, written to
partitioned tables / point files / JSONL logs, and answer the operational
query set. Every operator is a ``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"
