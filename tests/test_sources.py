import json

from shopfloor import schema as S
from shopfloor.sources import raw

YAML = """
mqtt:
  enabled: true
  broker_host: broker
  broker_port: 1883
modbus_devices:
  - machine_id: MODBUS-001
    host: modbus
    port: 502
opcua_devices:
  - machine_id: OPCUA-001
    endpoint: opc.tcp://opcua:4840/factory/
    nodes:
      Temperature: ns=2;i=1001
"""


def test_registry_yaml(spark, tmp_path):
    p = tmp_path / "registry.yaml"
    p.write_text(YAML)
    devices, mqtt = raw.load_registry(spark, str(p))
    assert mqtt["broker_host"] == "broker"
    rows = {r.machine_id: r for r in devices.collect()}
    assert rows["MODBUS-001"].protocol == "modbus" and rows["MODBUS-001"].unit_id == 1
    assert rows["MODBUS-001"].register_addresses == []
    assert rows["OPCUA-001"].nodes == {"Temperature": "ns=2;i=1001"}


def test_registry_json_and_missing(spark, tmp_path):
    p = tmp_path / "registry.json"
    p.write_text(json.dumps({"modbus_devices": [{"machine_id": "M", "host": "h",
                                                  "register_addresses": [40001, 40010]}]}))
    devices, mqtt = raw.load_registry(spark, str(p))
    assert mqtt is None and devices.first().register_addresses == [40001, 40010]
    empty, none = raw.load_registry(spark, str(tmp_path / "nope.yaml"))
    assert empty.count() == 0 and none is None


def test_read_raw_batch_and_stream(spark, tmp_path):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([("factory/p/l/m/telemetry", '{"temp":1}', 1, t)], S.MQTT_RAW_SCHEMA)
    df.write.parquet(str(tmp_path / "mq"))
    assert raw.read_raw(spark, "mqtt", str(tmp_path / "mq")).count() == 1
    st = raw.read_raw(spark, "mqtt", str(tmp_path / "mq"), stream=True, max_files_per_trigger=1)
    assert st.isStreaming and st.schema == S.MQTT_RAW_SCHEMA
