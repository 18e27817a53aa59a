"""Normalizer expectations (reference unit tests) and quirk rules."""

import datetime as dt

import pytest

from shopfloor import schema as S
from shopfloor.functions.topic import filter_regex
from shopfloor.operators import normalize as N

T0 = dt.datetime(2024, 3, 8, 12, 0, 0, tzinfo=dt.timezone.utc)


def mqtt(spark, rows):
    data = [(t, p, i, T0) for i, (t, p) in enumerate(rows)]
    df = spark.createDataFrame(data, S.MQTT_RAW_SCHEMA)
    return {r.arrival_seq: r for r in N.normalize_mqtt(df).collect()}


def test_mqtt_golden(spark):
    r = mqtt(spark, [("factory/plant-A/line-1/CNC-001/telemetry",
                      '{"ts":1709900000,"temp":72.4,"vib":0.03,"rpm":1450,"status":"running"}')])[0]
    assert r.error is None
    assert (r.machine_id, r.plant_id, r.line_id) == ("CNC-001", "plant-A", "line-1")
    assert r.source_protocol == "mqtt"
    assert r.metrics == {"temperature": 72.4, "vibration": 0.03, "rpm": 1450.0}
    assert r.status == "running"
    assert r.timestamp == dt.datetime.fromtimestamp(1709900000, dt.timezone.utc).replace(tzinfo=None) \
        or r.timestamp.timestamp() == 1709900000
    assert len(r.event_id) == 64


def test_mqtt_unknown_status_bytes_and_bad_json(spark):
    r = mqtt(spark, [("factory/p/l/M1/telemetry", '{"temp":50,"status":"mystery_mode"}'),
                     ("factory/p/l/M1/telemetry", '{"temp": 60.0}'),
                     ("factory/p/l/M1/telemetry", "not-json"),
                     ("factory/p/l/M1/telemetry", "[1,2]")])
    assert r[0].status == "unknown" and r[0].metrics == {"temperature": 50.0}
    assert r[1].metrics == {"temperature": 60.0} and r[1].status == "unknown"
    assert r[2].error == N.ERR_NOT_OBJECT and r[3].error == N.ERR_NOT_OBJECT


def test_mqtt_quirks(spark):
    rows = [
        ("f/p/l/M/t", '{"temp":1.0,"temperature":2.0}'),      # later alias wins
        ("f/p/l/M/t", '{"temperature":2.0,"temp":1.0}'),      # ... in both orders
        ("f/p/l/M/t", '{"flow":true,"current":false}'),         # booleans -> 1.0 / 0.0
        ("f/p/l/M/t", '{"rpm":"1450","pres":null}'),            # numeric string, null ignored
        ("f/p/l/M/t", '{"TEMP":3.5,"Status":"running"}'),      # key lower-cased; status exact key
        ("f/p/l/M/t", '{"temp":1,"temp":9}'),                   # repeated key: last value
        ("f/p/l/M/t", '{"ts":0,"timestamp":"2024-03-08T10:00:00+02:00","temp":1}'),
        ("f/p/l/M/t", '{"temp":1}'),                            # no ts -> arrival time
        ("f/p/l/M/t", '{"ts":1709900000000000,"temp":1}'),     # past year 9999 -> rejected
        ("f/p/l/M/t", '{"timestamp":"2024030","temp":1}'),     # not ISO -> rejected
        ("short", '{"temp":1}'),                                 # short topic
        ("/factory/a/b/c/telemetry/", '{"status":"IDLE","unknown_key":5}'),
        ("f/p/l/M/t", '{"timestamp":"20240308T090000+0100","temp":1}'),  # basic ISO form, as Python reads it
    ]
    r = mqtt(spark, rows)
    assert r[0].metrics == {"temperature": 2.0}
    assert r[1].metrics == {"temperature": 1.0}
    assert r[2].metrics == {"flow_rate": 1.0, "current_a": 0.0}
    assert r[3].metrics == {}
    assert r[4].metrics == {"temperature": 3.5} and r[4].status == "unknown"
    assert r[5].metrics == {"temperature": 9.0}
    assert r[6].timestamp.replace(tzinfo=None) == dt.datetime(2024, 3, 8, 8, 0, 0)
    assert r[7].timestamp.replace(tzinfo=None) == T0.replace(tzinfo=None)
    assert r[8].error == N.ERR_TIMESTAMP
    assert r[9].error == N.ERR_TIMESTAMP
    assert (r[10].machine_id, r[10].plant_id, r[10].line_id) == ("unknown", None, None)
    assert (r[11].machine_id, r[11].plant_id, r[11].status) == ("c", "a", "idle")
    assert r[11].raw_payload == '{"status":"IDLE","unknown_key":5}'
    assert r[12].error is None and r[12].timestamp.replace(tzinfo=None) == dt.datetime(2024, 3, 8, 8, 0, 0)


def test_same_message_same_event_id(spark):
    p = '{"ts":1709900000,"temp":72.4,"status":"running"}'
    r = mqtt(spark, [("f/p/l/M/t", p), ("f/p/l/M/t", p), ("f/p/l/M/t", p.replace("72.4", "72.5"))])
    assert r[0].event_id == r[1].event_id != r[2].event_id


@pytest.mark.parametrize("flt,topic,ok", [
    ("factory/+/+/+/telemetry", "factory/p/l/m/telemetry", True),
    ("factory/+/+/+/telemetry", "factory/p/l/telemetry", False),
    ("factory/+/+/+/telemetry", "factory/p/l/m/x/telemetry", False),
    ("factory/#", "factory/a/b", True),
    ("factory/#", "factory", True),
    ("factory/#", "other/a", False),
])
def test_topic_filter(flt, topic, ok):
    import re
    assert bool(re.match(filter_regex(flt), topic)) is ok


def modbus(spark, rows, registry=None):
    df = spark.createDataFrame(rows, S.MODBUS_RAW_SCHEMA)
    if registry is not None:
        df = N.attach_registry(df, spark.createDataFrame(registry, S.REGISTRY_SCHEMA))
    return [r for r in N.normalize_modbus(df).orderBy("arrival_seq").collect()]


def test_modbus_register_conversion(spark):
    # registers {40001:724, 40002:30, 40003:1450, 40010:1} as a sparse block
    block = [724, 30, 1450, 0, 0, 0, 0, 0, 0, 1]
    reg = [("PRESS-001", "modbus", "h", None, 502, 1, "plant-A", "line-2", 1.0,
            [40001, 40002, 40003, 40010], None)]
    r = modbus(spark, [("PRESS-001", 1, 40001, block, False, 1, T0)], reg)[0]
    assert r.source_protocol == "modbus"
    assert r.metrics["temperature"] == pytest.approx(72.4)
    assert r.metrics["vibration"] == pytest.approx(0.03)
    assert r.metrics["rpm"] == 1450.0
    assert set(r.metrics) == {"temperature", "vibration", "rpm"}   # only configured addresses
    assert r.status == "running" and r.plant_id == "plant-A"


def test_modbus_status_codes_and_errors(spark):
    rows = [("M1", 1, 40010, [2], False, 1, T0),     # fault
            ("M1", 1, 40001, [700], False, 2, T0),   # status register missing -> idle
            ("M1", 1, 40010, [9], False, 3, T0),     # unmapped code -> unknown
            ("M1", 1, 40001, [700], True, 4, T0)]    # error poll -> no reading
    reg = [("M1", "modbus", "h", None, 502, 1, None, None, 1.0, [], None)]
    r = modbus(spark, rows, reg)
    assert [x.status for x in r] == ["fault", "idle", "unknown"]


def test_modbus_unregistered_device_dropped(spark):
    reg = [("OTHER", "modbus", "h", None, 502, 1, None, None, 1.0, None, None)]
    assert modbus(spark, [("M1", 1, 40001, [700], False, 1, T0)], reg) == []


def opcua(spark, nodes_rows):
    data = [(f"M{i}", nodes, i, T0) for i, nodes in enumerate(nodes_rows)]
    df = spark.createDataFrame(data, S.OPCUA_RAW_SCHEMA)
    return {r.arrival_seq: r for r in N.normalize_opcua(df).collect()}


def test_opcua_nodes(spark):
    good = [("ns=2;i=1001", "Temperature", "72.4", "Good"), ("ns=2;i=1002", "RPM", "1450", "Good"),
            ("ns=2;i=1003", "Vibration", "0.03", "Good")]
    bad = [("ns=2;i=1001", "Temperature", "999.9", "Bad")]
    status = [("s", "Machine Status", '"running"', None), ("t", "Spindle Speed", "true", None),
              ("u", "PowerKW", "3.2", "Good"), ("v", "Temperature", '"hot"', "Good")]
    r = opcua(spark, [good, bad, status])
    assert r[0].metrics == {"temperature": 72.4, "rpm": 1450.0, "vibration": 0.03}
    assert r[1].metrics == {} and r[1].status == "unknown"
    assert r[2].status == "running" and r[2].metrics == {"rpm": 1.0}


def test_union_protocols(spark):
    m = N.split_errors(N.normalize_mqtt(spark.createDataFrame(
        [("f/p/l/M/t", '{"temp":1}', 1, T0)], S.MQTT_RAW_SCHEMA)))[0]
    o = N.normalize_opcua(spark.createDataFrame([("O", [("a", "Temp", "2", None)], 2, T0)],
                                                S.OPCUA_RAW_SCHEMA))
    u = N.union_protocols(m, o)
    assert sorted(r.source_protocol for r in u.collect()) == ["mqtt", "opcua"]
    assert u.columns == list(S.READING_COLUMNS)


def test_decode_registers_keeps_configured_addresses(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(40001, [724, 30, 1450, 0, 0, 0, 0, 0, 0, 1])],
                               "start int, regs array<int>")
    addrs = F.array(*[F.lit(a) for a in (40001, 40002, 40003, 40010)])
    m = df.select(N.decode_registers(F.col("start"), F.col("regs"), addrs).alias("m")).first().m
    assert m == {40001: 724, 40002: 30, 40003: 1450, 40010: 1}
