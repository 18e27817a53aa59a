"""Event ids: sha256 of the text that Python's json.dumps gives, made without Python."""

import datetime as dt
import hashlib
import json
import random
import struct

from pyspark.sql import functions as F

from shopfloor.functions.eventid import event_id
from shopfloor.functions.pyjson import float_text, floats_text, string_text

UTC = dt.timezone.utc
ROWS = [
    ("CNC-001", "plant-A", "line-1", "mqtt", dt.datetime(2024, 3, 8, 12, 13, 20, tzinfo=UTC),
     {"temperature": 72.4, "rpm": 1450.0, "vibration": 0.03}, "running"),
    ("M1", None, None, "modbus", dt.datetime(2024, 3, 8, 12, 13, 20, 5, tzinfo=UTC), {}, "idle"),
    ('we"ird\\id', "p", None, "opcua", dt.datetime(2024, 1, 1, tzinfo=UTC),
     {"flow_rate": 1e-05, "humidity": 1e16, "x": -0.0, "y": 0.0003}, "unknown"),
    ("Måskin-é", "p", "l", "mqtt", dt.datetime(2024, 1, 1, tzinfo=UTC), {"temp": 5e-324}, "fault"),
]
SCHEMA = ("machine_id string, plant_id string, line_id string, source_protocol string, "
          "timestamp timestamp, metrics map<string,double>, status string")


def python_id(r):
    payload = {"machine_id": r[0], "plant_id": r[1], "line_id": r[2], "source_protocol": r[3],
               "timestamp": r[4].isoformat(), "metrics": r[5], "status": r[6]}
    text = json.dumps(payload, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def test_exact_event_id_matches_python(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [r.id for r in df.select(event_id().alias("id")).collect()]
    assert got == [python_id(r) for r in ROWS]


def test_floats_are_python_s(spark):
    rng = random.Random(4)
    xs = [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(60_000)]
    xs += [rng.choice([-1, 1]) * rng.randrange(10**rng.randint(1, 17)) * 10.0**rng.randint(-30, 30) for _ in range(40_000)]
    xs += [rng.randrange(1, 1 << rng.randint(1, 52)) * 5e-324 for _ in range(5_000)]  # subnormal
    xs += [round(rng.random() * 10**rng.randint(-6, 9), rng.randint(0, 9)) for _ in range(40_000)]
    xs += [0.0, -0.0, 1e16, 1e15, 9999999999999998.0, 1e-4, 1e-5, 9.999e-5, 5e-324, 1.7976931348623157e308, 2.0**53, 1e22, 1e23,
           float("inf"), float("-inf"), 123456789012345680.0, 0.1, 100.0, 1e7, 12345678.9]
    xs = [x for x in xs if x == x]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", float_text(F.col("x")).alias("t")).collect()
    assert [(r["x"], r["t"]) for r in got if r["t"] != json.dumps(r["x"])] == []


def test_strings_are_python_s(spark):
    rng = random.Random(6)
    xs = ["", '"', "\\", "a\"b", "\x00\x1f\x7f\x80", "\b\t\n\f\r/", "Måskin-é", "\U0001f642 x", "\ufeff\uffff", "plain ~"]
    xs += ["".join(chr(rng.choice([rng.randrange(128), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]))
                   for _ in range(rng.randint(0, 12))) for _ in range(3_000)]
    got = spark.createDataFrame([(x,) for x in [*xs, None]], "x string").select("x", string_text(F.col("x")).alias("t")).collect()
    assert [(r["x"], r["t"]) for r in got if r["t"] != json.dumps(r["x"])] == []


def test_one_id_on_every_path(spark):
    """A reading posted by hand without an id, one of the store and a normalized one have the same id."""
    from shopfloor.operators.dedup import first_arrivals, manual_ingest
    from shopfloor.operators.normalize import normalize_mqtt
    seen = dt.datetime(2024, 3, 8, 12, 13, 20, tzinfo=UTC)
    payload = json.dumps({"ts": seen.isoformat(), "vib": 0.0003, "temp": 1e16, "status": "running"})
    message = spark.createDataFrame([("factory/p/l/m/telemetry", payload, 1, seen)],
                                    "topic string, payload string, arrival_seq long, arrived_at timestamp")
    normalized = normalize_mqtt(message)
    assert "Python" not in normalized._jdf.queryExecution().executedPlan().toString()
    known = normalized.first()
    for empty in ("", None):
        posted = normalized.drop("arrival_seq", "error").withColumns(
            {"event_id": F.lit(empty).cast("string"), "seq": F.lit(9).cast("long")})
        assert manual_ingest(posted).first()["event_id"] == known["event_id"]
        both = normalized.drop("arrival_seq", "error").unionByName(posted)
        assert [r["seq"] for r in first_arrivals(both).collect()] == [1]
    assert known["event_id"] == python_id(("m", "p", "l", "mqtt", seen, {"vibration": 0.0003, "temperature": 1e16}, "running"))


def test_objects_of_floats_by_either_way(spark):
    """The built-in writer's texts are Python's, and only what it can't be trusted with goes entry by entry."""
    rnd = random.Random(5)
    names = ["temperature", "vibration", "rpm", "power_kw"]
    odd = [0.1 * 17, 2.0 ** -44, 9999999.999999998, 1e7, 1e-3, 9e-4, -0.0, 1e23, 2e-3, 0.30000000000000004, 9.100000000000001,
           float("inf"), float("-inf"), float("nan"), 1234567.1234567891, 5e-324, -1.7000000000000002]
    values = odd + [struct.unpack(">d", rnd.randbytes(8))[0] for _ in range(300)]
    values += [rnd.randint(1, 10 ** 6) * s for s in (0.1, 0.01, 0.001) for _ in range(700)]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-4, 8) for _ in range(3000)]
    maps = [{n: rnd.choice(values) for n in rnd.sample(names, rnd.randint(1, 4))} for _ in range(8000)]
    maps += [{"rpm": v} for v in values] + [{}, None, {"rpm": None, "power_kw": 0.5}, {"Z own": 1.5, "rpm": 2.0}, {'q"': 0.1 * 3}]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, m map<string,double>")
    got = {r.i: r.t for r in df.select("i", floats_text(F.col("m"), names).alias("t")).collect()}

    def wanted(m):
        text = {k: v for k, v in (m or {}).items() if v is not None}
        return json.dumps(text, sort_keys=True, separators=(",", ":"))
    assert got == {i: wanted(m) for i, m in enumerate(maps)}


def test_maps_that_repeat_a_key_keep_both_entries(spark):
    twice = F.expr("map_from_arrays(array('rpm', 'temperature'), array(1.5D, 2.5D))")
    held = spark.range(1).select(twice.alias("m"))
    assert held.select(floats_text(F.col("m"), ["temperature", "rpm"])).first()[0] == '{"rpm":1.5,"temperature":2.5}'
