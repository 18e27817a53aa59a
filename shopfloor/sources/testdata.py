"""Map the driver's tables to telemetry (used by the registered queries).

``events`` -> canonical readings (one reading per event, arrival seq from
``event_id``), plus at-least-once re-deliveries; ``lineitem`` -> Modbus
register blocks; ``supplier`` x ``nation`` x ``region`` -> device registry;
``events.props`` -> OPC-UA node lists and MQTT payload text.

All columns are derived with built-in expressions, so scans prune columns
and every derived frame grows with the source tables.

The mapping (kept identical in the DuckDB oracle SQL):

* machine ``'M-'||user_id``, plant ``'P-'||user_id%3``, line ``'L-'||user_id%7``
* protocol by ``event_id % 3``: 0 mqtt, 1 modbus, 2 opcua
* status by type: click running, view idle, purchase maintenance,
  signup ``'standby'`` (outside the domain -> unknown), error fault
* ``k`` = ``props.k``; the type's main metric is absent when ``k % 10 = 9``:
  click temperature=value, view vibration=value/100, purchase power_kw=value,
  signup rpm=value*20, error voltage_v=value+200;
  error also pressure=101.3 (constant: flatlines); humidity=k when ``k % 3 = 0``
* original arrival: ``seq = 2*event_id``; events with ``event_id % 10 = 0``
  are delivered again at ``seq = 2*event_id+1`` with version ``'redelivered'``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schema as S

TYPE_STATUS = {"click": "running", "view": "idle", "purchase": "maintenance",
               "signup": "standby", "error": "fault"}
REDELIVERY_MOD = 10
REDELIVERED_VERSION = "redelivered"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _protocol(n: Column) -> Column:
    return (F.when(n % 3 == 0, "mqtt").when(n % 3 == 1, "modbus").otherwise("opcua"))


def _status(raw: Column) -> Column:
    """OP-19: values outside the status domain become 'unknown'."""
    return F.when(raw.isin(*S.STATUSES), raw).otherwise(F.lit("unknown"))


def event_metrics(event_type: Column, value: Column, k: Column) -> Column:
    """Metric map of one event. Built as ``map_concat`` of conditional
    one-entry maps: no lambda, so the expression stays in generated code."""
    main = k % 10 != 9
    entries = [
        ("temperature", main & (event_type == "click"), value),
        ("vibration", main & (event_type == "view"), value / F.lit(100.0)),
        ("power_kw", main & (event_type == "purchase"), value),
        ("rpm", main & (event_type == "signup"), value * F.lit(20.0)),
        ("voltage_v", main & (event_type == "error"), value + F.lit(200.0)),
        ("pressure", event_type == "error", F.lit(101.3)),
        ("humidity", k % 3 == 0, k.cast("double")),
    ]
    empty = F.create_map().cast("map<string,double>")
    parts = [F.when(cond & v.isNotNull(), F.create_map(F.lit(name), v.cast("double"))).otherwise(empty)
             for name, cond, v in entries]
    return F.map_concat(*parts)


def event_readings(spark: SparkSession, sf_dir: str,
                   pipeline_version: str = S.DEFAULT_PIPELINE_VERSION) -> DataFrame:
    """Canonical readings from ``events`` (originals only, seq = 2*event_id)."""
    # props.k is parsed once (its own projection; the optimizer keeps a
    # non-trivial expression from being copied into every use).
    ev = table(spark, sf_dir, "events").select("*", _k().alias("_k"))
    k = F.col("_k")
    raw_status = F.col("event_type").cast("string")
    status_map = F.create_map(*[x for t, st in TYPE_STATUS.items() for x in (F.lit(t), F.lit(st))])
    return ev.select(
        F.concat(F.lit("M-"), F.col("user_id")).alias("machine_id"),
        F.concat(F.lit("P-"), F.col("user_id") % 3).alias("plant_id"),
        F.concat(F.lit("L-"), F.col("user_id") % 7).alias("line_id"),
        _protocol(F.col("event_id")).alias("source_protocol"),
        F.concat(F.lit("E-"), F.col("event_id")).alias("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        event_metrics(F.col("event_type"), F.col("value"), k).alias("metrics"),
        _status(status_map[raw_status]).alias("status"),
        F.col("props").alias("raw_payload"),
        F.lit(0.0).alias("anomaly_score"),
        F.array().cast("array<string>").alias("anomaly_flags"),
        F.lit(pipeline_version).alias("pipeline_version"),
        F.lit(S.DEFAULT_DETECTOR_VERSION).alias("detector_version"),
        (F.col("event_id") * 2).alias("seq"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals plus at-least-once re-deliveries (same event id, later seq)."""
    orig = event_readings(spark, sf_dir)
    again = (orig.filter(F.col("seq") % (2 * REDELIVERY_MOD) == 0)
             .withColumn("seq", F.col("seq") + 1)
             .withColumn("pipeline_version", F.lit(REDELIVERED_VERSION)))
    return orig.unionByName(again)


# --------------------------------------------------------------------------
# Raw protocol frames built from the tables
# --------------------------------------------------------------------------

def mqtt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw MQTT messages ``(topic, payload, arrival_seq, arrived_at)``.

    Payload keys vary by event so the normalizer's rules are exercised:
    aliases and upper-case keys, alias collisions (later key wins), numeric
    strings (ignored), booleans (1.0), unknown keys, ``ts`` vs ISO
    ``timestamp``, bad JSON, JSON arrays and short topics.
    """
    ev = table(spark, sf_dir, "events")
    k = _k()
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    v = F.col("value").cast("string")
    kind = k % 8
    body = (
        F.when(kind == 0, F.concat(F.lit('{"ts":'), epoch.cast("string"), F.lit(',"temp":'), v,
                                   F.lit(',"status":"running"}')))
        .when(kind == 1, F.concat(F.lit('{"timestamp":"'), iso, F.lit('","TEMP":'), v,
                                  F.lit(',"vib":0.5,"status":"IDLE"}')))
        .when(kind == 2, F.concat(F.lit('{"ts":'), epoch.cast("string"), F.lit(',"temperature":1.0,"temp":'),
                                  v, F.lit(',"rpm":"1450","status":"mystery"}')))
        .when(kind == 3, F.concat(F.lit('{"ts":0,"timestamp":"'), iso, F.lit('","pwr":'), v,
                                  F.lit(',"flow":true,"extra_key":7}')))
        .when(kind == 4, F.concat(F.lit('{"ts":'), epoch.cast("string"), F.lit(',"speed":'), v,
                                  F.lit(',"hum":'), k.cast("string"), F.lit(',"status":"fault"}')))
        .when(kind == 5, F.lit("not-json"))
        .when(kind == 6, F.concat(F.lit("["), v, F.lit("]")))
        .otherwise(F.concat(F.lit('{"ts":'), epoch.cast("string"), F.lit(',"Voltage":'), v,
                            F.lit(',"current_a":false,"status":"maintenance"}')))
    )
    topic = (F.when(F.col("user_id") % 11 == 0, F.concat(F.lit("factory/P"), F.col("user_id") % 3))
             .otherwise(F.concat(F.lit("/factory/P"), F.col("user_id") % 3, F.lit("/L"),
                                 F.col("user_id") % 7, F.lit("/M-"), F.col("user_id"),
                                 F.lit("/telemetry/"))))
    return ev.select(topic.alias("topic"), body.alias("payload"),
                     F.col("event_id").alias("arrival_seq"),
                     F.col("ts").cast("timestamp").alias("arrived_at"))


def modbus_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw Modbus polls from ``lineitem``: one 10-register block per line.

    Block from 40001: quantity, discount*1000, partkey % 10000, tax*1000,
    extendedprice (int), 0, 0, 0, 0, status code = linenumber % 5 (4 is
    outside the code map). Machine ``'S-'||l_suppkey``; polls whose
    ``l_orderkey % 50 = 0`` report a read error.
    """
    li = table(spark, sf_dir, "lineitem")
    # Explicit floor: integer casts truncate in some engines and round in others.
    fl = lambda c: F.floor(c).cast("int")
    regs = F.array(
        fl(F.col("l_quantity")),
        fl(F.col("l_discount") * 1000 + 0.5),
        (F.col("l_partkey") % 10000).cast("int"),
        fl(F.col("l_tax") * 1000 + 0.5),
        fl(F.col("l_extendedprice")),
        F.lit(0), F.lit(0), F.lit(0), F.lit(0),
        (F.col("l_linenumber") % 5).cast("int"),
    )
    return li.select(
        F.concat(F.lit("S-"), F.col("l_suppkey")).alias("machine_id"),
        F.lit(1).alias("unit_id"),
        F.lit(S.MODBUS_BASE_ADDRESS).alias("start_address"),
        regs.alias("registers"),
        (F.col("l_orderkey") % 50 == 0).alias("is_error"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival_seq"),
        F.col("l_shipdate").cast("timestamp").alias("arrived_at"),
    )


def device_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows from supplier x nation x region: plant = region, line = nation.

    Suppliers with ``s_suppkey % 4 = 0`` list only four registers
    (40001, 40002, 40003, 40010); the rest use the default address list.
    """
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    dim = (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
           .join(reg, nat.n_regionkey == reg.r_regionkey))
    addrs = F.when(F.col("s_suppkey") % 4 == 0, F.array(*[F.lit(a) for a in (40001, 40002, 40003, 40010)])) \
             .otherwise(F.lit(None).cast("array<int>"))
    return dim.select(
        F.concat(F.lit("S-"), F.col("s_suppkey")).alias("machine_id"),
        F.lit("modbus").alias("protocol"),
        F.col("s_name").alias("host"),
        F.lit(None).cast("string").alias("endpoint"),
        F.lit(502).alias("port"),
        F.lit(1).alias("unit_id"),
        F.col("r_name").alias("plant_id"),
        F.col("n_name").alias("line_id"),
        F.lit(1.0).alias("poll_interval"),
        addrs.alias("register_addresses"),
        F.lit(None).cast("map<string,string>").alias("nodes"),
    )


def opcua_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw OPC-UA polls from ``events``: node list built from type, value, k.

    Nodes in order: 'Temperature' (value), 'Spindle Speed' (k*10),
    'Machine Status' (status text), 'Power' (value/10, quality Bad when
    k % 4 = 0), 'Temperature' again (k, quality missing) when k % 5 = 0 (later
    node wins), 'PowerKW' (unmapped name).
    """
    ev = table(spark, sf_dir, "events")
    k = _k()
    node = lambda nid, name, val, st: F.struct(F.lit(nid).alias("node_id"), F.lit(name).alias("name"),
                                                val.alias("value"), st.alias("status"))
    status_text = F.when(F.col("event_type") == "error", F.lit('"Fault"')) \
                   .when(F.col("event_type") == "view", F.lit('"idle"')) \
                   .otherwise(F.lit('"running"'))
    good = F.lit("Good")
    nodes = F.array_compact(F.array(
        node("ns=2;i=1001", "Temperature", F.col("value").cast("string"), good),
        node("ns=2;i=1002", "Spindle Speed", (k * 10).cast("string"), good),
        node("ns=2;i=1003", "Machine Status", status_text, good),
        node("ns=2;i=1004", "Power", (F.col("value") / F.lit(10.0)).cast("string"),
             F.when(k % 4 == 0, F.lit("Bad")).otherwise(good)),
        F.when(k % 5 == 0, node("ns=2;i=1005", "Temperature", k.cast("string"),
                                F.lit(None).cast("string"))),
        node("ns=2;i=1006", "PowerKW", F.lit("1.5"), good),
    ))
    return ev.select(
        F.concat(F.lit("O-"), F.col("user_id") % 40).alias("machine_id"),
        nodes.alias("nodes"),
        F.col("event_id").alias("arrival_seq"),
        F.col("ts").cast("timestamp").alias("arrived_at"),
    )
