"""Raw protocol frames -> canonical readings (OP-06, 07, 09, 10a-c, 12, 15, 19).

All rules are built-in expressions (JSON to ``map<string,variant>``, higher-
order functions over arrays); no Python runs per row. Rows that cannot be
normalized keep an ``error`` text instead of vanishing (dead letter, OP-15);
:func:`split_errors` separates them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.functions import jsonval as J
from shopfloor.functions.eventid import event_id
from shopfloor.functions.timefmt import MAX_EPOCH_SECONDS, parse_iso
from shopfloor.functions.topic import topic_matches, topic_parts

ERR_NOT_OBJECT = "payload is not a JSON object"
ERR_TIMESTAMP = "bad timestamp"
ERR_NON_FINITE = "non-finite metric value"


def _lit_map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def status_domain(text: Column) -> Column:
    """OP-19: lower-cased text in the status domain, else 'unknown'."""
    low = F.lower(text)
    return F.when(low.isin(*S.STATUSES), low).otherwise(F.lit("unknown"))


def _finite(metrics: Column) -> Column:
    return F.forall(F.map_values(metrics), lambda v: ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))


def _reading(machine_id, plant_id, line_id, protocol, timestamp, metrics, status, raw,
             seq, arrived_at) -> list[Column]:
    cols = {
        "machine_id": machine_id, "plant_id": plant_id, "line_id": line_id,
        "source_protocol": F.lit(protocol), "timestamp": timestamp,
        "ingested_at": arrived_at, "metrics": metrics, "status": status,
        "raw_payload": raw,
    }
    out = [c.alias(n) for n, c in cols.items()]
    eid = event_id(machine_id, plant_id, line_id, F.lit(protocol), timestamp, metrics, status)
    return out + [eid.alias("event_id"), F.lit(0.0).alias("anomaly_score"),
                  F.array().cast("array<string>").alias("anomaly_flags"),
                  F.lit(S.DEFAULT_PIPELINE_VERSION).alias("pipeline_version"),
                  F.lit(S.DEFAULT_DETECTOR_VERSION).alias("detector_version"),
                  seq.cast("long").alias("seq")]


def _canonical_order(df: DataFrame, extra: list[str]) -> DataFrame:
    return df.select(*S.READING_COLUMNS, *extra)


# -- MQTT (OP-08, OP-09) ---------------------------------------------------

def normalize_mqtt(messages: DataFrame, topic_filter: str | None = None) -> DataFrame:
    """``(topic, payload, arrival_seq, arrived_at)`` -> readings + ``error``.

    * topic: strip '/', split; plant = level 2, line = level 3, machine =
      level 4 or 'unknown' (prefix not checked);
    * payload must be a JSON object; keys iterate like a Python dict (first
      position, last value);
    * metrics: lower-cased key through the alias map; numbers and booleans
      only (``true`` -> 1.0); later key wins on alias collisions;
    * timestamp: ``ts``, else ``timestamp`` when ``ts`` is falsy; a number is
      epoch seconds, a string ISO text; neither -> arrival time;
    * status: exact key ``status``, lower-cased, outside the domain 'unknown'.

    ``exact_ids`` (default) makes event ids byte-equal to other writers';
    ``False`` uses the all-JVM form (see :mod:`shopfloor.functions.eventid`).
    """
    m = messages
    if topic_filter:
        m = m.filter(topic_matches(F.col("topic"), topic_filter))
    # Stages are chained with ``let`` bindings (lambda variables), so each
    # expensive expression is evaluated once per row and a filter on
    # ``error`` pushed below the projection stays linear in size.
    aliases = _lit_map(S.MQTT_ALIASES)

    def parsed(obj):
        entries = J.python_object_entries(F.map_entries(obj))
        return J.let(entries, lambda es: F.struct(
            obj.alias("obj"),
            J.dedupe_last_wins(F.transform(
                F.filter(es, lambda e: aliases[F.lower(e["key"])].isNotNull()
                         & J.is_number_or_bool(e["value"])),
                lambda e: F.struct(aliases[F.lower(e["key"])].alias("name"),
                                   J.as_double(e["value"]).alias("value")))).alias("metrics"),
            J.last_value(es, "ts").alias("ts1"),
            J.last_value(es, "timestamp").alias("ts2"),
            J.last_value(es, "status").alias("stv")))

    def timed(p):
        tsv = J.let(F.struct(p["ts1"].alias("a"), p["ts2"].alias("b")),
                    lambda s: F.when(J.truthy(s["a"]), s["a"]).otherwise(s["b"]))

        def ts_of(v):
            t = J.vtype(v)
            secs = J.as_double(v)
            return (F.when(~J.truthy(v), F.col("arrived_at"))
                    .when(t.rlike(J.NUMERIC_TYPE) & (F.abs(secs) <= MAX_EPOCH_SECONDS),
                          F.timestamp_micros(F.bround(secs * F.lit(1_000_000.0)).cast("long")))
                    .when(t == "STRING", parse_iso(F.try_variant_get(v, "$", "string"))))
        status = J.let(p["stv"], lambda v: F.when(v.isNull(), F.lit("unknown"))
                       .otherwise(status_domain(J.as_text(v))))
        ts = J.let(tsv, ts_of)
        return J.let(F.struct(p["obj"].isNull().alias("bad"), p["metrics"].alias("metrics"),
                              ts.alias("ts"), status.alias("status")),
                     lambda r: F.struct(
                         r["metrics"].alias("metrics"), r["ts"].alias("ts"), r["status"].alias("status"),
                         F.when(r["bad"], F.lit(ERR_NOT_OBJECT))
                          .when(r["ts"].isNull(), F.lit(ERR_TIMESTAMP))
                          .when(~_finite(r["metrics"]), F.lit(ERR_NON_FINITE)).alias("error")))

    row = J.let(J.let(F.from_json(F.col("payload"), "map<string,variant>"), parsed), timed)
    # explode of a one-element array: a generated column, so a filter on the
    # result (e.g. ``error IS NULL``) cannot be pushed below it and evaluate
    # the whole chain a second time.
    m = m.select("*", F.explode(F.array(row)).alias("_r"), topic_parts(F.col("topic")).alias("_parts"))
    m = m.select("*", F.col("_r.ts").alias("_ts"), F.col("_r.metrics").alias("_metrics"),
                 F.col("_r.status").alias("_status"), F.col("_r.error").alias("_error"),
                 F.try_element_at(F.col("_parts"), F.lit(2)).alias("_plant"),
                 F.try_element_at(F.col("_parts"), F.lit(3)).alias("_line"),
                 F.coalesce(F.try_element_at(F.col("_parts"), F.lit(4)), F.lit("unknown")).alias("_machine"))
    error = F.col("_error")
    out = m.select(*_reading(F.col("_machine"), F.col("_plant"), F.col("_line"), "mqtt", F.col("_ts"),
                             F.col("_metrics"), F.col("_status"), F.col("payload"),
                             F.col("arrival_seq"), F.col("arrived_at")),
                   "arrival_seq", error.alias("error"))
    return _canonical_order(out, ["arrival_seq", "error"])


# -- registry (OP-07) ------------------------------------------------------

def attach_registry(polls: DataFrame, registry: DataFrame) -> DataFrame:
    """OP-07: polls exist only for registered devices -> inner equi-join on
    ``machine_id``; the planner picks the join by the registry's bytes."""
    reg = registry.select("machine_id", "plant_id", "line_id", "register_addresses", "nodes")
    return polls.join(reg, "machine_id", "inner")


# -- Modbus (OP-06, OP-10a) ------------------------------------------------

def decode_registers(start: Column, registers: Column, addresses: Column) -> Column:
    """OP-06: block -> map address -> value for the configured addresses;
    address = block start + offset."""
    entries = F.transform(registers, lambda x, i: F.struct((start + i).alias("addr"), x.alias("val")))
    return F.map_from_entries(F.filter(entries, lambda e: F.array_contains(addresses, e["addr"])))


def normalize_modbus(polls: DataFrame) -> DataFrame:
    """Landed polls (with registry columns) -> readings. Error polls give no
    reading. Missing status register reads as code 0 (idle); unmapped code
    -> unknown. Timestamp = poll time.

    The register map is fixed, so each mapped register is read straight from
    the block (``element_at`` at address - start, kept only when the address
    is configured) -- no per-row lambda; :func:`decode_registers` is the
    general block -> map decoder."""
    default_addrs = F.array(*[F.lit(a) for a in S.default_modbus_addresses()])
    addrs = F.col("register_addresses") if "register_addresses" in polls.columns else F.lit(None)
    addrs = F.when(F.size(F.coalesce(addrs, F.array().cast("array<int>"))) > 0, addrs) \
             .otherwise(default_addrs)
    p = polls.filter(~F.coalesce(F.col("is_error"), F.lit(False)))
    p = p.select("*", addrs.alias("_addrs"))
    p = p.select("*", F.coalesce(F.col("start_address"), F.array_min("_addrs")).alias("_start"))

    def reg(addr: int) -> Column:
        idx = F.lit(addr) - F.col("_start") + 1
        return F.when(F.array_contains(F.col("_addrs"), F.lit(addr)) & (idx >= 1),
                      F.try_element_at(F.col("registers"), idx))

    # One narrow column per register (each read once), then the map from them.
    addrs_all = list(S.MODBUS_REGISTERS) + [S.MODBUS_STATUS_REGISTER]
    p = p.select("*", *[reg(a).alias(f"_r{a}") for a in addrs_all])
    empty = F.create_map().cast("map<string,double>")
    metrics = F.map_concat(*[
        F.when(F.col(f"_r{addr}").isNotNull(),
               F.create_map(F.lit(name), F.col(f"_r{addr}").cast("double") * F.lit(float(scale))))
         .otherwise(empty)
        for addr, (name, scale) in S.MODBUS_REGISTERS.items()])
    code = F.coalesce(F.col(f"_r{S.MODBUS_STATUS_REGISTER}"), F.lit(0))
    status = F.coalesce(_lit_map(S.MODBUS_STATUS_CODES)[code], F.lit("unknown"))
    plant = F.col("plant_id") if "plant_id" in polls.columns else F.lit(None).cast("string")
    line = F.col("line_id") if "line_id" in polls.columns else F.lit(None).cast("string")
    p = p.select("*", metrics.alias("_metrics"), status.alias("_status"))
    raw = F.to_json(F.struct(F.col("_start").alias("start_address"), F.col("registers"),
                             F.col("_addrs").alias("addresses")))
    out = p.select(*_reading(F.col("machine_id"), plant, line, "modbus", F.col("arrived_at"),
                             F.col("_metrics"), F.col("_status"), raw, F.col("arrival_seq"),
                             F.col("arrived_at")),
                   "arrival_seq", F.lit(None).cast("string").alias("error"))
    return _canonical_order(out, ["arrival_seq", "error"])


# -- OPC-UA (OP-10b) -------------------------------------------------------

def normalize_opcua(polls: DataFrame) -> DataFrame:
    """Node lists -> readings. Per node in order: quality must be 'Good'
    (missing = Good); name lower-cased with spaces -> '_'; 'machine_status'
    sets the status; mapped names with number/boolean values become metrics,
    later nodes win. Timestamp = poll time."""
    node_map = _lit_map(S.OPCUA_NODE_NAMES)
    good = F.filter(F.col("nodes"), lambda n: F.coalesce(n["status"], F.lit(S.OPCUA_GOOD_QUALITY))
                    == F.lit(S.OPCUA_GOOD_QUALITY))
    named = F.transform(good, lambda n: F.struct(
        F.replace(F.lower(F.coalesce(n["name"], F.lit(""))), F.lit(" "), F.lit("_")).alias("nm"),
        F.try_parse_json(n["value"]).alias("v")))
    p = polls.select("*", named.alias("_named"))
    nodes = F.col("_named")
    status_v = F.try_element_at(F.filter(nodes, lambda n: n["nm"] == F.lit(S.OPCUA_STATUS_NODE)), F.lit(-1))["v"]
    status = F.when(status_v.isNull(), F.lit("unknown")).otherwise(status_domain(J.as_text(status_v)))
    pairs = F.transform(
        F.filter(nodes, lambda n: (n["nm"] != F.lit(S.OPCUA_STATUS_NODE))
                 & node_map[n["nm"]].isNotNull() & J.is_number_or_bool(n["v"])),
        lambda n: F.struct(node_map[n["nm"]].alias("name"), J.as_double(n["v"]).alias("value")))
    metrics = J.dedupe_last_wins(pairs)
    plant = F.col("plant_id") if "plant_id" in polls.columns else F.lit(None).cast("string")
    line = F.col("line_id") if "line_id" in polls.columns else F.lit(None).cast("string")
    raw = F.to_json(F.struct(F.col("nodes").alias("nodes")))
    # Metrics and status become columns first, so the id function and the
    # outputs refer to them instead of copies of the node-list expressions.
    p = p.select("*", metrics.alias("_metrics"), status.alias("_status"))
    error = F.when(~_finite(F.col("_metrics")), F.lit(ERR_NON_FINITE))
    out = p.select(*_reading(F.col("machine_id"), plant, line, "opcua", F.col("arrived_at"),
                             F.col("_metrics"), F.col("_status"), raw, F.col("arrival_seq"),
                             F.col("arrived_at")),
                   "arrival_seq", error.alias("error"))
    return _canonical_order(out, ["arrival_seq", "error"])


# -- routing, dead letter, wide view ----------------------------------------

def union_protocols(*frames: DataFrame) -> DataFrame:
    """OP-10c: all protocols in one canonical frame (union all, no shuffle)."""
    cols = list(S.READING_COLUMNS)
    out = frames[0].select(*cols)
    for f in frames[1:]:
        out = out.unionByName(f.select(*cols))
    return out


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """OP-15: (good readings without the error column, rejected rows)."""
    return df.filter(F.col("error").isNull()).drop("error"), df.filter(F.col("error").isNotNull())


def wide_metrics(df: DataFrame) -> DataFrame:
    """The metric map as the nine named double columns (missing -> null)."""
    return df.select("*", *[F.col("metrics")[m].alias(m) for m in S.METRIC_COLUMNS])
