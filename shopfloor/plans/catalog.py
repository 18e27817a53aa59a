"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the driver's
tables through the telemetry mapping of :mod:`shopfloor.sources.testdata`.

Output columns are plain (text flags, ISO text or epoch micros for
instants) and named exactly like the DuckDB oracle in
:mod:`shopfloor.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.functions.eventid import event_id
from shopfloor.functions.timefmt import iso_text
from shopfloor.operators import dedup, normalize
from shopfloor.operators import score as sc
from shopfloor.plans import queries as Q
from shopfloor.plans import replay as R
from shopfloor.plans import summary
from shopfloor.session import checkpoint_dir
from shopfloor.sinks import stores
from shopfloor.sources import raw
from shopfloor.sources import testdata as td
from shopfloor.streaming import accounting, ingest

AS_OF = "2024-01-31 00:00:00"
CURSOR_EVENT = "E-5000"
REPLAY_SINCE = "2024-01-10T00:00:00"
REPLAY_UNTIL = "2024-01-20T00:00:00"
STAMPED_AT = dt.datetime(2024, 2, 1, 12, tzinfo=dt.timezone.utc)
FAN_OUT_BATCHES = 3
BATCH_SEQ_SPAN = 2000   # accounting: arrivals grouped into micro-batches by seq


def live_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Live path: every arrival (re-deliveries too) is scored, then stored."""
    return sc.annotate(td.arrivals(spark, sf))


def store(spark: SparkSession, sf: str) -> DataFrame:
    """The reading store: first arrival of every event id."""
    return dedup.first_arrivals(live_scored(spark, sf))


def _fresh_folder(spark: SparkSession) -> str:
    """A folder of its own for a query that writes, where all executors see it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/queries/{uuid.uuid4().hex}"


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The reading store as a table that was written once, for queries that read it several times."""
    path = _fresh_folder(spark)
    df = store(spark, sf)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _metrics(col: str = "metrics") -> list:
    return [F.col(col)[m].alias(m) for m in S.METRIC_COLUMNS]


def _flags(df: DataFrame) -> DataFrame:
    return df.withColumn("anomaly_flags", Q.flags_text())


def q_score_readings(spark, sf):
    scored = sc.score(td.arrivals(spark, sf))
    return scored.select("seq", "machine_id", "anomaly_score",
                         F.array_join("anomaly_flags", ",").alias("anomaly_flags"))


def q_score_readings_split(spark, sf):
    """Same scores with small segments, so that every machine's sequences go
    through many of them and frames reach back over several."""
    scored = sc.score(td.arrivals(spark, sf), segment_rows=300)
    return scored.select("seq", "machine_id", "anomaly_score",
                         F.array_join("anomaly_flags", ",").alias("anomaly_flags"))


def q_score_skewed(spark, sf):
    """A third of all arrivals on one machine, some on a null machine, and an
    arrival order in two clumps far apart; small segments."""
    eid = F.floor(F.col("seq") / 2)
    skewed = td.arrivals(spark, sf).withColumns({
        "machine_id": F.when(eid % 3 == 0, "M-HOT").when(eid % 25 == 1, None).otherwise(F.col("machine_id")),
        "seq": F.col("seq") + F.when(F.col("seq") % 4000 >= 2000, F.lit(1 << 40)).otherwise(F.lit(0))})
    scored = sc.score(skewed, segment_rows=64)
    return scored.select("seq", "machine_id", "anomaly_score",
                         F.array_join("anomaly_flags", ",").alias("anomaly_flags"))


def q_dedup_store(spark, sf):
    return _flags(store(spark, sf).select("seq", "event_id", "machine_id", "pipeline_version",
                                          "anomaly_score", "anomaly_flags"))


def q_public_view(spark, sf):
    """OP-18: API shape of stored readings (ISO text instants, no payload)."""
    v = Q.public_view(store(spark, sf))
    return v.select("seq", "event_id", "machine_id", "plant_id", "line_id", "source_protocol",
                    "timestamp", "ingested_at", "status", "anomaly_score",
                    F.array_join("anomaly_flags", ",").alias("anomaly_flags"),
                    "pipeline_version", "detector_version", *_metrics())


def q_manual_ingest(spark, sf):
    """OP-05: every arrival posted as an already-scored reading without
    versions, a third of them without an id: defaults and ids filled, domain
    checked, no re-scoring."""
    posted = live_scored(spark, sf).withColumns({
        "event_id": F.when(F.col("seq") % 6 == 0, F.lit("")).when(F.col("seq") % 6 != 2, F.col("event_id")),
        "pipeline_version": F.lit(None).cast("string"),
        "detector_version": F.lit(None).cast("string")})
    out = dedup.manual_ingest(posted)
    return out.select("seq", "event_id", "pipeline_version", "detector_version", "anomaly_score",
                      "error")


def q_pipeline_stats(spark, sf):
    return Q.pipeline_stats(store(spark, sf))


def q_protocol_counts(spark, sf):
    return Q.protocol_counts(store(spark, sf))


def q_active_machines(spark, sf):
    return sc.active_machines(td.arrivals(spark, sf))


def q_anomalous_readings(spark, sf):
    return Q.anomalous(store(spark, sf)).select("seq", "machine_id", "anomaly_score")


def q_machine_list(spark, sf):
    return Q.machine_list(store(spark, sf))


def q_recent_readings(spark, sf):
    r = Q.recent_readings(store(spark, sf), limit=S.DEFAULT_QUERY_LIMIT)
    return r.select("machine_id", "seq", F.col("rank").cast("long").alias("rank"), "event_id",
                    iso_text(F.col("timestamp")).alias("timestamp"), "anomaly_score")


def q_latest_reading(spark, sf):
    r = Q.latest_reading(store(spark, sf))
    return _flags(r.select("machine_id", "seq", "event_id", "status",
                           iso_text(F.col("timestamp")).alias("timestamp"),
                           "anomaly_score", "anomaly_flags"))


def q_recent_anomalies(spark, sf):
    r = Q.recent_anomalies(store(spark, sf), limit=500, min_score=0.5)
    return _flags(r.select("seq", "event_id", "machine_id", "anomaly_score", "anomaly_flags"))


def q_recent_anomalies_retained(spark, sf):
    """The same for a store that remembers only its newest 1000 flagged readings."""
    r = Q.recent_anomalies(store(spark, sf), limit=500, min_score=0.5, retention=1000)
    return _flags(r.select("seq", "event_id", "machine_id", "anomaly_score", "anomaly_flags"))


def q_cursor_tail(spark, sf):
    r = Q.readings_after(stored(spark, sf), CURSOR_EVENT, limit=S.TAIL_PAGE)
    return r.select("seq", "event_id", "machine_id")


def q_replay_window(spark, sf):
    r = R.replay_readings(stored(spark, sf), since=REPLAY_SINCE, until=REPLAY_UNTIL)
    return _flags(r.select("seq", "machine_id", "anomaly_score", "anomaly_flags",
                           "pipeline_version", "detector_version"))


def q_replay_summary(spark, sf):
    return R.replay_summary(R.replay_readings(stored(spark, sf)))


def q_sql_recent(spark, sf):
    r = Q.sql_recent(store(spark, sf))
    return r.select("machine_id", "seq", F.col("rank").cast("long").alias("rank"))


def q_sql_anomalies(spark, sf):
    r = Q.sql_anomalies(store(spark, sf), AS_OF, hours=72)
    return r.select("seq", "machine_id", "anomaly_score",
                    F.unix_micros("timestamp").alias("ts_us"))


def q_points_pivot(spark, sf):
    p = Q.points_pivot(stores.point_fields_long(store(spark, sf)), AS_OF, hours=24 * 40)
    return p.select("event_id", "machine_id", F.unix_micros("time").alias("ts_us"), *S.METRIC_COLUMNS,
                    "anomaly_score", F.size("extra_fields").cast("long").alias("n_extra"))


def q_metrics_view(spark, sf):
    """OP-46 with duplicates and failures from the ingest accounting."""
    return Q.metrics_view(stored(spark, sf), accounting=q_ingest_accounting(spark, sf))


def q_wide_rows(spark, sf):
    w = stores.to_wide(store(spark, sf))
    return w.select("event_id", F.unix_micros("time").alias("ts_us"), "machine_id", "plant_id",
                    "line_id", "protocol", "status", *S.METRIC_COLUMNS, "anomaly_score",
                    F.array_join("anomaly_flags", ",").alias("anomaly_flags"),
                    "pipeline_version", "detector_version")


def q_point_tags(spark, sf):
    p = stores.to_points(store(spark, sf))
    return p.select(F.col("tags")["event_id"].alias("event_id"), "measurement",
                    F.col("tags")["plant_id"].alias("plant_tag"),
                    F.col("tags")["line_id"].alias("line_tag"),
                    F.col("tags")["protocol"].alias("protocol_tag"),
                    F.col("tags")["status"].alias("status_tag"),
                    F.col("fields.anomaly_flags").alias("flags_field"),
                    F.size("metric_fields").cast("long").alias("n_metric_fields"),
                    F.col("fields.anomaly_score").alias("score_field"), *_metrics("metric_fields"),
                    (F.unix_micros("time") * 1000).alias("time_ns"))


def q_ingest_accounting(spark, sf):
    """OP-37: batches of all arrivals, and of the MQTT messages that fail to normalize."""
    _, bad = normalize.split_errors(normalize.normalize_mqtt(td.mqtt_messages(spark, sf)))
    bad = bad.select((F.col("arrival_seq") * 2).alias("seq"), "error")
    arr = live_scored(spark, sf).unionByName(bad, allowMissingColumns=True)
    return accounting.batch_accounting(arr.withColumn("batch_id", F.floor(F.col("seq") / BATCH_SEQ_SPAN)))


def q_event_id_groups(spark, sf):
    """OP-11: ids computed from canonical content over all arrivals must group
    readings exactly like their content does: (copies per id, ids)."""
    ids = td.arrivals(spark, sf).select(event_id().alias("eid"))
    return (ids.groupBy("eid").agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("copies").agg(F.count(F.lit(1)).alias("ids")))


def q_event_ids(spark, sf):
    """OP-11: the id text of every arrival, made from its content."""
    return td.arrivals(spark, sf).select("seq", event_id().alias("event_id"))


def q_wide_append_twice(spark, sf):
    """OP-42: one protocol's arrivals appended, then all of them; the table has each id once."""
    path = _fresh_folder(spark)
    arrivals = live_scored(spark, sf)
    stores.write_wide_table(arrivals.filter(F.col("source_protocol") == "mqtt"), path)
    stores.write_wide_table(arrivals, path)
    return spark.read.parquet(path).select(
        "event_id", F.unix_micros("time").alias("ts_us"), "machine_id", "protocol", "status", *S.METRIC_COLUMNS,
        "anomaly_score", F.array_join("anomaly_flags", ",").alias("anomaly_flags"), "pipeline_version")


def q_log_round_trip(spark, sf):
    """OP-47 and OP-04: the store written as a JSONL log and read back."""
    path = _fresh_folder(spark)
    stores.write_event_log(store(spark, sf), path)
    back = stores.read_event_log(spark, path)
    return back.select("seq", "event_id", "machine_id", iso_text(F.col("timestamp")).alias("timestamp"),
                       *_metrics(), "status", "anomaly_score",
                       F.array_join("anomaly_flags", ",").alias("anomaly_flags"), "pipeline_version")


def q_replay_export(spark, sf):
    """OP-48: the lines that a replay of the window exports, read back."""
    path = _fresh_folder(spark)
    stores.write_event_log(R.replay_readings(stored(spark, sf), since=REPLAY_SINCE, until=REPLAY_UNTIL),
                           path, mode="overwrite")
    return _flags(stores.read_event_log(spark, path).select(
        "seq", "machine_id", "anomaly_score", "anomaly_flags", "pipeline_version", "detector_version"))


def q_raw_to_scored(spark, sf):
    """OP-01, 08, 09, 14, 29: messages landed as files, read as raw frames, those of the default
    topic filter normalized, stamped and scored."""
    path = _fresh_folder(spark)
    landed = td.mqtt_messages(spark, sf).withColumn("topic", F.regexp_replace("topic", "^/|/$", ""))
    landed.write.parquet(path)
    good, _ = normalize.split_errors(
        normalize.normalize_mqtt(raw.read_raw(spark, "mqtt", path), S.DEFAULT_TOPIC_FILTER))
    scored = sc.annotate(dedup.stamp(good, STAMPED_AT, "raw-1"))
    return _flags(scored.select(
        "seq", "machine_id", F.unix_micros("timestamp").alias("ts_us"), "status", "event_id",
        F.unix_micros("ingested_at").alias("ingested_us"), "pipeline_version", "anomaly_score", "anomaly_flags"))


def q_normalize_mqtt(spark, sf):
    good, _ = normalize.split_errors(normalize.normalize_mqtt(td.mqtt_messages(spark, sf)))
    return normalize.wide_metrics(good).select(
        "arrival_seq", "machine_id", "plant_id", "line_id", "status",
        F.unix_micros("timestamp").alias("ts_us"), "event_id", *S.METRIC_COLUMNS)


def q_mqtt_rejects(spark, sf):
    _, bad = normalize.split_errors(normalize.normalize_mqtt(td.mqtt_messages(spark, sf)))
    return bad.select("arrival_seq", "error")


def q_normalize_modbus(spark, sf):
    polls = normalize.attach_registry(td.modbus_polls(spark, sf), td.device_registry(spark, sf))
    good = normalize.normalize_modbus(polls)
    return normalize.wide_metrics(good).select(
        "arrival_seq", "machine_id", "plant_id", "line_id", "status",
        F.unix_micros("timestamp").alias("ts_us"), "event_id", *S.METRIC_COLUMNS)


def q_normalize_opcua(spark, sf):
    good = normalize.normalize_opcua(td.opcua_polls(spark, sf))
    return normalize.wide_metrics(good).select(
        "arrival_seq", "machine_id", "status", F.unix_micros("timestamp").alias("ts_us"), "event_id",
        *S.METRIC_COLUMNS)


def _landed(spark, kind: str, frames: DataFrame) -> DataFrame:
    """Raw frames as a bridge lands them: files of the protocol's schema, read as a source."""
    path = _fresh_folder(spark)
    frames.write.parquet(path)
    return raw.read_raw(spark, kind, path)


def q_normalize_union(spark, sf):
    """OP-01..03, 10c: landed frames of all three protocols, normalized to one frame, every reading."""
    u = normalize.union_protocols(
        normalize.split_errors(normalize.normalize_mqtt(_landed(spark, "mqtt", td.mqtt_messages(spark, sf))))[0],
        normalize.normalize_modbus(normalize.attach_registry(_landed(spark, "modbus", td.modbus_polls(spark, sf)),
                                                             td.device_registry(spark, sf))),
        normalize.normalize_opcua(_landed(spark, "opcua", td.opcua_polls(spark, sf))))
    return normalize.wide_metrics(u).select(
        "source_protocol", "seq", "machine_id", "plant_id", "line_id", "status",
        F.unix_micros("timestamp").alias("ts_us"), "event_id", *S.METRIC_COLUMNS)


def q_points_round_trip(spark, sf):
    """OP-40, 45: points written as line-protocol text, with blanks, commas, quotes, equals signs and
    backslashes in a tag and a text field, read back and pivoted."""
    path = _fresh_folder(spark)
    awkward = F.lit(' =,"\\ ')
    rows = store(spark, sf).withColumns({
        "plant_id": F.concat("plant_id", awkward), "pipeline_version": F.concat(awkward, "pipeline_version")})
    stores.write_points(rows, path)
    points = stores.read_points(spark, path)
    pivot = Q.points_pivot(stores.points_long(points), AS_OF, hours=24 * 40)
    tags = points.select(F.col("tags")["event_id"].alias("event_id"), F.col("tags")["plant_id"].alias("plant_tag"),
                         F.col("tags")["status"].alias("status_tag"), F.col("fields.anomaly_flags").alias("flags_field"),
                         F.col("fields.pipeline_version").alias("version_field"))
    return pivot.join(tags, "event_id").select(
        "event_id", "machine_id", F.unix_micros("time").alias("ts_us"), *S.METRIC_COLUMNS, "anomaly_score",
        "plant_tag", "status_tag", "flags_field", "version_field")


def _micro_batches(spark, sf) -> list[DataFrame]:
    """All scored arrivals in FAN_OUT_BATCHES parts, one after the other in append order."""
    live = _fresh_folder(spark)
    live_scored(spark, sf).write.parquet(live)
    arrivals = spark.read.parquet(live)
    span = F.floor(F.lit(arrivals.agg(F.max("seq")).first()[0]).cast("long") / F.lit(FAN_OUT_BATCHES)) + 1
    # Ranges, so that pages of the files, which the join with the scores has left in order of seq, are skipped.
    return [arrivals.filter((F.col("seq") >= span * batch) & (F.col("seq") < span * (batch + 1)))
            for batch in range(FAN_OUT_BATCHES)]


def _kept_figures(spark, sf) -> DataFrame:
    """Summaries that the micro-batches leave, the middle one retried after the last."""
    path = _fresh_folder(spark)
    batches = _micro_batches(spark, sf)
    for batch in (0, 1, 2, 1):
        ingest.process_batch(batches[batch], batch, f"{path}/store", summary_path=f"{path}/summary")
    return summary.read_summary(spark, f"{path}/summary")


def q_kept_machine_list(spark, sf):
    """OP-33 from the summaries of micro-batches, without reading the store."""
    return summary.machine_list(_kept_figures(spark, sf))


def q_kept_stats(spark, sf):
    """OP-31 from the summaries of micro-batches, without reading the store."""
    return summary.pipeline_stats(_kept_figures(spark, sf))


def q_fan_out(spark, sf):
    """OP-13, 49: three micro-batches through the live pipeline's sinks. Each first-seen reading with its
    batch, and whether the log, the wide table and the points have it, once each."""
    path = _fresh_folder(spark)
    for batch, rows in enumerate(_micro_batches(spark, sf)):
        ingest.process_batch(rows, batch, f"{path}/store", wide_path=f"{path}/wide", points_path=f"{path}/points",
                             log_path=f"{path}/log")
    kept = spark.read.parquet(f"{path}/store").select("event_id", "seq", "batch_id")
    sinks = {
        "wide_rows": spark.read.parquet(f"{path}/wide").select("event_id"),
        "points": stores.read_points(spark, f"{path}/points").select(F.col("tags")["event_id"].alias("event_id")),
        "log_lines": stores.read_event_log(spark, f"{path}/log").select("event_id"),
    }
    for name, ids in sinks.items():
        kept = kept.join(ids.groupBy("event_id").agg(F.count(F.lit(1)).alias(name)), "event_id", "left")
    return kept


QUERIES = {
    "score_readings": q_score_readings,
    "score_readings_split": q_score_readings_split,
    "score_skewed": q_score_skewed,
    "dedup_store": q_dedup_store,
    "public_view": q_public_view,
    "manual_ingest": q_manual_ingest,
    "pipeline_stats": q_pipeline_stats,
    "protocol_counts": q_protocol_counts,
    "active_machines": q_active_machines,
    "anomalous_readings": q_anomalous_readings,
    "machine_list": q_machine_list,
    "recent_readings": q_recent_readings,
    "latest_reading": q_latest_reading,
    "recent_anomalies": q_recent_anomalies,
    "recent_anomalies_retained": q_recent_anomalies_retained,
    "cursor_tail": q_cursor_tail,
    "replay_window": q_replay_window,
    "replay_summary": q_replay_summary,
    "sql_recent": q_sql_recent,
    "sql_anomalies": q_sql_anomalies,
    "points_pivot": q_points_pivot,
    "metrics_view": q_metrics_view,
    "wide_rows": q_wide_rows,
    "point_tags": q_point_tags,
    "ingest_accounting": q_ingest_accounting,
    "event_id_groups": q_event_id_groups,
    "event_ids": q_event_ids,
    "wide_append_twice": q_wide_append_twice,
    "log_round_trip": q_log_round_trip,
    "replay_export": q_replay_export,
    "raw_to_scored": q_raw_to_scored,
    "normalize_mqtt": q_normalize_mqtt,
    "mqtt_rejects": q_mqtt_rejects,
    "normalize_modbus": q_normalize_modbus,
    "normalize_opcua": q_normalize_opcua,
    "normalize_union": q_normalize_union,
    "points_round_trip": q_points_round_trip,
    "fan_out": q_fan_out,
    "kept_machine_list": q_kept_machine_list,
    "kept_stats": q_kept_stats,
}
