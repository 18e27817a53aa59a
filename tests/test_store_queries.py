"""Event log, sinks, dedup, query set and replay (reference service tests)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.operators import dedup
from shopfloor.plans import queries as Q
from shopfloor.plans import replay as R
from shopfloor.sinks import stores

T0 = dt.datetime(2024, 3, 8, 12, 0, 0, tzinfo=dt.timezone.utc)


def readings(spark, rows):
    """rows: (machine, seq, event_id, temperature, score, flags, ts_offset_s)."""
    data = []
    for m, seq, eid, temp, score, flags, off in rows:
        data.append((m, None, None, "mqtt", eid, T0 + dt.timedelta(seconds=off), T0,
                     {"temperature": float(temp), "rpm": 1450.0}, "running", None,
                     float(score), flags, S.DEFAULT_PIPELINE_VERSION, S.DEFAULT_DETECTOR_VERSION, seq))
    return spark.createDataFrame(data, S.READING_SCHEMA)


def test_log_roundtrip_and_dedup(spark, tmp_path):
    df = readings(spark, [("CNC-001", 1, "e1", 72.4, 0.8, ["SPIKE"], 0),
                          ("CNC-001", 2, "e1", 72.4, 0.8, ["SPIKE"], 0)])
    store = dedup.first_arrivals(df)
    assert store.count() == 1
    assert dedup.duplicates(df).count() == 1
    path = str(tmp_path / "log")
    stores.write_event_log(store, path)
    line = [ln for f in sorted(os.listdir(path)) if f.endswith(".json")
            for ln in open(os.path.join(path, f)) if ln.strip()][0]
    keys = list(json.loads(line))
    assert keys == sorted(keys)
    assert json.loads(line)["timestamp"] == "2024-03-08T12:00:00Z"
    back = stores.read_event_log(spark, path)
    stats = Q.pipeline_stats(back).first()
    assert (stats.total_readings, stats.total_anomalies, stats.active_machines) == (1, 1, 1)
    latest = Q.latest_reading(back, "CNC-001").first()
    assert latest.event_id == "e1" and latest.metrics["temperature"] == 72.4
    assert latest.timestamp == T0.replace(tzinfo=None) or latest.timestamp.timestamp() == T0.timestamp()
    # already-stored ids are duplicates of a new batch
    again = dedup.first_arrivals(df, stored_ids=back)
    assert again.count() == 0


def test_log_seq_follows_file_order_without_seq(spark, tmp_path):
    path = tmp_path / "plain.jsonl"
    lines = [json.dumps({"machine_id": "M", "source_protocol": "mqtt", "event_id": f"e{i}",
                         "timestamp": "2024-03-08T12:00:00Z", "metrics": {"temperature": i},
                         "status": "running", "anomaly_score": 0.0, "anomaly_flags": []})
             for i in range(50)]
    path.write_text("\n".join(lines[:25]) + "\n\n" + "\n".join(lines[25:]) + "\n")
    back = stores.read_event_log(spark, str(path)).orderBy("seq").collect()
    assert [r.event_id for r in back] == [f"e{i}" for i in range(50)]
    assert [r.seq for r in back] == list(range(50))
    cur = Q.readings_after(stores.read_event_log(spark, str(path)), "e9", limit=5).collect()
    assert [r.event_id for r in cur] == ["e10", "e11", "e12", "e13", "e14"]
    cur = Q.readings_after(stores.read_event_log(spark, str(path)), "nope", limit=2).collect()
    assert [r.event_id for r in cur] == ["e0", "e1"]


def test_point_and_wide_shapes(spark):
    df = readings(spark, [("CNC-001", 1, "e1", 72.4, 0.0, [], 0)])
    p = stores.to_points(df).first()
    assert p.measurement == "machine_readings"
    assert p.tags["machine_id"] == "CNC-001" and p.tags["plant_id"] == "unknown"
    assert p.metric_fields["temperature"] == 72.4 and p.fields.anomaly_flags == "none"
    line = stores.line_protocol(df).first().value
    assert line.startswith("machine_readings,event_id=e1,machine_id=CNC-001,plant_id=unknown")
    assert "rpm=1450.0,temperature=72.4,anomaly_score=0.0" in line
    assert line.endswith(str(int(T0.timestamp() * 1e9)))
    w = stores.to_wide(df).first()
    assert w.protocol == "mqtt" and w.temperature == 72.4 and w.vibration is None


def test_wide_table_idempotent(spark, tmp_path):
    df = readings(spark, [("M", 1, "e1", 70, 0, [], 0), ("M", 2, "e2", 71, 0, [], 1)])
    path = str(tmp_path / "wide")
    stores.write_wide_table(df, path)
    stores.write_wide_table(df, path)
    assert spark.read.parquet(path).count() == 2


def test_queries(spark):
    rows = [("M1", i, f"a{i}", 70, 0.9 if i % 5 == 0 else 0.0, ["SPIKE"] if i % 5 == 0 else [], i)
            for i in range(1, 21)]
    rows += [("M2", 100 + i, f"b{i}", 70, 0.0, [], 100 + i) for i in range(3)]
    store = readings(spark, rows)
    ml = Q.machine_list(store).collect()
    assert [(r.machine_id, r.reading_count, r.event_id) for r in ml] == [("M1", 20, "a20"), ("M2", 3, "b2")]
    assert ml[0].last_seen == "2024-03-08T12:00:20+00:00"
    assert Q.machine_list(store, retention=5).first().reading_count == 5
    rec = Q.recent_readings(store, limit=3, machine_id="M1").collect()
    assert [r.seq for r in rec] == [20, 19, 18]
    rec_all = Q.recent_readings(store, limit=2).collect()
    assert sorted((r.machine_id, r.seq) for r in rec_all) == [("M1", 19), ("M1", 20), ("M2", 101), ("M2", 102)]
    an = Q.recent_anomalies(store, limit=2, min_score=0.5).collect()
    assert [r.seq for r in an] == [20, 15]
    assert Q.recent_anomalies(store, retention=1).count() == 1
    assert Q.anomalous(store, 0.9).count() == 4 and Q.anomalous(store, 0.95).count() == 0
    pc = {r.source_protocol: r.readings for r in Q.protocol_counts(store).collect()}
    assert pc == {"mqtt": 23}
    an_sql = Q.sql_anomalies(store, T0 + dt.timedelta(seconds=30), hours=1).collect()
    assert [r.seq for r in an_sql] == [20, 15, 10, 5]
    mv = {(r.metric, r.protocol): r.value for r in Q.metrics_view(store, duplicates=2).collect()}
    assert mv[("total_readings", "")] == 23 and mv[("total_duplicates", "")] == 2
    assert mv[("readings_per_protocol", "mqtt")] == 23
    pv = Q.points_pivot(stores.point_fields_long(store), T0 + dt.timedelta(hours=1), hours=2,
                        machine_id="M2").collect()
    assert len(pv) == 3 and pv[0].temperature == 70.0 and pv[0].rpm == 1450.0


def test_replay_versions_and_scores(spark, tmp_path):
    store = readings(spark, [("CNC-001", 1, "e1", 70.0, 0, [], 0), ("CNC-001", 2, "e2", 71.0, 0, [], 1),
                             ("CNC-001", 3, "e3", 250.0, 0, [], 2)])
    out = str(tmp_path / "replay")
    summary = R.replay(store, output_path=out, detector_version="rules-replay-v2",
                       pipeline_version="replay-v2").first()
    assert summary.replayed == 3 and summary.exported == 3 and summary.anomalies == 1
    exported = spark.read.json(out).orderBy("seq").collect()
    assert exported[0].pipeline_version == "replay-v2" and exported[0].detector_version == "rules-replay-v2"
    assert any(r.anomaly_score > 0 for r in exported)
    first_two = R.replay_readings(store, limit=2)
    assert first_two.count() == 2
    windowed = R.replay_readings(store, since=T0 + dt.timedelta(seconds=1),
                                 until=T0 + dt.timedelta(seconds=2))
    assert sorted(r.seq for r in windowed.collect()) == [2, 3]


def test_manual_ingest_defaults_and_domain(spark):
    df = readings(spark, [("M", 1, "e1", 70, 0.3, ["SPIKE"], 0)]) \
        .withColumn("pipeline_version", F.lit(None).cast("string")) \
        .withColumn("detector_version", F.lit(None).cast("string"))
    r = dedup.manual_ingest(df).first()
    assert r.pipeline_version == "manual-ingest" and r.detector_version == "rules-v1"
    assert r.error is None and r.anomaly_score == 0.3
    bad = dedup.manual_ingest(df.withColumn("anomaly_score", F.lit(1.5))).first()
    assert bad.error == "anomaly_score outside [0, 1]"


def test_wide_table_lookback_prunes_old_partitions(spark, tmp_path):
    old = readings(spark, [("M", 1, "e1", 70, 0, [], 0)])
    path = str(tmp_path / "wide")
    stores.write_wide_table(old, path)
    later = old.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 10 DAYS"))
    # same id 10 days later: outside a 3-day look-back it is not compared (appended),
    # with the full table it is a duplicate
    stores.write_wide_table(later, path, lookback_days=3)
    assert spark.read.parquet(path).count() == 2
    stores.write_wide_table(later, path)
    assert spark.read.parquet(path).count() == 2


def test_import_log_in_the_other_writers_shape(spark, tmp_path):
    """Lines as another writer of the log produces them: every named metric
    key present (null when absent), raw payload as an object, Z instants,
    no seq column. Import, query and replay them."""
    def line(eid, temp, score, flags, ts):
        metrics = {k: None for k in S.METRIC_COLUMNS}
        metrics.update({"temperature": temp, "rpm": 1450.0})
        return json.dumps({"anomaly_flags": flags, "anomaly_score": score, "detector_version": "rules-v1",
                           "event_id": eid, "ingested_at": ts, "line_id": None, "machine_id": "CNC-001",
                           "metrics": metrics, "pipeline_version": "phase3-runtime-v1", "plant_id": None,
                           "raw_payload": {"temp": temp, "rpm": 1450}, "source_protocol": "mqtt",
                           "status": "running", "timestamp": ts}, sort_keys=True)
    lines = [line(f"id{i}", 70.0 + (i == 12) * 180.0, 0.0, [], f"2024-03-08T12:00:{i:02d}Z")
             for i in range(13)]
    lines.append(lines[3])                                   # a repeated id later in the log
    path = tmp_path / "events.jsonl"
    path.write_text("\n".join(lines) + "\n")
    log = stores.read_event_log(spark, str(path))
    store = dedup.first_arrivals(log)
    assert store.count() == 13
    r = store.filter(F.col("event_id") == "id0").first()
    assert r.metrics["temperature"] == 70.0 and r.metrics["vibration"] is None
    assert json.loads(r.raw_payload) == {"temp": 70.0, "rpm": 1450}
    out = {x.event_id: x for x in R.replay_readings(store).collect()}
    assert "OUT_OF_RANGE" in out["id12"].anomaly_flags       # 250 > 200, null metrics ignored
    assert out["id0"].anomaly_score == 0.0


def test_line_protocol_reads_back(spark, tmp_path):
    """Awkward text in tags and fields, other writers' lines, blank lines and comments."""
    odd = ["plain", "a b", "a,b=c", 'q"uote', "back\\\\slash\\", "\\n is no line end", "two\nlines", "é 日本 \U0001f642", "=,"]
    rows = [(f"E{i}", f"M {text}", text, None, "mqtt", T0, {"temperature": 1.5 + i, "odd name,=\\": -0.25}, "running",
             0.5, ["SPIKE", "DRIFT"] if i % 2 else [], f"v {text}", "d1") for i, text in enumerate(odd)]
    df = spark.createDataFrame(rows, "event_id string, machine_id string, plant_id string, line_id string, source_protocol string, "
                               "timestamp timestamp, metrics map<string,double>, status string, anomaly_score double, "
                               "anomaly_flags array<string>, pipeline_version string, detector_version string")
    stores.write_points(df, str(tmp_path / "points"))
    want = {r["tags"]["event_id"]: r.asDict(True) for r in stores.to_points(df).collect()}
    got = {r["tags"]["event_id"]: r.asDict(True) for r in stores.read_points(spark, str(tmp_path / "points")).collect()}
    assert got == want
    lines = ["", "# comment", "no point", "m,a=b x=1i,y=t,z=\"s\",w=2.5e3 1700000000000000001", "m f=1 -1000"]
    other = stores.parse_line_protocol(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r["tags"] for r in other] == [{"a": "b"}, {}]
    assert other[0]["metric_fields"] == {"x": None, "y": None, "z": None, "w": 2500.0} and other[1]["metric_fields"] == {"f": 1.0}
    assert stores.points_long(stores.read_points(spark, str(tmp_path / "points"))).count() == 3 * len(odd)


def test_kept_figures_equal_the_store_s(spark, tmp_path):
    """After late and retried batches, folded or not, and without readings."""
    from shopfloor.plans import summary
    from shopfloor.sources import testdata as td
    from shopfloor.streaming import ingest
    from tests.conftest import SF001
    readings = td.arrivals(spark, SF001).withColumns({
        "anomaly_flags": F.when(F.col("seq") % 5 == 0, F.array(F.lit("SPIKE"))).otherwise(F.array().cast("array<string>")),
        "machine_id": F.when(F.col("seq") % 30 != 4, F.col("machine_id"))}).cache()
    paths = {k: str(tmp_path / k) for k in ("store", "summary")}
    for batch in (0, 2, 1, 2, 0):  # batch 1 comes late, 2 and 0 are retried
        ingest.process_batch(readings.filter(F.col("seq") % 3 == batch), batch, paths["store"], summary_path=paths["summary"])
    store, kept = spark.read.parquet(paths["store"]), summary.read_summary(spark, paths["summary"])
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    for figures in (kept, summary.fold(kept)):
        assert rows(summary.pipeline_stats(figures)) == rows(Q.pipeline_stats(store))
        assert rows(summary.protocol_counts(figures)) == rows(Q.protocol_counts(store))
        assert rows(summary.machine_list(figures)) == rows(Q.machine_list(store))
        assert rows(Q.metrics_view(None, counts=summary.counts(figures))) == rows(Q.metrics_view(store))
    none = kept.limit(0)
    assert summary.pipeline_stats(none).first()["total_readings"] == 0 and summary.machine_list(none).count() == 0
