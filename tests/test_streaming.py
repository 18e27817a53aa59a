import time

from pyspark.sql import functions as F

from shopfloor.operators import score as sc
from shopfloor.sources import testdata as td
from shopfloor.streaming import ingest, stateful
from tests.conftest import SF001


def _land_in_chunks(spark, df, path, chunks=3):
    """Write rows as separate files in seq order (one file per micro-batch)."""
    lo, hi = df.agg(F.min("seq"), F.max("seq")).first()
    step = (hi - lo) // chunks + 1
    for i in range(chunks):
        part = df.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)


def test_stream_equals_batch(spark, tmp_path):
    arr = td.arrivals(spark, SF001)
    src = str(tmp_path / "landing")
    _land_in_chunks(spark, arr, src)
    stream = spark.readStream.schema(arr.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = str(tmp_path / "scored")
    tail = str(tmp_path / "tail")
    q = (stream.writeStream
         .foreachBatch(lambda df, bid: stateful.score_batch(df, bid, tail).write.mode("append").parquet(out))
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    assert len(q.recentProgress) >= 3      # one micro-batch per landed file
    q.stop()
    got = {(r.machine_id, r.seq): (r.anomaly_score, list(r.anomaly_flags))
           for r in spark.read.parquet(out).collect()}
    assert len(got) == arr.count()
    want = {(r.machine_id, r.seq): (r.anomaly_score, list(r.anomaly_flags))
            for r in sc.score(arr).collect()}
    assert got.keys() == want.keys()
    bad = [k for k in want if abs(got[k][0] - want[k][0]) > 1e-4 or got[k][1] != want[k][1]]
    assert not bad, bad[:5]


def test_ingest_pipeline_dedups_and_accounts(spark, tmp_path):
    arr = td.arrivals(spark, SF001)
    src = str(tmp_path / "landing")
    _land_in_chunks(spark, arr, src, chunks=2)
    stream = spark.readStream.schema(arr.schema).option("maxFilesPerTrigger", 1).parquet(src)
    store_path, acc_path = str(tmp_path / "store"), str(tmp_path / "acc")
    q = ingest.start_ingest(stream, str(tmp_path / "ck"), store_path,
                            wide_path=str(tmp_path / "wide"), points_path=str(tmp_path / "points"),
                            accounting_path=acc_path, log_path=str(tmp_path / "log"))
    q.processAllAvailable()
    q.stop()
    stored = spark.read.parquet(store_path)
    n_events = td.event_readings(spark, SF001).count()
    assert stored.count() == n_events
    assert stored.select("event_id").distinct().count() == n_events
    # first arrival wins: no re-delivered copy was stored
    assert stored.filter(F.col("pipeline_version") == td.REDELIVERED_VERSION).count() == 0
    tot = ingest.read_accounting_totals(spark, acc_path).first()
    assert tot.total_received == arr.count()
    assert tot.total_processed == n_events
    assert tot.total_duplicates == arr.count() - n_events
    assert spark.read.parquet(str(tmp_path / "wide")).count() == n_events
    assert spark.read.text(str(tmp_path / "points")).count() == n_events
    # the JSONL log tails as a stream (OP-04) and holds every stored reading
    from shopfloor.sinks import stores
    tail = stores.read_event_log_stream(spark, str(tmp_path / "log"))
    q2 = (tail.writeStream.format("memory").queryName("log_tail")
          .option("checkpointLocation", str(tmp_path / "ck2")).start())
    q2.processAllAvailable()
    q2.stop()
    logged = spark.sql("select * from log_tail")
    assert logged.count() == n_events
    assert logged.join(stored.select("event_id", "seq"), ["event_id", "seq"]).count() == n_events


def test_retried_batch_is_idempotent(spark, tmp_path):
    """A batch run twice (a retry after a failure) leaves the same store,
    sinks and accounting as one run."""
    from shopfloor.operators import score as sc2
    arr = sc2.annotate(td.arrivals(spark, SF001))
    first = arr.filter(F.col("seq") < 1000)
    second = arr.filter(F.col("seq") >= 1000)
    paths = {k: str(tmp_path / k) for k in ("store", "wide", "points", "acc", "log")}

    def run(df, bid):
        ingest.process_batch(df, bid, paths["store"], paths["wide"], paths["points"],
                             paths["acc"], log_path=paths["log"])
    run(first, 0)
    run(second, 1)
    run(second, 1)          # retry of batch 1 after it had fully committed
    n_events = td.event_readings(spark, SF001).count()
    assert spark.read.parquet(paths["store"]).count() == n_events
    assert spark.read.parquet(paths["wide"]).count() == n_events
    assert spark.read.text(paths["points"]).count() == n_events
    assert spark.read.json(paths["log"]).count() == n_events
    tot = ingest.read_accounting_totals(spark, paths["acc"]).first()
    assert tot.total_received == arr.count() and tot.total_processed == n_events


def test_raw_mqtt_stream_end_to_end(spark, tmp_path):
    """Landed raw MQTT files -> normalize -> keyed-state scoring -> dedup,
    store and rejects, in one streaming query."""
    from shopfloor.operators import normalize
    from shopfloor.sources import raw
    msgs = td.mqtt_messages(spark, SF001).withColumn("seq", F.col("arrival_seq"))
    land = str(tmp_path / "raw")
    _land_in_chunks(spark, msgs, land, chunks=2)
    stream = raw.read_raw(spark, "mqtt", land, stream=True, max_files_per_trigger=1)
    readings = normalize.normalize_mqtt(stream).drop("arrival_seq")
    store, rejected = str(tmp_path / "store"), str(tmp_path / "rejected")
    q = ingest.start_ingest(readings, str(tmp_path / "ck"), store, rejected_path=rejected)
    q.processAllAvailable()
    q.stop()
    good, bad = normalize.split_errors(normalize.normalize_mqtt(
        td.mqtt_messages(spark, SF001)))
    stored = spark.read.parquet(store)
    assert stored.count() == good.select("event_id").distinct().count()
    assert spark.read.parquet(rejected).count() == bad.count()
    # same scores as the batch plan over the same good readings
    want = {r.seq: r.anomaly_score for r in sc.score(good).collect()}
    got = {r.seq: r.anomaly_score for r in stored.collect()}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_a_batch_that_the_dedup_alone_reads_is_not_persisted(spark, tmp_path, monkeypatch):
    first, seen = ingest.first_arrivals, []

    def watched(batch, stored):
        seen.append(batch.storageLevel.useMemory)
        return first(batch, stored)

    monkeypatch.setattr(ingest, "first_arrivals", watched)
    rows = td.event_readings(spark, SF001)
    ingest.process_batch(rows, 0, str(tmp_path / "a"), summary_path=str(tmp_path / "sums"))
    ingest.process_batch(rows, 0, str(tmp_path / "b"), accounting_path=str(tmp_path / "acc"))
    assert seen == [False, True]
    assert not rows.storageLevel.useMemory
    assert spark.read.parquet(str(tmp_path / "a")).count() == spark.read.parquet(str(tmp_path / "b")).count() == rows.count()
