"""Accounting of failures and copies, append order over several counters, metrics of an empty store."""

from pyspark.sql import functions as F

from shopfloor.plans import queries as Q
from shopfloor.streaming.accounting import batch_accounting, totals

COLUMNS = ("batch_id long, seq long, event_id string, source_protocol string, anomaly_flags array<string>, "
           "pipeline_version string, detector_version string, error string")


def test_failures_copies_and_rows_without_id(spark):
    rows = [
        (0, 1, "a", "mqtt", ["SPIKE"], "p1", "d1", None), (0, 2, "a", "mqtt", [], "p1", "d1", None),
        (0, 3, None, "modbus", None, "p1", "d1", None), (0, 4, None, "modbus", None, "p2", "d1", None),
        (0, 5, None, None, None, None, None, "bad one"),
        (1, 6, "a", "mqtt", [], "p1", "d1", None), (1, 7, "b", "opcua", [], "p3", "d2", None),
        (1, 8, None, None, None, None, None, "bad two"), (1, 9, "s", "opcua", [], "p4", "d2", None),
        (2, 10, None, None, None, None, None, "bad three")]
    arrivals = spark.createDataFrame(rows, COLUMNS)
    stored = spark.createDataFrame([("s",)], "event_id string")
    kept = arrivals.filter(F.col("seq").isin(1, 3, 4, 7))
    for found in (batch_accounting(arrivals, stored), batch_accounting(arrivals, kept=kept)):
        got = {r.batch_id: r.asDict() for r in found.collect()}
        assert [(got[b]["received"], got[b]["processed"], got[b]["duplicates"], got[b]["anomalies"], got[b]["failed"])
                for b in (0, 1, 2)] == [(4, 3, 1, 1, 1), (3, 1, 2, 0, 1), (0, 0, 0, 0, 1)]
        assert (got[0]["mqtt"], got[0]["modbus"], got[1]["opcua"]) == (1, 2, 1)
        assert [(got[b]["last_event_id"], got[b]["pipeline_version"], got[b]["detector_version"], got[b]["last_error"])
                for b in (0, 1, 2)] == [(None, "p2", "d1", "bad one"), ("b", "p3", "d2", "bad two"),
                                        (None, None, None, "bad three")]
        total = totals(found).first()
        assert (total.total_failed, total.last_error, total.total_received) == (3, "bad three", 7)


def test_order_of_a_store_fed_by_several_counters(spark):
    """Later batches come later whatever their counters say."""
    rows = [(0, 900, "a", "M1"), (0, 901, "b", "M2"), (1, 5, "c", "M1"), (1, 1 << 41, "d", "M2"), (2, 7, "e", "M1")]
    store = spark.createDataFrame(rows, "batch_id long, seq long, event_id string, machine_id string").withColumns({
        "anomaly_flags": F.array(F.lit("SPIKE")), "anomaly_score": F.lit(0.9)})
    assert Q.pipeline_stats(store).first().last_event_id == "e"
    assert [r.event_id for r in Q.recent_anomalies(store, 3).collect()] == ["e", "d", "c"]
    assert [r.event_id for r in Q.readings_after(store, "b", 10).collect()] == ["c", "d", "e"]
    assert [r.event_id for r in Q.readings_after(store, "unknown", 2).collect()] == ["a", "b"]
    assert {r.machine_id: r.event_id for r in Q.latest_reading(store).collect()} == {"M1": "e", "M2": "d"}
    assert [r.event_id for r in Q.recent_readings(store, 2, "M1").collect()] == ["e", "c"]


def test_metrics_of_an_empty_store(spark):
    store = spark.createDataFrame([], "machine_id string, source_protocol string, anomaly_flags array<string>")
    got = {(r.metric, r.protocol): r.value for r in Q.metrics_view(store, failed=2).collect()}
    assert got == {("total_readings", ""): 0, ("total_anomalies", ""): 0, ("active_machines", ""): 0,
                   ("total_duplicates", ""): 0, ("failed_events", ""): 2}
