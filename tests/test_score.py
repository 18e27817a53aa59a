from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.operators import score as sc
from shopfloor.sources import testdata as td
from tests.conftest import SF01
from tests.loop_oracle import score_rows


def _collect(df):
    return {(r.machine_id, r.seq): (r.anomaly_score, list(r.anomaly_flags)) for r in df.collect()}


def _compare(got, want):
    assert got.keys() == want.keys()
    bad = [k for k in want if abs(got[k][0] - want[k][0]) > 1e-4 or got[k][1] != want[k][1]]
    assert not bad, [(k, got[k], want[k]) for k in bad[:5]]


def _rows(df):
    return [(r.machine_id, r.seq, dict(r.metrics or {})) for r in
            df.select("machine_id", "seq", "metrics").collect()]


def test_scores_match_loop_on_all_rows(spark):
    readings = td.arrivals(spark, SF01)
    want = score_rows(_rows(readings))
    _compare(_collect(sc.score(readings)), want)
    assert {f for _, fl in want.values() for f in fl} == set(S.FLAGS)


def test_small_segments_hand_on_their_tails(spark):
    readings = td.arrivals(spark, SF01)
    want = score_rows(_rows(readings))
    # A machine's rows are spread over all segments, so frames reach back over very many of them.
    for segment_rows in (7000, 700):
        _compare(_collect(sc.score(readings, segment_rows=segment_rows)), want)


def test_one_machine_with_half_of_all_rows(spark):
    readings = td.arrivals(spark, SF01).withColumn(
        "machine_id", F.when(F.col("seq") % 4 < 2, F.lit("M-HALF")).when(F.col("seq") % 50 == 2, None).otherwise(F.col("machine_id")))
    share = readings.filter("machine_id = 'M-HALF'").count() / readings.count()
    assert 0.4 < share < 0.6
    want = score_rows(_rows(readings))
    scored = sc.score(readings, segment_rows=500)
    _compare(_collect(scored), want)
    # no segment, and so no window, has more rows than segment_rows
    largest = readings.groupBy("machine_id", F.floor(F.col("seq") / 500)).count().agg(F.max("count")).first()[0]
    assert largest <= 500


def test_machines_with_few_rows_are_handed_nothing(spark):
    # 200 machines take turns, so that 300 consecutive numbers have one or two rows of each.
    rows = [(f"M{i % 200}", i, {"rpm": float(i * 7 % 31), "flow_rate": float(i % 5)}) for i in range(6000)]
    df = spark.createDataFrame(rows, "machine_id string, seq long, metrics map<string,double>")
    handed = []
    was, sc._handed_on = sc._handed_on, lambda narrow, tails: handed.append(tails) or was(narrow, tails)
    try:
        scored = sc.score(df, segment_rows=300)
    finally:
        sc._handed_on = was
    assert handed[0].count() == 0
    _compare(_collect(scored), score_rows(rows))


def test_sparse_metrics_reach_back_over_many_segments(spark):
    rows = [("A", i, {"often": float(i % 7), **({"rare": float(i % 11)} if i % 97 == 0 else {})}) for i in range(4000)]
    rows += [(None, 10_000 + i, {"often": float(i % 5)}) for i in range(200)] + [("B", 20_000, {}), ("B", 20_001, None)]
    df = spark.createDataFrame(rows, "machine_id string, seq long, metrics map<string,double>").repartition(5)
    _compare(_collect(sc.score(df, segment_rows=40)), score_rows([(m, i, x or {}) for m, i, x in rows]))


def test_small_window_and_custom_config(spark):
    readings = td.arrivals(spark, SF01)
    cfg = {"temperature": S.MetricConfig(min_value=10, max_value=100, zscore_threshold=2.0,
                                          flatline_tolerance=5.0, flatline_window=3)}
    want = score_rows(_rows(readings), window=12, configs=cfg)
    for segment_rows in (sc.SEGMENT_ROWS, 300):
        _compare(_collect(sc.score(readings, window=12, configs=cfg, segment_rows=segment_rows)), want)


def _seq_df(spark, values, machine="M1", metric="temperature", extra=None):
    rows = []
    for i, v in enumerate(values):
        m = {metric: float(v)}
        if extra:
            m.update(extra)
        rows.append((machine, i, m))
    return spark.createDataFrame(rows, "machine_id string, seq long, metrics map<string,double>")


def test_reference_expectations(spark):
    # 30 x 70 then 71 (rpm flat 1450): score < 0.5 -- only the flat rpm (0.4)
    df = _seq_df(spark, [70.0] * 30 + [71.0], extra={"rpm": 1450.0})
    r = {x.seq: x for x in sc.score(df).collect()}
    assert r[30].anomaly_score < 0.5 and r[30].anomaly_score == 0.4
    # then 250 -> > 0.5 with OUT_OF_RANGE or SPIKE
    df = _seq_df(spark, [70.0] * 30 + [250.0], extra={"rpm": 1450.0})
    r = {x.seq: x for x in sc.score(df).collect()}
    assert r[30].anomaly_score > 0.5
    assert {"OUT_OF_RANGE", "SPIKE"} & set(r[30].anomaly_flags)
    # 20 x 50 then 51 on an unconfigured metric: zero variance -> z = |51-50| = 1.0 (no flag at thr 3)
    df = _seq_df(spark, [50.0] * 20 + [51.0], metric="custom")
    r = {x.seq: x for x in sc.score(df).collect()}
    assert "FLATLINE" in r[19].anomaly_flags
    assert r[20].anomaly_flags == [] or r[20].anomaly_flags == ["FLATLINE"]


def test_machines_independent_and_empty_readings(spark):
    rows = [("M1", i, {"temperature": 70.0}) for i in range(20)] + [("M2", 100, {"temperature": 70.0}),
                                                                     ("M3", 101, {})]
    df = spark.createDataFrame(rows, "machine_id string, seq long, metrics map<string,double>")
    r = {(x.machine_id, x.seq): x for x in sc.score(df).collect()}
    assert r[("M2", 100)].anomaly_score == 0.0 and r[("M2", 100)].anomaly_flags == []
    assert r[("M3", 101)].anomaly_score == 0.0
    assert len(r) == 22


def test_window_below_ten_never_scores_z_or_flat(spark):
    df = _seq_df(spark, [50.0] * 30 + [500.0], metric="custom")
    r = {x.seq: x for x in sc.score(df, window=9).collect()}
    assert all(x.anomaly_flags == [] for x in r.values())


def test_annotate_keeps_rows_and_stamps(spark):
    readings = td.event_readings(spark, SF01)
    out = sc.annotate(readings, detector_version="rules-test")
    assert out.count() == readings.count()
    assert out.filter(F.col("detector_version") != "rules-test").count() == 0
    assert out.columns[:len(S.READING_COLUMNS)] == list(S.READING_COLUMNS)
