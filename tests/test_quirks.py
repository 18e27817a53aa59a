"""Quirks the SURVEY calls out (section 7.4), pinned as tests."""

import datetime as dt

from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.operators import dedup, normalize
from shopfloor.operators import score as sc
from shopfloor.plans import replay

T0 = dt.datetime(2024, 3, 8, 12, 0, 0, tzinfo=dt.timezone.utc)


def seq_df(spark, rows):
    return spark.createDataFrame(rows, "machine_id string, seq long, metrics map<string,double>")


def test_zero_variance_z_in_raw_units_is_a_spike(spark):
    # constant rpm 1450, then 1460: std 0 -> z = |1460 - 1450| = 10 > 4.5 -> SPIKE, score 1.0
    rows = [("M", i, {"rpm": 1450.0}) for i in range(20)] + [("M", 20, {"rpm": 1460.0})]
    r = {x.seq: x for x in sc.score(seq_df(spark, rows)).collect()}
    assert "SPIKE" in r[20].anomaly_flags and r[20].anomaly_score == 1.0


def test_non_finite_metric_is_rejected(spark):
    df = spark.createDataFrame([("f/p/l/M/t", '{"temp":1e400}', 1, T0),
                                ("f/p/l/M/t", '{"temp":-1e400}', 2, T0)], S.MQTT_RAW_SCHEMA)
    out = normalize.normalize_mqtt(df).collect()
    assert [r.error for r in out] == [normalize.ERR_NON_FINITE] * 2


def test_duplicates_feed_live_window_but_not_replay(spark):
    # 12 values 10.0, a 50.0 reading delivered twice, then 70.0. Live scoring
    # sees the copy (two 50s in the history: z ~ 3.9 -> DRIFT); replay scores
    # the deduped store (one 50: z ~ 5.4 -> SPIKE).
    base = [("M", i, f"e{i}", 10.0) for i in range(12)]
    base += [("M", 12, "e12", 50.0), ("M", 13, "e12", 50.0), ("M", 14, "e14", 70.0)]
    rows = [(m, None, None, "mqtt", eid, T0 + dt.timedelta(seconds=s), T0, {"temperature": v},
             "running", None, 0.0, [], "v", "d", s) for m, s, eid, v in base]
    arrivals = spark.createDataFrame(rows, S.READING_SCHEMA)
    live = sc.annotate(arrivals)
    store = dedup.first_arrivals(live)
    assert store.count() == 14
    live_14 = live.filter(F.col("seq") == 14).first()
    replay_14 = replay.replay_readings(store).filter(F.col("seq") == 14).first()
    assert list(live_14.anomaly_flags) == ["DRIFT"]
    assert list(replay_14.anomaly_flags) == ["SPIKE"]


def test_plants_sharing_a_machine_id_share_state(spark):
    rows = [("M", i, {"temperature": 70.0}) for i in range(10)] + [("M", 10, {"temperature": 200.5})]
    df = seq_df(spark, rows).withColumn("plant_id", F.when(F.col("seq") % 2 == 0, "A").otherwise("B"))
    r = {x.seq: x for x in sc.score(df).collect()}
    # all ten prior values (both plants) are the machine's history
    assert "SPIKE" in r[10].anomaly_flags and "OUT_OF_RANGE" in r[10].anomaly_flags


def test_basic_iso_text_parses_as_python_does(spark):
    from shopfloor.functions.timefmt import parse_iso
    texts = ["20240308", "20240308T101112", "20240308T10", "20240308T1011", "20240308 101112.5", "20240308T101112.1234567",
             "20240308T101112Z", "20240308T101112+02:00", "20240308T101112-0330", "20240308T10:11:12+02", "2024-03-08",
             "2024-03-08T10:11:12.25+05:30", "20241308", "20240230", "2024030", "202403081", "20240308T25", "2024", "bad", ""]

    def python(text):
        try:
            when = dt.datetime.fromisoformat(text)
        except ValueError:
            return None
        return when.replace(tzinfo=when.tzinfo or dt.timezone.utc).timestamp()

    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", (F.unix_micros(parse_iso(F.col("t"))) / 1e6).alias("at")).collect()
    assert {r["t"]: r["at"] for r in got} == {t: python(t) for t in texts}
