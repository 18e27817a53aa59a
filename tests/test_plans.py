"""Physical-plan properties the design relies on at scale."""

import os

from pyspark.sql import functions as F

from shopfloor.operators import dedup
from shopfloor.operators import score as sc
from shopfloor.plans import queries as Q
from shopfloor.sources import testdata as td
from tests.conftest import SF001


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_recent_per_machine_is_group_limited_before_shuffle(spark):
    p = plan(Q.recent_readings(td.event_readings(spark, SF001), limit=5))
    assert "WindowGroupLimit" in p


def test_dedup_uses_no_window_over_event_ids(spark):
    p = plan(dedup.first_arrivals(td.arrivals(spark, SF001)))
    assert "Window [" not in p and "row_number" not in p
    assert "partial_min_by" in p    # first arrival per id, combined map-side before the shuffle


def test_scoring_has_three_exchanges_and_reads_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        readings = td.event_readings(spark, SF001)
        p = sc.score(readings)._jdf.queryExecution().executedPlan().toString()
        scans = readings._jdf.queryExecution().executedPlan().toString().count("FileScan")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning") - p.count("ReusedExchange") == 3 and p.count("ReusedExchange") == 1, p
    assert p.count("FileScan") == scans and "Broadcast" not in p


def test_building_a_plan_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    arrivals = td.arrivals(spark, SF001)    # reading the file's schema is a job
    spark.sparkContext.setJobGroup("plan-only", "")
    sc.annotate(arrivals)
    assert not tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_replay_machine_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "store")
    td.event_readings(spark, SF001).write.parquet(path)
    from shopfloor.plans.replay import replay_readings
    out = replay_readings(spark.read.parquet(path), machine_id="M-7")
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(machine_id), EqualTo(machine_id,M-7)" in p
    assert out.count() == td.event_readings(spark, SF001).filter(F.col("machine_id") == "M-7").count()


def test_wide_append_leaves_the_stored_side_where_it_is(spark, tmp_path):
    from shopfloor.sinks import stores
    path = str(tmp_path / "wide")
    readings = td.event_readings(spark, SF001)
    stores.write_wide_table(readings.filter("seq % 4 = 0"), path, buckets=4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "11")  # the noted layout holds, not the session's
    try:
        rows, _, buckets = stores.new_wide_rows(readings, path)
        p = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    stored = p[p.index("Bucketed: true") - 600:]
    assert buckets == 4 and "SortMergeJoin" in p and "Exchange" not in p[p.rindex("FileScan parquet spark_catalog") - 400:], p
    assert stored and rows.count() == readings.filter("seq % 4 <> 0").count()
    stores.write_wide_table(readings, path)
    assert spark.read.parquet(path).select("event_id").distinct().count() == spark.read.parquet(path).count() == readings.count()


def test_points_are_parsed_once_whatever_is_filtered(spark, tmp_path):
    from shopfloor.sinks import stores
    path = str(tmp_path / "points")
    os.makedirs(path)
    with open(f"{path}/a.txt", "w") as f:
        f.write('m,a=1,b=x=y,c= f=1.5,g="u v" 1000\nm,a\\,b=\\=1 f=2 2000\nm f=3 3000\n# no point\nm,a=5 f="x 4000\n')
    points = stores.read_points(spark, path)
    p = points.select(F.col("tags")["a"].alias("a")).filter("a is not null")._jdf.queryExecution().executedPlan().toString()
    assert p.count("regexp_extract(") <= 3 and p.count("regexp_extract_all(") == 2, p
    found = {r["time"].timestamp(): (r["measurement"], r["tags"], r["metric_fields"]) for r in points.collect()}
    assert [found[t] for t in sorted(found)] == [
        ("m", {"a": "1", "b": "x=y", "c": ""}, {"f": 1.5, "g": None}), ("m", {"a,b": "=1"}, {"f": 2.0}), ("m", {}, {"f": 3.0})]


def test_micro_batches_are_ranges_that_reach_the_scan(spark, tmp_path):
    from shopfloor.plans import catalog
    batches = catalog._micro_batches(spark, SF001)
    for batch in batches:
        assert "GreaterThanOrEqual(seq," in batch._jdf.queryExecution().executedPlan().toString()
    seqs = sorted(r["seq"] for batch in batches for r in batch.select("seq").collect())
    assert seqs == sorted(r["seq"] for r in td.arrivals(spark, SF001).select("seq").collect())
    assert [b.agg(F.max("seq")).first()[0] for b in batches] == sorted(b.agg(F.max("seq")).first()[0] for b in batches)
