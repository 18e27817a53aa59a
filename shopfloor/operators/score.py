"""Rolling-statistics anomaly scoring (OP-20 .. OP-30) as DataFrame plans.

Semantics per (machine_id, metric), in arrival order (``seq``), over the
non-null values of that metric only:

* z-score against the previous ``window`` values (current excluded), only
  once at least 10 prior values exist; std below 1e-9 gives |v - mean| in raw
  units, otherwise |v - mean| / std (population std);
* out of range: v < min -> 0.8, else v > max -> 0.9;
* spike: z > 1.5 * thr -> min(1, z / (3 * thr)); else drift: z > thr ->
  min(0.7, z / (2 * thr));
* flatline: the last ``flatline_window`` values including the current one,
  at least that many (and never more than ``window`` are kept), max - min <
  tolerance -> 0.4;
* reading score = max of all signals of all its metrics (0.0 if none),
  rounded to 4 digits; flags = the distinct set, sorted.

Plan
----
One plan for all machines, whatever share of the rows one of them has. ``seq``
is unique, so a block of consecutive numbers holds at most so many rows. Blocks
have a fixed width; the rows of one machine in one block are cut, in order,
into segments of ``segment_rows``, and no segment, hence no window task, holds
more. A machine with few rows has one segment a block, whatever
``segment_rows`` is. Frames look back over a segment's beginning through
carried tails:

1. rows are hashed by (machine, block) and ranked there, which gives the segment;
2. of each segment and metric the last H values are taken (H = the longest
   look-back), hashed by (machine, metric), and scanned forward: what a segment
   is handed are the last H values of the segments before it. Every tail in
   the table has a value at least, so H tails back are enough;
3. the tails go to their blocks by (machine, block), with the first row of the
   block, the frames run over both, and the regrouping to readings stays inside
   the segment.

So there are three exchanges, the last two of tails only, and the rows are read
once: both the tails and the frames start from the first exchange
(``tests/test_plans.py`` counts them with broadcasts and adaptive execution
off). Nothing is counted, sampled or collected before, and building the plan
runs no job. A null machine is a machine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor import schema as S

SIGNAL_COLUMNS = ("_s_range", "_s_z", "_s_flat")
FLAG_BOOL_COLUMNS = {"DRIFT": "_f_drift", "FLATLINE": "_f_flat",
                     "OUT_OF_RANGE": "_f_range", "SPIKE": "_f_spike"}


def resolve_configs(configs: Mapping[str, S.MetricConfig] | None) -> Mapping[str, S.MetricConfig]:
    """OP-20: an empty or missing config mapping means the defaults."""
    return configs or S.DEFAULT_METRIC_CONFIGS


def _dbl(x) -> Column:
    return F.lit(None).cast("double") if x is None else F.lit(float(x)).cast("double")


def _config_column(metric: Column, configs: Mapping[str, S.MetricConfig]) -> Column:
    """Per-row metric config as a struct, from a literal map (no join)."""
    def st(c: S.MetricConfig) -> Column:
        return F.struct(_dbl(c.min_value).alias("lo"), _dbl(c.max_value).alias("hi"),
                        _dbl(c.zscore_threshold).alias("thr"),
                        _dbl(c.flatline_tolerance).alias("tol"),
                        F.lit(int(c.flatline_window)).alias("fw"))
    pairs = []
    for name, c in configs.items():
        pairs += [F.lit(name), st(c)]
    default = st(S.DEFAULT_METRIC_CONFIG)
    if not pairs:
        return default
    return F.coalesce(F.create_map(*pairs)[metric], default)


def _flat_windows(configs: Mapping[str, S.MetricConfig]) -> list[int]:
    return sorted({c.flatline_window for c in configs.values()} | {S.DEFAULT_METRIC_CONFIG.flatline_window})


def lookback(window: int, configs: Mapping[str, S.MetricConfig] | None = None) -> int:
    """Longest number of earlier rows any signal looks at."""
    cfgs = resolve_configs(configs)
    return max([window] + [fw - 1 for fw in _flat_windows(cfgs)])


def _signals(long: DataFrame, part_cols: list[str], order_cols: list[str], window: int,
             configs: Mapping[str, S.MetricConfig]) -> DataFrame:
    """Per (reading, metric) row: the three signal scores and four flags.

    ``long`` holds ``metric``/``value`` (value null for metric-less readings).
    All frames share one partition/order spec, so Spark plans one Window.
    """
    w = Window.partitionBy(*part_cols).orderBy(*order_cols)
    prev = w.rowsBetween(-window, -1)
    v = F.col("value")
    cols = {
        "_cfg": _config_column(F.col("metric"), configs),
        "_n": F.count(v).over(prev),
        "_mean": F.avg(v).over(prev),
        "_std": F.stddev_pop(v).over(prev),
    }
    for fw in _flat_windows(configs):
        fr = w.rowsBetween(-(fw - 1), 0)
        cols[f"_fn{fw}"] = F.count(v).over(fr)
        cols[f"_fspan{fw}"] = F.max(v).over(fr) - F.min(v).over(fr)
    df = long.withColumns(cols)

    cfg = F.col("_cfg")
    lo, hi, thr, tol, fw = (cfg["lo"], cfg["hi"], cfg["thr"], cfg["tol"], cfg["fw"])
    dev = F.abs(v - F.col("_mean"))
    z = (F.when(F.col("_n") >= S.ZSCORE_MIN_VALUES,
                F.when(F.col("_std") < S.ZERO_STD, dev).otherwise(dev / F.col("_std"))))
    below = lo.isNotNull() & (v < lo)
    above = hi.isNotNull() & (v > hi)
    spike = z > thr * S.SPIKE_FACTOR
    drift = ~spike & (z > thr)
    flat_terms = [(fw == f) & (F.col(f"_fn{f}") >= f) & (F.col(f"_fspan{f}") < tol)
                  for f in _flat_windows(configs) if f <= window]
    flat = F.lit(False)
    for t in flat_terms:
        flat = flat | t
    flat = F.coalesce(flat, F.lit(False))
    return df.select(
        *[c for c in long.columns if c not in ("metric", "value")],
        F.when(below, S.OUT_OF_RANGE_LOW_SCORE).when(above, S.OUT_OF_RANGE_HIGH_SCORE)
         .alias("_s_range"),
        F.when(spike, F.least(F.lit(1.0), z / (thr * S.SPIKE_SCALE)))
         .when(drift, F.least(F.lit(S.DRIFT_CAP), z / (thr * S.DRIFT_SCALE))).alias("_s_z"),
        F.when(flat, F.lit(S.FLATLINE_SCORE)).alias("_s_flat"),
        F.coalesce(below | above, F.lit(False)).alias("_f_range"),
        F.coalesce(spike, F.lit(False)).alias("_f_spike"),
        F.coalesce(drift, F.lit(False)).alias("_f_drift"),
        flat.alias("_f_flat"),
    )


def _per_reading(sig: DataFrame, keys: list[str]) -> DataFrame:
    """OP-28: max signal over all metrics of a reading, distinct flags."""
    agg = sig.groupBy(*keys).agg(
        F.max(F.greatest(*[F.col(c) for c in SIGNAL_COLUMNS])).alias("_score"),
        *[F.bool_or(c).alias(c) for c in FLAG_BOOL_COLUMNS.values()])
    flags = F.array_compact(F.array(*[F.when(F.col(c), F.lit(name))
                                      for name, c in sorted(FLAG_BOOL_COLUMNS.items())]))
    return agg.select(*keys,
                      F.round(F.coalesce(F.col("_score"), F.lit(0.0)), S.SCORE_DIGITS)
                       .alias("anomaly_score"),
                      flags.alias("anomaly_flags"))


def _explode_metrics(narrow: DataFrame) -> DataFrame:
    # Outer explode keeps metric-less readings (metric and value null); they
    # score 0.0 with no flags and need no join back. A null value gets a null
    # metric name, so it never enters a metric's row frames (frames count
    # non-null values only) -- without an interpreted map_filter lambda.
    e = narrow.select("machine_id", "seq", F.explode_outer("metrics").alias("_k", "value"))
    return e.select("machine_id", "seq",
                    F.when(F.col("value").isNotNull(), F.col("_k")).alias("metric"), "value")


SEGMENT_ROWS = 4_000_000
#: Most segments of one machine in a block, where a block is wider than a segment.
BLOCK_SEGMENTS = 4096


def block_width(segment_rows: int) -> int:
    """How many consecutive numbers a block has."""
    return max(segment_rows, min(SEGMENT_ROWS, segment_rows * BLOCK_SEGMENTS))


def _tails(narrow: DataFrame, keep: int) -> DataFrame:
    """Per block (``_m``, ``_block``) the values its segments are handed: ``_carry``, an array of (segment,
    metric, values in order). Blocks that are handed nothing have no row."""
    segment, sequence = ["_m", "_block", "_segment"], ["_m", "metric"]
    # Outer, so that no filter goes below the first exchange, which the frames share.
    values = narrow.select(*segment, "seq", F.explode_outer("metrics").alias("metric", "value")).filter(
        F.col("value").isNotNull())
    newest = Window.partitionBy(*segment, "metric").orderBy(F.desc("seq"))
    last = values.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= keep)
    tails = last.groupBy(*segment, "metric").agg(
        F.sort_array(F.collect_list(F.struct("seq", "value")))["value"].alias("_tail"))
    before = Window.partitionBy(*sequence).orderBy("_block", "_segment").rowsBetween(-keep, -1)
    handed = F.flatten(F.collect_list("_tail").over(before))
    handed = tails.select(*segment, "metric", handed.alias("_all")).filter(F.size("_all") > 0)
    handed = handed.withColumn("values", F.slice("_all", F.greatest(F.lit(1), F.size("_all") - keep + 1), F.lit(keep)))
    return handed.groupBy("_m", "_block").agg(F.collect_list(F.struct("_segment", "metric", "values")).alias("_carry"))


def _handed_on(narrow: DataFrame, tails: DataFrame) -> DataFrame:
    """Long rows of each segment: (``_now`` false) what it is handed, then its own values. A reading without
    values keeps one row with null metric."""
    r, t = narrow.alias("r"), tails.alias("t")
    # Only the first row of a block meets what the block's segments are handed.
    rows = r.join(t, (F.col("r._m") == F.col("t._m")) & (F.col("r._block") == F.col("t._block")) & F.col("r._first"), "left").select(
        *(F.col(f"r.{c}") for c in narrow.columns), "t._carry")
    entry = "array<struct<_segment:bigint,seq:bigint,metric:string,value:double,_now:boolean,_at:bigint>>"

    def at(metric: Column, value: Column) -> Column:
        return F.struct(F.col("_segment"), F.col("seq"), metric.alias("metric"), value.alias("value"),
                        F.lit(True).alias("_now"), F.col("seq").alias("_at"))

    own = F.transform(F.map_entries("metrics"), lambda e: at(F.when(e["value"].isNotNull(), e["key"]), e["value"]))
    none = F.array(at(F.lit(None).cast("string"), F.lit(None).cast("double")))
    own = F.when(F.size("metrics") > 0, own.cast(entry)).otherwise(none.cast(entry))
    handed = F.flatten(F.transform("_carry", lambda c: F.transform(c["values"], lambda v, i: F.struct(
        c["_segment"].alias("_segment"), F.lit(None).cast("long").alias("seq"), c["metric"].alias("metric"),
        v.alias("value"), F.lit(False).alias("_now"), i.cast("long").alias("_at")))))
    both = F.when(F.col("_carry").isNotNull(), F.concat(handed.cast(entry), own)).otherwise(own)
    return rows.select("_m", "_block", F.inline(both))


def score(readings: DataFrame, window: int = S.DEFAULT_WINDOW,
          configs: Mapping[str, S.MetricConfig] | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Score readings -> ``(machine_id, seq, anomaly_score, anomaly_flags)``.

    ``readings`` needs ``machine_id``, a unique ``seq`` and ``metrics``. ``segment_rows``: most rows that
    one window task holds of a machine."""
    cfgs = resolve_configs(configs)
    # Not null, so that no join or filter treats null machines apart, and enough to give the machine back.
    named = F.coalesce(F.concat(F.lit("m"), F.col("machine_id")), F.lit("null"))
    block = F.coalesce(F.floor(F.col("seq") / block_width(segment_rows)), F.lit(0).cast("long"))
    narrow = readings.select(named.alias("_m"), block.alias("_block"), "seq",
                             F.col("metrics").cast("map<string,double>").alias("metrics")).repartition("_m", "_block")
    order = Window.partitionBy("_m", "_block").orderBy("seq")
    # By rank, so that rows that share a number share a segment.
    narrow = narrow.withColumns({"_segment": F.floor((F.rank().over(order) - 1) / segment_rows),
                                 "_first": F.row_number().over(order) == 1})
    long = _handed_on(narrow, _tails(narrow, lookback(window, cfgs)))
    segment = ["_m", "_block", "_segment"]
    signals = _signals(long, [*segment, "metric"], ["_now", "_at"], window, cfgs)
    scored = _per_reading(signals.filter("_now").drop("_now", "_at"), [*segment, "seq"])
    machine = F.when(F.col("_m") != "null", F.substring("_m", F.lit(2), F.length("_m")))
    return scored.select(machine.alias("machine_id"), "seq", "anomaly_score", "anomaly_flags")


def annotate(readings: DataFrame, window: int = S.DEFAULT_WINDOW,
             configs: Mapping[str, S.MetricConfig] | None = None,
             detector_version: str = S.DEFAULT_DETECTOR_VERSION, **plan) -> DataFrame:
    """OP-29: replace score and flags of full readings, stamp the detector.

    Scoring runs on the narrow projection; the result is joined back on the
    unique ``(machine_id, seq)`` so wide columns (raw payload) are neither
    copied per metric nor sorted by the window.
    """
    scored = score(readings, window, configs, **plan)
    cols = [c for c in readings.columns
            if c not in ("anomaly_score", "anomaly_flags", "detector_version")]
    scored = scored.select(F.col("machine_id").alias("_machine"), F.col("seq").alias("_seq"),
                           "anomaly_score", "anomaly_flags")
    return (readings.select(*cols)
            .join(scored, (F.col("seq") == F.col("_seq")) & F.col("machine_id").eqNullSafe(F.col("_machine")))
            .withColumn("detector_version", F.lit(detector_version))
            .select(*[c for c in S.READING_COLUMNS if c in cols
                      or c in ("anomaly_score", "anomaly_flags", "detector_version")],
                    *[c for c in cols if c not in S.READING_COLUMNS]))


def active_machines(readings: DataFrame) -> DataFrame:
    """OP-30: distinct machines that have a detector (= were seen)."""
    return readings.select("machine_id").distinct()


def is_anomalous(threshold: float = S.ANOMALY_THRESHOLD) -> Column:
    """OP-16: score >= threshold (the reading-level predicate)."""
    return F.col("anomaly_score") >= F.lit(float(threshold))


def has_flags() -> Column:
    """OP-16 variant used by the store and counters: flags non-empty."""
    return F.size(F.coalesce(F.col("anomaly_flags"), F.array().cast("array<string>"))) > 0
