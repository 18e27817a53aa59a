"""Streaming scoring (OP-29 on a stream) with the batch plan's own expressions.

A row-count frame over arrival order is not an event-time window. Each
micro-batch is scored together with the last values of every (machine,
metric) that earlier batches left in the tail table: the tail rows come first
in each sequence, the same window frames run over both, and only the batch's
rows are returned. The new tail -- the last ``lookback`` values of each
sequence, so its size depends on the number of sequences alone -- is written
to the batch's own ``batch_id`` folder. A retried batch reads the tail of the
batch before it again and replaces its own, so it gives the same rows.

Readings are the stored order's ``seq``, rising from batch to batch. Rows with
a non-null ``error`` are returned unscored and don't enter a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.operators.score import (
    _explode_metrics,
    _per_reading,
    _signals,
    lookback,
    resolve_configs,
)
from shopfloor.sinks.stores import read_or_none


def _tail_before(spark, path: str, batch_id: int) -> DataFrame | None:
    """Tail rows that the latest earlier batch has left; folder names alone are looked at for that."""
    table = read_or_none(spark, path, "machine_id string, metric string, seq long, value double, batch_id long")
    if table is None:
        return None
    table = table.filter(F.col("batch_id") < batch_id)
    latest = table.agg(F.max("batch_id")).first()[0]
    return None if latest is None else table.filter(F.col("batch_id") == latest)


def score_batch(batch: DataFrame, batch_id: int, tail_path: str, window: int = S.DEFAULT_WINDOW,
                configs=None, detector_version: str = S.DEFAULT_DETECTOR_VERSION) -> DataFrame:
    """One micro-batch of readings -> the same readings scored; writes the new tail."""
    cfgs = resolve_configs(configs)
    keep = lookback(window, cfgs)
    is_error = F.col("error").isNotNull() if "error" in batch.columns else F.lit(False)
    long = _explode_metrics(batch.filter(~is_error)).withColumn("_now", F.lit(True))
    tail = _tail_before(batch.sparkSession, tail_path, batch_id)
    if tail is not None:
        long = long.unionByName(tail.select("machine_id", "seq", "metric", "value").withColumn("_now", F.lit(False)))
    key = ["machine_id", "metric"]
    newest = Window.partitionBy(*key).orderBy(F.desc("seq"))
    kept = (long.filter(F.col("metric").isNotNull()).withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") <= keep).select(*key, "seq", "value"))
    (kept.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(tail_path))
    signals = _signals(long, key, ["seq"], window, cfgs).filter("_now").drop("_now")
    scored = _per_reading(signals, ["machine_id", "seq"]).select(
        F.col("machine_id").alias("_machine"), F.col("seq").alias("_seq"),
        F.col("anomaly_score").alias("_score"), F.col("anomaly_flags").alias("_flags"))
    cols = batch.columns
    joined = batch.join(scored, (F.col("seq") == F.col("_seq"))
                        & F.col("machine_id").eqNullSafe(F.col("_machine")), "left")
    new = {"anomaly_score": F.coalesce("_score", F.lit(0.0)),
           "anomaly_flags": F.coalesce("_flags", F.array().cast("array<string>")),
           "detector_version": F.lit(detector_version)}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in cols],
                         *[v.alias(c) for c, v in new.items() if c not in cols])
