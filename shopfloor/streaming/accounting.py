"""Ingest accounting (OP-37): per micro-batch counters as rows.

Counters are rows keyed by batch id, not driver-side variables, so a
retried batch rewrites its own row (idempotent) and totals are a ``sum``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.functions.eventid import ensure_event_id
from shopfloor.operators.dedup import ID_COLUMNS
from shopfloor.operators.score import has_flags


def _optional(df: DataFrame, name: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast("string")


def batch_accounting(arrivals: DataFrame, stored_ids: DataFrame | None = None,
                     batch_col: str = "batch_id", kept: DataFrame | None = None) -> DataFrame:
    """One row per batch: received, processed (first seen), duplicates,
    anomalies among processed (flags non-empty), processed per protocol, the
    true last processed event id (by seq) with its versions, and the failed
    rows (``error`` not null) with the last error text; failed rows are not
    received readings. ``kept`` = the first arrivals when already computed
    (else derived from ``stored_ids``).

    Plan without ``kept``: the input is evaluated once, on narrow columns;
    copies of an id shrink to one row per batch before the ids meet."""
    content = set(ID_COLUMNS) <= set(arrivals.columns)
    error = _optional(arrivals, "error")
    rows = arrivals.select(
        F.col(batch_col).alias("_batch"), "seq", "source_protocol", has_flags().alias("_flagged"),
        (ensure_event_id() if content else F.col("event_id")).alias("event_id"),
        _optional(arrivals, "pipeline_version").alias("pipeline_version"),
        _optional(arrivals, "detector_version").alias("detector_version"), error.alias("_error"))
    first = F.struct("seq", "event_id", "source_protocol", "_flagged", "pipeline_version", "detector_version")
    if kept is not None:
        new = kept.select(F.col("seq").alias("_kept"))
        tagged = rows.join(new, F.col("seq") == F.col("_kept"), "left").select(
            "_batch", F.lit(1).alias("_n"), "_error", first.alias("_first"), F.col("_kept").isNotNull().alias("_is_first"))
    else:
        # a failed row, or one without an id, is nobody's copy
        known = F.col("_error").isNull() & F.col("event_id").isNotNull()
        alone = F.when(~known, F.col("seq"))
        per_id = rows.groupBy("_batch", F.when(known, F.col("event_id")).alias("_id"), alone.alias("_alone"), "_error").agg(
            F.count(F.lit(1)).alias("_n"), F.min_by(first, "seq").alias("_first"))
        earliest = F.min("_first.seq").over(Window.partitionBy("_id", "_alone"))
        tagged = per_id.withColumn("_is_first", F.col("_first.seq") == earliest)
        if stored_ids is not None:
            stored = stored_ids.select(F.col("event_id").alias("_stored")).distinct()
            tagged = (tagged.join(stored, F.col("_id") == F.col("_stored"), "left")
                      .withColumn("_is_first", F.col("_is_first") & F.col("_stored").isNull()))
    good = F.col("_error").isNull()
    new, n = good & F.col("_is_first"), F.col("_n")
    last = F.max_by(F.when(new, F.col("_first")), F.when(new, F.col("_first.seq")))
    per_proto = [F.count_if(new & (F.col("_first.source_protocol") == p)).cast("long").alias(p)
                 for p in S.PROTOCOLS]

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")
    return (tagged.groupBy(F.col("_batch").alias(batch_col)).agg(
        total(F.when(good, n)).alias("received"),
        F.count_if(new).cast("long").alias("processed"),
        total(F.when(good, n - new.cast("long"))).alias("duplicates"),
        F.count_if(new & F.col("_first._flagged")).cast("long").alias("anomalies"),
        *per_proto,
        total(F.when(~good, n)).alias("failed"),
        F.max_by("_error", F.when(~good, F.col("_first.seq"))).alias("last_error"),
        last.alias("_last"))
        .select("*", "_last.event_id", "_last.pipeline_version", "_last.detector_version")
        .withColumnRenamed("event_id", "last_event_id").drop("_last"))


def totals(per_batch: DataFrame) -> DataFrame:
    """Running totals over all batch rows (one row)."""
    cols = ["received", "processed", "duplicates", "anomalies", "failed", *S.PROTOCOLS]
    return per_batch.agg(*[F.sum(c).cast("long").alias(f"total_{c}") for c in cols],
                         F.max_by("last_event_id",
                                  F.when(F.col("processed") > 0, F.col("batch_id")))
                         .alias("last_event_id"),
                         F.max_by("last_error", F.when(F.col("failed") > 0, F.col("batch_id")))
                         .alias("last_error"))
