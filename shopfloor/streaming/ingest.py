"""Live ingest as a Structured Streaming job (OP-13, 14, 29, 37, 42, 47, 49).

``readStream`` (landed raw messages or canonical readings) -> normalize ->
stamp -> ``foreachBatch``, which scores with the tail of earlier batches, then:

1. persist the batch if more than the dedup reads it, and the first arrivals (several sinks read them);
2. first arrivals: dedup inside the batch and against ids stored by earlier
   batches;
3. write the accounting row, the point lines, the JSONL log lines and, last,
   the store rows (Parquet, ``seq`` kept) -- each into this batch's own
   ``batch_id`` partition with dynamic partition overwrite, plus the wide
   table (anti-join on id).

A lost executor or a failed batch makes Spark re-run the batch from the
checkpoint; because every output of a batch replaces its own partition and
dedup ignores the batch's own earlier attempt, the retry produces the same
rows and counts as an uninterrupted run.

Errors fail the batch and Spark retries it from the checkpoint instead of
swallowing them; the dedup in step 2 makes the retry idempotent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.operators.dedup import first_arrivals, stamp
from shopfloor.plans.summary import write_summary
from shopfloor.sinks import stores
from shopfloor.streaming.accounting import batch_accounting
from shopfloor.streaming.stateful import score_batch


def _stored_ids(spark: SparkSession, store_path: str, batch_id: int,
                since_date=None) -> DataFrame | None:
    """Ids stored by *earlier* batches. The store is partitioned by
    ``batch_id``; excluding this batch's own partition makes a retried batch
    see exactly what its first attempt saw (partition pruning, no scan)."""
    st = stores.read_or_none(spark, store_path, "event_id string, timestamp timestamp, batch_id long")
    if st is None:
        return None
    st = st.filter(F.col("batch_id") < F.lit(batch_id))
    if since_date is not None:
        # Only recent event dates are compared when ids are known not to
        # re-arrive later than ``dedup_lookback_days`` (row-group pruning).
        st = st.filter(F.to_date("timestamp") >= F.lit(since_date))
    return st.select("event_id")


def _overwrite_batch(df: DataFrame, batch_id: int, path: str, fmt: str = "parquet") -> None:
    """Write one batch's rows into its own ``batch_id`` partition; a retry
    replaces that partition instead of appending a second copy."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").format(fmt).save(path))


def process_batch(batch: DataFrame, batch_id: int, store_path: str,
                  wide_path: str | None = None, points_path: str | None = None,
                  accounting_path: str | None = None,
                  dedup_lookback_days: int | None = None, log_path: str | None = None,
                  rejected_path: str | None = None, summary_path: str | None = None) -> None:
    """One micro-batch of scored readings -> store, sinks, accounting.

    Idempotent under retries: every output is this batch's own partition
    (dynamic overwrite) or an id-keyed anti-join, and dedup compares against
    earlier batches only."""
    spark = batch.sparkSession
    arrivals = batch
    again = accounting_path or dedup_lookback_days is not None or (rejected_path and "error" in batch.columns)
    if again:
        arrivals.persist()
    try:
        if "error" in batch.columns:
            # Dead letters (OP-15): kept in their own sink, never stored.
            if rejected_path:
                _overwrite_batch(batch.filter(F.col("error").isNotNull()), batch_id, rejected_path)
            batch = batch.filter(F.col("error").isNull()).drop("error")
        since = None
        if dedup_lookback_days is not None:
            lo = batch.agg(F.min(F.to_date("timestamp"))).first()[0]
            since = lo - dt.timedelta(days=dedup_lookback_days) if lo else None
        stored = _stored_ids(spark, store_path, batch_id, since)
        fresh = first_arrivals(batch, stored).persist()
        if accounting_path:
            acc = batch_accounting(arrivals.withColumn("batch_id", F.lit(batch_id).cast("long")),
                                   batch_col="batch_id", kept=fresh).drop("batch_id")
            _overwrite_batch(acc, batch_id, accounting_path)
        if summary_path:
            write_summary(fresh, batch_id, summary_path)
        if wide_path:
            stores.write_wide_table(fresh, wide_path, dedup_lookback_days)
        if points_path:
            _overwrite_batch(stores.line_protocol(fresh), batch_id, points_path, "text")
        if log_path:
            _overwrite_batch(fresh.select(*stores.log_columns(fresh))
                             .sortWithinPartitions("seq"), batch_id, log_path, "json")
        # The store goes last: writing a path refreshes cached plans that
        # read it, and ``fresh`` was computed against the store's ids.
        _overwrite_batch(fresh.sortWithinPartitions("machine_id", "timestamp"), batch_id, store_path)
        fresh.unpersist()
    finally:
        if again:
            arrivals.unpersist()


def start_ingest(readings: DataFrame, checkpoint: str | None, store_path: str, *,
                 wide_path: str | None = None, points_path: str | None = None,
                 accounting_path: str | None = None, window: int = S.DEFAULT_WINDOW,
                 configs=None, pipeline_version: str = S.DEFAULT_PIPELINE_VERSION,
                 detector_version: str = S.DEFAULT_DETECTOR_VERSION,
                 ingested_at: dt.datetime | None = None, trigger: dict | None = None,
                 dedup_lookback_days: int | None = None, log_path: str | None = None,
                 rejected_path: str | None = None, summary_path: str | None = None):
    """Start the live pipeline on a streaming DataFrame of canonical readings
    (e.g. ``normalize_mqtt(read_raw(spark, "mqtt", path, stream=True))``;
    an ``error`` column marks rejects, which go to ``rejected_path``).

    Scoring runs before dedup (duplicates feed the rolling state, as in the
    live service). ``checkpoint`` must be a shared folder on a cluster.
    """
    if checkpoint is None:
        from shopfloor.session import checkpoint_dir
        name = store_path.rstrip("/").rsplit("/", 1)[-1]
        checkpoint = f"{checkpoint_dir(readings.sparkSession).rstrip('/')}/ingest-{name}"
    tail_path = f"{store_path.rstrip('/')}_tail"

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # scored, and read for the new tail
        try:
            scored = score_batch(batch, batch_id, tail_path, window, configs, detector_version)
            process_batch(scored, batch_id, store_path, wide_path, points_path, accounting_path,
                          dedup_lookback_days, log_path, rejected_path, summary_path)
        finally:
            batch.unpersist()

    stamped = stamp(readings, ingested_at, pipeline_version)
    writer = stamped.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def read_accounting_totals(spark: SparkSession, accounting_path: str) -> DataFrame:
    """OP-37 snapshot: totals over all batch rows."""
    from shopfloor.streaming.accounting import totals
    return totals(spark.read.parquet(accounting_path))
