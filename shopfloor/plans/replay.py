"""Replay (OP-39, OP-48): re-score stored readings with fresh detector state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.operators.score import annotate, has_flags
from shopfloor.plans.queries import readings_between
from shopfloor.sinks.stores import write_event_log


def replay_readings(store: DataFrame, machine_id: str | None = None, since=None, until=None,
                    limit: int | None = None, window: int = S.DEFAULT_WINDOW, configs=None,
                    detector_version: str = S.REPLAY_DETECTOR_VERSION,
                    pipeline_version: str = S.REPLAY_PIPELINE_VERSION,
                    retention: int | None = None, **plan) -> DataFrame:
    """Select (machine / since / until, both inclusive), keep the *first*
    ``limit`` in append order, reset score and flags, stamp versions and
    re-score with state built only from the selected rows.

    The filter runs before the window (pushed to the scan). ``retention``
    reproduces a store that only remembers each machine's newest N rows
    when a machine is given (the reference keeps 500); default off.
    """
    sel = readings_between(store, machine_id, since, until)
    if machine_id and retention is not None:
        sel = sel.orderBy(F.desc("seq")).limit(retention)
    if limit is not None:
        sel = sel.orderBy("seq").limit(limit)
    sel = sel.withColumns({"anomaly_score": F.lit(0.0),
                           "anomaly_flags": F.array().cast("array<string>"),
                           "pipeline_version": F.lit(pipeline_version)})
    return annotate(sel, window, configs, detector_version, **plan)


def replay_summary(replayed: DataFrame, machine_id: str | None = None,
                   detector_version: str = S.REPLAY_DETECTOR_VERSION,
                   output_path: str | None = None, exported: bool = False) -> DataFrame:
    """One row: replayed, anomalies (flags non-empty), echo of the request,
    exported count (= replayed when written)."""
    return replayed.agg(
        F.count(F.lit(1)).alias("replayed"),
        F.count_if(has_flags()).cast("long").alias("anomalies"),
    ).select("replayed", "anomalies",
             F.lit(machine_id).cast("string").alias("machine_id"),
             F.lit(detector_version).alias("detector_version"),
             F.lit(output_path).cast("string").alias("output_path"),
             (F.col("replayed") if exported else F.lit(0).cast("long")).alias("exported"))


def replay(store: DataFrame, output_path: str | None = None, **kw) -> DataFrame:
    """Run a replay; export JSONL (overwrite) when ``output_path`` is given;
    return the summary row. The replayed rows are persisted once so export
    and summary do not recompute the window."""
    dv = kw.get("detector_version", S.REPLAY_DETECTOR_VERSION)
    out = replay_readings(store, **kw)
    if output_path is None:
        return replay_summary(out, kw.get("machine_id"), dv)
    out = out.persist()
    write_event_log(out, output_path, mode="overwrite")
    summary = replay_summary(out, kw.get("machine_id"), dv, output_path, exported=True)
    return summary
