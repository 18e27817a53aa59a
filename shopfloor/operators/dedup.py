"""Event-id de-duplication and stamping (OP-13, OP-14, OP-05)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.functions.eventid import ensure_event_id

ID_COLUMNS = ("machine_id", "plant_id", "line_id", "source_protocol", "timestamp", "metrics", "status")


def first_arrivals(batch: DataFrame, stored_ids: DataFrame | None = None) -> DataFrame:
    """OP-13: keep the first arrival (lowest ``seq``) of every ``event_id``,
    and drop ids already stored.

    Plan: one aggregate, ``min_by(row, seq)`` per id. It is combined
    map-side, so a flood of copies of one id (a third of all rows, say)
    shrinks to one candidate per task before the single shuffle, and the
    input is evaluated once. A window ``row_number`` would pull all copies of
    an id into one task; a min(seq) + semi-join would evaluate the input
    twice.

    An empty or missing id is filled from the reading's content first; a row
    that still has none (the content columns are missing) is nobody's copy
    and is kept: it goes by its ``seq``.
    """
    cols = batch.columns
    if set(ID_COLUMNS) <= set(cols):
        batch = batch.withColumn("event_id", ensure_event_id())
    key = F.coalesce(F.col("event_id"), F.concat(F.lit("seq "), F.col("seq").cast("string")))
    kept = batch.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*cols), F.col("seq")).alias("_first"))
    if stored_ids is not None:
        stored = stored_ids.select(F.col("event_id").alias("_key")).distinct()
        kept = kept.join(stored, "_key", "left_anti")
    return kept.select(*[F.col(f"_first.{c}").alias(c) for c in cols])


def duplicates(batch: DataFrame, stored_ids: DataFrame | None = None) -> DataFrame:
    """Arrivals rejected by :func:`first_arrivals` (later copies, or stored)."""
    keep = first_arrivals(batch, stored_ids).select("event_id", "seq")
    return batch.join(keep, ["event_id", "seq"], "left_anti").select(*batch.columns)


def stamp(readings: DataFrame, ingested_at: dt.datetime | None = None,
          pipeline_version: str = S.DEFAULT_PIPELINE_VERSION) -> DataFrame:
    """OP-14: set ``ingested_at`` and ``pipeline_version``.

    The batch start time is passed in as a literal so a re-run of the same
    batch gives identical rows; without it the batch's current time is used.
    """
    ts = F.lit(ingested_at).cast("timestamp") if ingested_at is not None else F.current_timestamp()
    return readings.withColumns({"ingested_at": ts, "pipeline_version": F.lit(pipeline_version)})


def manual_ingest(readings: DataFrame, ingested_at: dt.datetime | None = None,
                  detector_version: str = S.DEFAULT_DETECTOR_VERSION) -> DataFrame:
    """OP-05: accept already-scored readings as they are: default pipeline
    version ``manual-ingest``, default detector version and ingest time, no
    scoring. Rows that break the domains get an ``error`` text (the
    reference rejects them); dedup against the store is the caller's
    :func:`first_arrivals`."""
    now = F.lit(ingested_at).cast("timestamp") if ingested_at is not None else F.current_timestamp()
    out = readings.withColumns({
        "event_id": ensure_event_id(),
        "pipeline_version": F.coalesce(F.nullif(F.col("pipeline_version"), F.lit("")),
                                       F.lit(S.MANUAL_INGEST_PIPELINE_VERSION)),
        "detector_version": F.coalesce(F.nullif(F.col("detector_version"), F.lit("")),
                                       F.lit(detector_version)),
        "ingested_at": F.coalesce(F.col("ingested_at"), now),
        "anomaly_score": F.coalesce(F.col("anomaly_score"), F.lit(0.0)),
        "anomaly_flags": F.coalesce(F.col("anomaly_flags"), F.array().cast("array<string>")),
        "status": F.coalesce(F.col("status"), F.lit("unknown")),
        # canonical metric maps hold no null values
        "metrics": F.map_filter(F.coalesce(F.col("metrics"), F.create_map().cast("map<string,double>")),
                                lambda k, v: v.isNotNull()),
    })
    return out.withColumn("error", domain_errors())


def domain_errors():
    """Text naming the first violated domain rule, or null."""
    flags_ok = F.forall(F.col("anomaly_flags"), lambda f: f.isin(*S.FLAGS))
    return (F.when(F.col("machine_id").isNull(), F.lit("machine_id missing"))
            .when(~F.col("source_protocol").isin(*S.PROTOCOLS), F.lit("bad source_protocol"))
            .when(~F.col("status").isin(*S.STATUSES), F.lit("bad status"))
            .when((F.col("anomaly_score") < 0) | (F.col("anomaly_score") > 1),
                  F.lit("anomaly_score outside [0, 1]"))
            .when(~flags_ok, F.lit("bad anomaly flag"))
            .when(F.col("timestamp").isNull(), F.lit("timestamp missing")))
