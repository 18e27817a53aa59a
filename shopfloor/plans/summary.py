"""Figures of the store kept up to date batch by batch (OP-31, 32, 33, 46), without reading the store.

Each micro-batch leaves one row per (machine, protocol): how many readings it stored, how many of them are
flagged, and the last one in append order. These are partial aggregates: adding up the counts and taking the
latest of the latest gives the figures of the whole store, in any order of batches. A batch's rows are its
own partition, which a retry replaces, so late and retried batches give the same figures. Their number
depends on machines and batches, not on readings; :func:`fold` joins old batches into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.functions.timefmt import iso_text
from shopfloor.operators.score import has_flags

SCHEMA = ("machine_id string, source_protocol string, readings long, flagged long, "
          "latest struct<batch_id:long,seq:long,event_id:string,plant_id:string,line_id:string,source_protocol:string,"
          "status:string,timestamp:timestamp>, batch_id long")


def batch_summary(stored: DataFrame, batch_id: int) -> DataFrame:
    """Rows of one batch's stored readings."""
    last = F.struct(F.lit(batch_id).cast("long").alias("batch_id"), "seq", "event_id", "plant_id", "line_id",
                    "source_protocol", "status", "timestamp")
    return stored.groupBy("machine_id", "source_protocol").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(has_flags()).alias("flagged"), F.max_by(last, "seq").alias("latest"))


def write_summary(stored: DataFrame, batch_id: int, path: str) -> None:
    (batch_summary(stored, batch_id).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def _latest(kept: DataFrame, *keys: str) -> DataFrame:
    return kept.groupBy(*keys).agg(
        F.sum("readings").alias("readings"), F.sum("flagged").alias("flagged"),
        F.max_by("latest", F.struct("latest.batch_id", "latest.seq")).alias("latest"))


def fold(kept: DataFrame) -> DataFrame:
    """One row per (machine, protocol) that stands for all batches in ``kept``."""
    return _latest(kept, "machine_id", "source_protocol")


def pipeline_stats(kept: DataFrame) -> DataFrame:
    """OP-31, as :func:`shopfloor.plans.queries.pipeline_stats` gives it for the store."""
    return kept.agg(
        F.coalesce(F.sum("readings"), F.lit(0)).alias("total_readings"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("total_anomalies"),
        F.count_distinct("machine_id").alias("active_machines"),
        F.max_by("latest.event_id", F.struct("latest.batch_id", "latest.seq")).alias("last_event_id"))


def protocol_counts(kept: DataFrame) -> DataFrame:
    """OP-32."""
    return kept.groupBy("source_protocol").agg(F.sum("readings").alias("readings"))


def machine_list(kept: DataFrame) -> DataFrame:
    """OP-33."""
    return _latest(kept, "machine_id").select(
        "machine_id", "latest.plant_id", "latest.line_id", F.col("latest.source_protocol").alias("protocol"),
        "latest.status", iso_text(F.col("latest.timestamp")).alias("last_seen"),
        F.col("readings").alias("reading_count"), "latest.event_id").orderBy("machine_id")


def counts(kept: DataFrame) -> DataFrame:
    """machine_id, source_protocol, n and flagged, from which :func:`shopfloor.plans.queries.metrics_view`
    makes its figures."""
    return kept.groupBy("machine_id", "source_protocol").agg(F.sum("readings").alias("n"), F.sum("flagged").alias("flagged"))
