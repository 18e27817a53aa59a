"""Operational queries over the reading store (OP-16..18, 31..36, 38, 43..46).

The store is any DataFrame with the canonical reading columns and a unique
``seq`` (append order). Per-machine top-N uses ``row_number() <= n``, which
Spark plans as a ``WindowGroupLimit`` before the shuffle, so even a machine
holding a third of all rows is cut to n rows per map task first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.functions.timefmt import between_inclusive, iso_text
from shopfloor.operators.score import has_flags, is_anomalous


def _ts(x) -> Column:
    return F.lit(x).cast("timestamp") if isinstance(x, dt.datetime) else F.to_timestamp(F.lit(x))


def flags_text(col: str = "anomaly_flags") -> Column:
    """Sorted flags as comma text ('' when none)."""
    return F.array_join(F.array_sort(F.coalesce(F.col(col), F.array().cast("array<string>"))), ",")


def public_view(readings: DataFrame) -> DataFrame:
    """OP-18: API shape -- no raw payload, timestamps as ISO text."""
    return readings.select(
        "event_id", "machine_id", "plant_id", "line_id", "source_protocol",
        iso_text(F.col("timestamp")).alias("timestamp"),
        iso_text(F.col("ingested_at")).alias("ingested_at"),
        F.map_filter("metrics", lambda k, v: v.isNotNull()).alias("metrics"),
        "status", "anomaly_score", "anomaly_flags", "pipeline_version", "detector_version",
        *([c for c in ("seq",) if c in readings.columns]))


def append_order(store: DataFrame) -> Column:
    """What the store's rows are ordered by: ``(batch_id, seq)`` if it has
    batches (several counters may feed one store), else ``seq``."""
    return F.struct("batch_id", "seq") if "batch_id" in store.columns else F.col("seq")


def anomalous(store: DataFrame, threshold: float = S.ANOMALY_THRESHOLD) -> DataFrame:
    """OP-16: readings with score >= threshold."""
    return store.filter(is_anomalous(threshold))


def pipeline_stats(store: DataFrame, anomaly_retention: int | None = None) -> DataFrame:
    """OP-31: one row -- totals, anomalies (flags non-empty), machines, last id.

    ``anomaly_retention`` caps the anomaly count the way a bounded in-memory
    index would (the reference keeps 1000); default uncapped."""
    n_anom = F.count_if(has_flags())
    if anomaly_retention is not None:
        n_anom = F.least(n_anom, F.lit(anomaly_retention))
    return store.agg(
        F.count(F.lit(1)).alias("total_readings"),
        n_anom.cast("long").alias("total_anomalies"),
        F.count_distinct("machine_id").alias("active_machines"),
        F.max_by(F.col("event_id"), append_order(store)).alias("last_event_id"))


def protocol_counts(store: DataFrame) -> DataFrame:
    """OP-32: readings per source protocol."""
    return store.groupBy("source_protocol").agg(F.count(F.lit(1)).alias("readings"))


def machine_list(store: DataFrame, retention: int | None = None) -> DataFrame:
    """OP-33: per machine the latest row by append order and the row count.

    ``max_by`` is a partial aggregate: each map task keeps one candidate per
    machine, so a hot machine costs no more shuffle than a cold one."""
    latest = F.max_by(F.struct("plant_id", "line_id", "source_protocol", "status",
                               "timestamp", "event_id"), append_order(store))
    n = F.count(F.lit(1))
    if retention is not None:
        n = F.least(n, F.lit(retention))
    return (store.groupBy("machine_id")
            .agg(latest.alias("_l"), n.cast("long").alias("reading_count"))
            .select("machine_id", F.col("_l.plant_id").alias("plant_id"),
                    F.col("_l.line_id").alias("line_id"),
                    F.col("_l.source_protocol").alias("protocol"),
                    F.col("_l.status").alias("status"),
                    iso_text(F.col("_l.timestamp")).alias("last_seen"),
                    "reading_count", F.col("_l.event_id").alias("event_id"))
            .orderBy("machine_id"))


def recent_readings(store: DataFrame, limit: int = S.DEFAULT_QUERY_LIMIT,
                    machine_id: str | None = None) -> DataFrame:
    """OP-34: newest ``limit`` readings per machine by append order, newest
    first (``rank`` 1 = newest). One machine: a filter + top-N."""
    newest = append_order(store).desc()
    if machine_id is not None:
        return (store.filter(F.col("machine_id") == machine_id)
                .orderBy(newest).limit(limit)
                .withColumn("rank", F.row_number().over(Window.orderBy(newest))))
    w = Window.partitionBy("machine_id").orderBy(newest)
    return store.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def latest_reading(store: DataFrame, machine_id: str | None = None) -> DataFrame:
    """OP-35: the newest reading per machine (or of one machine)."""
    return recent_readings(store, 1, machine_id).drop("rank")


def recent_anomalies(store: DataFrame, limit: int = S.DEFAULT_QUERY_LIMIT,
                     min_score: float = 0.0,
                     retention: int | None = None) -> DataFrame:
    """OP-36: flagged readings with score >= ``min_score``, newest first, top
    ``limit`` (distributed top-N). ``retention`` limits the choice to the
    newest flagged readings, as a store that forgets older ones does."""
    newest = append_order(store).desc()
    flagged = store.filter(has_flags())
    if retention is not None:
        flagged = flagged.orderBy(newest).limit(retention)
    return (flagged.filter(F.col("anomaly_score") >= F.lit(float(min_score)))
            .orderBy(newest).limit(limit))


def readings_after(store: DataFrame, event_id: str | None = None,
                   limit: int = S.TAIL_PAGE) -> DataFrame:
    """OP-38: next ``limit`` readings after the cursor id in append order;
    unknown or absent id -> from the start. The cursor position is a scalar
    subquery (one value), not a join."""
    order = append_order(store)
    after = store
    if event_id is not None:
        start = store.filter(F.col("event_id") == event_id).agg(F.max(order)).scalar()
        after = store.filter(start.isNull() | (order > start))
    return after.orderBy(order).limit(limit)


def readings_between(store: DataFrame, machine_id: str | None = None,
                     since=None, until=None) -> DataFrame:
    """OP-17 (+ machine filter): both bounds inclusive, compared as instants."""
    out = store
    if machine_id:
        out = out.filter(F.col("machine_id") == machine_id)
    return out.filter(between_inclusive(F.col("timestamp"), since, until))


def sql_recent(store: DataFrame, machine_id: str | None = None,
               limit: int = S.SQL_RECENT_LIMIT) -> DataFrame:
    """OP-43: newest ``limit`` rows by event time (not append order) per
    machine; append order breaks timestamp ties."""
    if machine_id is not None:
        return (store.filter(F.col("machine_id") == machine_id)
                .orderBy(F.desc("timestamp"), append_order(store).desc()).limit(limit))
    w = Window.partitionBy("machine_id").orderBy(F.desc("timestamp"), append_order(store).desc())
    return store.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def sql_anomalies(store: DataFrame, as_of, threshold: float = S.ANOMALY_THRESHOLD,
                  hours: int = 1, limit: int = S.SQL_ANOMALY_LIMIT) -> DataFrame:
    """OP-44: score >= threshold within the ``hours`` before ``as_of``
    (exclusive start), highest score first, then newest; top ``limit``."""
    start = _ts(as_of) - F.make_interval(hours=F.lit(hours))
    return (store.filter(is_anomalous(threshold) & (F.col("timestamp") > start))
            .orderBy(F.desc("anomaly_score"), F.desc("timestamp"), append_order(store).desc()).limit(limit))


def points_pivot(points: DataFrame, as_of, hours: int = 1,
                 machine_id: str | None = None, fields: list[str] | None = None) -> DataFrame:
    """OP-45: long points (one row per field) of the last ``hours`` pivoted
    to one row per event. ``fields`` fixes the pivot columns (no extra
    distinct pass; default = the numeric metric fields); the values of all
    other fields are kept in the map ``extra_fields``."""
    start = _ts(as_of) - F.make_interval(hours=F.lit(hours))
    p = points.filter((F.col("time") >= start) & (F.col("time") <= _ts(as_of)))
    if machine_id is not None:
        p = p.filter(F.col("machine_id") == machine_id)
    names = fields or list(S.METRIC_COLUMNS) + ["anomaly_score"]
    values = [F.max(F.when(F.col("field") == n, F.col("value"))).alias(n) for n in names]
    others = F.collect_set(F.when(~F.col("field").isin(names), F.struct("field", "value")))
    return (p.groupBy("event_id", "machine_id", "time")
            .agg(*values, F.map_from_entries(others).alias("extra_fields")))


def reading_counts(store: DataFrame) -> DataFrame:
    """Readings (n) and flagged ones per machine and protocol."""
    return store.groupBy("machine_id", "source_protocol").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(has_flags()).alias("flagged"))


def metrics_view(store: DataFrame | None, duplicates: int | None = None, failed: int | None = None,
                 accounting: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """OP-46: operational figures as tall ``(metric, protocol, value)`` rows.

    Duplicates and failed events come from the per-batch accounting rows when
    given (the worker's counters), else from the literals. The store is read
    once: counts per machine and protocol, rolled up to totals and protocols;
    an empty store gives zeros. With ``counts``
    (:func:`shopfloor.plans.summary.counts`) it isn't read at all."""
    counts = reading_counts(store) if counts is None else counts
    session = counts.sparkSession
    none = session.range(1).select(F.lit(None).cast("string").alias("machine_id"), F.lit(None).cast("string").alias(
        "source_protocol"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("flagged"))
    rolled = counts.unionByName(none).rollup("source_protocol").agg(
        F.grouping("source_protocol").alias("is_total"), F.sum("n").alias("n"),
        F.sum("flagged").alias("flagged"), F.count_distinct("machine_id").alias("machines"))
    rolled = rolled.filter((F.col("is_total") == 1) | (F.col("n") > 0))

    def figure(name: str, value: Column, protocol: Column = F.lit("")) -> Column:
        return F.struct(F.lit(name).alias("metric"), protocol.alias("protocol"), value.cast("double").alias("value"))
    of_store = rolled.select(F.explode(F.when(F.col("is_total") == 1, F.array(
        figure("total_readings", F.col("n")), figure("total_anomalies", F.col("flagged")),
        figure("active_machines", F.col("machines"))))
        .otherwise(F.array(figure("readings_per_protocol", F.col("n"), F.col("source_protocol"))))).alias("m")).select("m.*")
    if accounting is not None:
        work = accounting.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("duplicates", "failed")])
    else:
        work = session.range(1).select(F.lit(duplicates or 0).alias("duplicates"), F.lit(failed or 0).alias("failed"))
    of_work = work.select(F.explode(F.array(figure("total_duplicates", F.col("duplicates")),
                                            figure("failed_events", F.col("failed")))).alias("m")).select("m.*")
    return of_store.unionByName(of_work)
