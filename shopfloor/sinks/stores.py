"""Reading sinks and the JSONL event log (OP-04, 40..42, 47, 48).

* point shape (time-series store): tags + fields + time, and line-protocol text
* wide row shape (SQL store): the metric map as nine double columns
* line-protocol text read back into points
* wide table append: idempotent by ``event_id``, partitioned by event date and
  bucketed by id, so appending doesn't shuffle what is stored
* event log: one JSON object per line, keys sorted; read back with an exact
  append ``seq`` from file position
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shopfloor import schema as S
from shopfloor.functions.timefmt import iso_text
from shopfloor.operators.dedup import first_arrivals
from shopfloor.plans.queries import flags_text



# -- point store (OP-40) ---------------------------------------------------

def _tag(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(S.POINT_MISSING_TAG))


def to_points(readings: DataFrame) -> DataFrame:
    """OP-40: one point per reading -- measurement, tag map, field struct, time."""
    flags = flags_text()
    return readings.select(
        F.lit(S.POINT_MEASUREMENT).alias("measurement"),
        F.create_map(
            F.lit("event_id"), F.col("event_id"),
            F.lit("machine_id"), F.col("machine_id"),
            F.lit("plant_id"), _tag(F.col("plant_id")),
            F.lit("line_id"), _tag(F.col("line_id")),
            F.lit("protocol"), F.col("source_protocol"),
            F.lit("status"), F.col("status")).alias("tags"),
        F.map_filter("metrics", lambda k, v: v.isNotNull()).alias("metric_fields"),
        F.struct(F.col("anomaly_score").alias("anomaly_score"),
                 F.when(flags == "", F.lit(S.POINT_NO_FLAGS)).otherwise(flags)
                  .alias("anomaly_flags"),
                 F.col("pipeline_version").alias("pipeline_version"),
                 F.col("detector_version").alias("detector_version")).alias("fields"),
        F.col("timestamp").alias("time"))


def point_fields_long(readings: DataFrame) -> DataFrame:
    """Numeric point fields in long form ``(event_id, machine_id,
    time, field, value)``
    -- the shape a time-series store returns before a pivot (OP-45)."""
    entries = F.concat(
        F.map_entries(F.map_filter("metrics", lambda k, v: v.isNotNull())),
        F.array(F.struct(F.lit("anomaly_score").alias("key"),
                         F.col("anomaly_score").alias("value"))))
    return (readings.select("event_id", "machine_id", F.col("timestamp").alias("time"),
                            F.explode(entries).alias("e"))
            .select("event_id", "machine_id", "time", F.col("e.key").alias("field"),
                    F.col("e.value").alias("value")))


def _escaped(c: Column, special: str) -> Column:
    """A backslash before the special characters and before backslashes; a line end as backslash and n."""
    return F.replace(F.regexp_replace(c, rf"([{special}\\\\])", r"\\$1"), F.lit("\n"), F.lit("\\n"))


def _escape_tag(c: Column) -> Column:
    return _escaped(c, ",= ")


def line_protocol(readings: DataFrame) -> DataFrame:
    """OP-40 as text: ``measurement,tags fields time_ns`` (one line per point)."""
    p = to_points(readings)
    tag_txt = F.concat_ws(",", *[F.concat(F.lit(f"{t}="), _escape_tag(F.col("tags")[t])) for t in (
        "event_id", "machine_id", "plant_id", "line_id", "protocol", "status")])
    metric_txt = F.array_join(F.transform(
        F.array_sort(F.map_entries("metric_fields")),
        lambda e: F.concat(_escape_tag(e["key"]), F.lit("="), e["value"].cast("string"))), ",")
    q = lambda c: F.concat(F.lit('"'), _escaped(c, '"'), F.lit('"'))
    other = F.concat_ws(",",
                        F.concat(F.lit("anomaly_score="), F.col("fields.anomaly_score").cast("string")),
                        F.concat(F.lit("anomaly_flags="), q(F.col("fields.anomaly_flags"))),
                        F.concat(F.lit("pipeline_version="), q(F.col("fields.pipeline_version"))),
                        F.concat(F.lit("detector_version="), q(F.col("fields.detector_version"))))
    fields = F.when(metric_txt == "", other).otherwise(F.concat(metric_txt, F.lit(","), other))
    ns = (F.unix_micros(F.col("time")) * F.lit(1000)).cast("string")
    return p.select(F.concat(F.col("measurement"), F.lit(","), tag_txt, F.lit(" "), fields,
                             F.lit(" "), ns).alias("value"))


def write_points(readings: DataFrame, path: str, mode: str = "append") -> None:
    line_protocol(readings).write.mode(mode).text(path)


# Parts of a line; a backslash takes the next character along.
_LINE = r'^((?:[^ \\]++|\\.)++) ((?:[^ "\\]++|\\.|"(?:[^"\\]++|\\.)*+")++) (-?\d+)$'
_TAG = r"((?:[^,=\\]++|\\.)++)=((?:[^,\\]++|\\.)*+)"
_FIELD = r'((?:[^,=\\]++|\\.)++)=("(?:[^"\\]++|\\.)*+"|[^,]*+)'
_HELD = "\x00"  # stands for a backslash that was escaped
# Tags that can be split at commas and equals signs, as nothing is escaped in them.
_PLAIN_TAGS = r"^[^,=\\\x00]++=[^,\\\x00]*+(?:,[^,=\\\x00]++=[^,\\\x00]*+)*+\z"


def _plain(c: Column) -> Column:
    held = F.replace(F.replace(c, F.lit("\\\\"), F.lit(_HELD)), F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(held, F.lit("\\"), F.lit("")), F.lit(_HELD), F.lit("\\"))


def _once(df: DataFrame, *columns: Column, where: Column | None = None) -> DataFrame:
    """Rows of these columns, those that meet ``where``. They are generated, so a later filter on a column isn't
    moved below it, where the column would be worked out a second time."""
    row = F.array(F.struct(*columns))
    return df.select(F.inline(row if where is None else F.when(where, row)))


def parse_line_protocol(lines: DataFrame) -> DataFrame:
    """Points of line-protocol text (column ``value``), as :func:`to_points` shapes them. Lines that are no
    points (blank, comments, broken) are left out; fields of other types than number and text are null.

    A line is matched once for its tags, which are parsed once; fields and time only if they are asked for."""
    part = lambda n: F.regexp_extract("value", _LINE, n)
    parts = lines.select("value", part(1).alias("_head"))
    parts = _once(parts, F.col("value"), F.col("_head"), where=F.col("_head") != "")
    measurement = F.regexp_extract("_head", r"^((?:[^,\\]++|\\.)++)", 1)
    parts = parts.select("value", measurement.alias("_name"), F.substring(
        "_head", F.length(measurement) + 2, F.length("_head")).alias("_tags"))
    both = lambda text, pattern, n: F.regexp_extract_all(text, F.lit(pattern), F.lit(n))
    tags = F.map_from_arrays(F.transform(both("_tags", _TAG, 1), _plain), F.transform(both("_tags", _TAG, 2), _plain))
    tags = F.when(F.col("_tags").rlike(_PLAIN_TAGS), F.str_to_map("_tags", F.lit(","), F.lit("="))).otherwise(tags)
    parts = _once(parts, F.col("value"), F.col("_name"), tags.alias("tags"))
    parts = parts.select(_plain(F.col("_name")).alias("measurement"), "tags",
                         part(2).alias("_fields"), part(3).cast("long").alias("_ns"))
    fields = F.map_from_arrays(F.transform(both("_fields", _FIELD, 1), _plain), both("_fields", _FIELD, 2))
    quoted = lambda c: F.when(c.startswith('"'), _plain(F.substring(c, F.lit(2), F.length(c) - 2)))
    number = lambda c: F.when(~c.startswith('"'), c.try_cast("double"))
    parts = parts.withColumn("_all", fields)
    names = ("anomaly_score", "anomaly_flags", "pipeline_version", "detector_version")
    own = F.transform_values(F.map_filter("_all", lambda k, v: ~k.isin(*names)), lambda k, v: number(v))
    return parts.select(
        "measurement", "tags", own.alias("metric_fields"),
        F.struct(number(F.col("_all")["anomaly_score"]).alias("anomaly_score"),
                 *(quoted(F.col("_all")[n]).alias(n) for n in names[1:])).alias("fields"),
        F.timestamp_micros(F.call_function("div", F.col("_ns"), F.lit(1000).cast("long"))).alias("time"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The points that :func:`write_points` (or another writer of the format) has left in a folder."""
    return parse_line_protocol(spark.read.text(path).select("value"))


def points_long(points: DataFrame) -> DataFrame:
    """Numeric fields of points in long form, as :func:`point_fields_long` gives them for readings."""
    entries = F.concat(F.map_entries("metric_fields"), F.array(F.struct(
        F.lit("anomaly_score").alias("key"), F.col("fields.anomaly_score").alias("value"))))
    return points.select(F.col("tags")["event_id"].alias("event_id"), F.col("tags")["machine_id"].alias("machine_id"), "time",
                         F.explode(entries).alias("e")).select(
        "event_id", "machine_id", "time", F.col("e.key").alias("field"), F.col("e.value").alias("value"))


# -- SQL store (OP-41, OP-42) ----------------------------------------------

def to_wide(readings: DataFrame) -> DataFrame:
    """OP-41: the SQL-store row: fixed metric columns, all other metrics in ``extra_metrics``."""
    return readings.select(
        "event_id", "ingested_at", F.col("timestamp").alias("time"), "machine_id",
        "plant_id", "line_id", F.col("source_protocol").alias("protocol"), "status",
        *[F.col("metrics")[m].alias(m) for m in S.METRIC_COLUMNS],
        F.coalesce(F.col("anomaly_score"), F.lit(0.0)).alias("anomaly_score"),
        F.coalesce(F.col("anomaly_flags"), F.array().cast("array<string>")).alias("anomaly_flags"),
        "pipeline_version", "detector_version",
        F.map_filter("metrics", lambda k, v: ~k.isin(*S.METRIC_COLUMNS) & v.isNotNull()).alias("extra_metrics"))


NO_TABLE_YET = ("PATH_NOT_FOUND",)


def read_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table by its fixed schema (no file is opened to find it), or None while nothing has been written
    there; any other fault is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() not in NO_TABLE_YET:
            raise
        return None


def _layout(spark: SparkSession, path: str, buckets: int | None) -> int:
    """Number of buckets of the table at ``path``. It is noted beside the data when the table is made (the
    session's shuffle partitions, if none is given), and holds for every session after that."""
    noted = f"{path.rstrip('/')}/_layout"
    known = read_or_none(spark, noted, "buckets int")
    if known is None:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(noted)
        return buckets
    return known.first()["buckets"]


def wide_table(spark: SparkSession, path: str, columns: DataFrame, buckets: int | None = None) -> tuple[str, int]:
    """Name (in the session's catalog) and number of buckets of the wide table at ``path``, declared if it
    isn't known: partitioned by event date, bucketed by event id, in each bucket clustered by machine and time."""
    name = "shopfloor_wide_" + hashlib.md5(path.encode()).hexdigest()[:16]
    buckets = _layout(spark, path, buckets)
    if not spark.catalog.tableExists(name):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet PARTITIONED BY (event_date) CLUSTERED BY (event_id) "
                  f"SORTED BY (machine_id, time) INTO {buckets} BUCKETS LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return name, buckets


def new_wide_rows(readings: DataFrame, path: str, lookback_days: int | None = None,
                  buckets: int | None = None) -> tuple[DataFrame, str, int]:
    """Wide rows not yet in the table, the table's name and its number of buckets."""
    spark = readings.sparkSession
    rows = to_wide(first_arrivals(readings)).withColumn("event_date", F.to_date("time"))
    name, buckets = wide_table(spark, path, rows, buckets)
    ids = spark.table(name)
    if lookback_days is not None:
        lo = rows.agg(F.min("event_date")).first()[0]
        if lo is not None:
            ids = ids.filter(F.col("event_date") >= F.date_sub(F.lit(lo), lookback_days))
    # Dealt out like the buckets, so that the stored side stays as it is and each task writes whole buckets.
    rows = rows.repartition(buckets, "event_id")
    return rows.join(ids.select("event_id").hint("merge"), "event_id", "left_anti"), name, buckets


def write_wide_table(readings: DataFrame, path: str, lookback_days: int | None = None,
                     buckets: int | None = None) -> DataFrame:
    """OP-42: append wide rows not yet in the table (by ``event_id``; of
    several in the batch the first arrival). A day's rows are spread over the
    buckets by their ids, so neither a full day nor a hot machine is one
    task's. Returns what was appended (lazily; the write itself is done).

    The anti-join reads only the id column of the stored table, bucket by
    bucket: the stored side is not shuffled, whatever its size; the batch is
    dealt out like the buckets and written as it is dealt. With
    ``lookback_days`` only the ``event_date`` partitions from that many days
    before the batch's earliest date are read (partition pruning) -- for ids
    known not to re-arrive later than that. Default: every partition (exact)."""
    rows, name, _ = new_wide_rows(readings, path, lookback_days, buckets)
    rows.select(*readings.sparkSession.table(name).columns).write.insertInto(name)
    return rows


def write_wide_jdbc(readings: DataFrame, url: str, staging_table: str,
                    properties: dict | None = None, num_partitions: int | None = None) -> None:
    """OP-42 to a SQL database: append wide rows to a staging table with
    Spark's JDBC writer (one connection per partition; ``num_partitions``
    caps concurrent connections). Idempotency stays in the database: merge
    staging into the hypertable with ``INSERT ... SELECT ... ON CONFLICT
    (event_id) DO NOTHING``. Flags are written as comma text (JDBC has no
    array type mapping). Not exercised by the tests: no database may run in
    this environment."""
    rows = to_wide(readings).withColumn("anomaly_flags", F.array_join("anomaly_flags", ","))
    if num_partitions:
        rows = rows.coalesce(num_partitions)
    rows.write.mode("append").jdbc(url, staging_table, properties=properties or {})


# -- JSONL event log (OP-47, OP-48, OP-04) ---------------------------------

def log_columns(readings: DataFrame) -> list[Column]:
    """Reading columns in sorted key order; instants as UTC ISO text ending
    in ``Z`` with a fraction only when non-zero (the JSON form other writers
    of the log use)."""
    names = sorted(c for c in S.READING_COLUMNS if c in readings.columns)
    return [F.regexp_replace(iso_text(F.col(c)), r"\+00:00$", "Z").alias(c)
            if c in ("timestamp", "ingested_at") else F.col(c) for c in names]


def write_event_log(readings: DataFrame, path: str, mode: str = "append") -> None:
    """OP-47: one JSON object per line, keys sorted, in append (seq) order
    within each file. OP-48 (replay export) is ``mode='overwrite'``."""
    (readings.select(*log_columns(readings)).sortWithinPartitions("seq")
     .write.mode(mode).option("ignoreNullFields", "false").json(path))


def read_event_log_stream(spark: SparkSession, path: str,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """OP-04 as a stream: new JSONL files of a log folder, fixed schema; the
    stream checkpoint replaces the byte offset. Lines must carry ``seq`` (this
    package's writer adds it); import foreign logs once with
    :func:`read_event_log`, which derives it from file position."""
    r = spark.readStream.schema(S.EVENT_LOG_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path).select(*S.READING_COLUMNS)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """OP-04: read JSONL readings with a fixed schema; a malformed line fails
    the job (FAILFAST), blank lines are skipped. ``seq`` (when absent in the
    log) follows file order: per split ``(file, block start)`` the row count
    and first row id give an exact offset, so no single-task global ranking.
    Later copies of an id are the caller's :func:`first_arrivals`."""
    # Default timestamp parsing accepts ISO text with or without a fraction
    # and with 'Z' or an offset (what other writers of the log produce).
    raw = (spark.read.schema(S.EVENT_LOG_SCHEMA).option("mode", "FAILFAST").json(path)
           .select("*", F.col("_metadata.file_path").alias("_file"),
                   F.col("_metadata.file_block_start").alias("_block"),
                   F.monotonically_increasing_id().alias("_rid")))
    splits = raw.groupBy("_file", "_block").agg(F.min("_rid").alias("_first"),
                                                F.count(F.lit(1)).alias("_n"))
    # One row per split: small (data size / split size) even at 100 TB.
    offs = splits.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = raw.join(offs.select("_file", "_block", "_first", "_off"), ["_file", "_block"])
    seq = F.coalesce(F.col("seq"), F.col("_off") + F.col("_rid") - F.col("_first"))
    return out.withColumn("seq", seq).select(*S.READING_COLUMNS)
