"""Event id (OP-11): sha256 hex of the reading's canonical JSON.

Canonical JSON: keys sorted, compact separators, over machine_id, plant_id,
line_id, source_protocol, timestamp (ISO text), the non-null metrics (keys
sorted) and status. Ingest time, raw payload, anomaly and version fields are
not part of it, so a re-delivered message gets the same id. Only empty ids
are filled.

There is one form, whatever path a reading takes: the text that Python's
``json.dumps(..., sort_keys=True, separators=(",", ":"))`` gives, so ids equal
those that other producers write for the same reading. It is made of column
expressions (:mod:`shopfloor.functions.pyjson`); no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopfloor import schema as S
from shopfloor.functions.pyjson import floats_text, string_text
from shopfloor.functions.timefmt import iso_text


def _cols(*names) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in names]


def canonical_json(machine_id: Column, plant_id: Column, line_id: Column, protocol: Column,
                   timestamp: Column, metrics: Column, status: Column) -> Column:
    members = {
        "line_id": string_text(line_id), "machine_id": string_text(machine_id),
        "metrics": floats_text(metrics, S.METRIC_COLUMNS), "plant_id": string_text(plant_id),
        "source_protocol": string_text(protocol), "status": string_text(status),
        "timestamp": F.coalesce(F.concat(F.lit('"'), iso_text(timestamp), F.lit('"')), F.lit("null")),
    }
    parts = [F.concat(F.lit(f'"{name}":'), text) for name, text in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def event_id(machine_id="machine_id", plant_id="plant_id", line_id="line_id",
             protocol="source_protocol", timestamp="timestamp", metrics="metrics",
             status="status") -> Column:
    return F.sha2(canonical_json(*_cols(machine_id, plant_id, line_id, protocol, timestamp, metrics, status)), 256)


def ensure_event_id(existing: Column | None = None) -> Column:
    """Keep a non-empty id, else compute it."""
    existing = F.col("event_id") if existing is None else existing
    return F.coalesce(F.nullif(existing, F.lit("")), event_id())
