"""Timestamp parsing and ISO text (OP-12, OP-17, OP-18)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python-style ISO-8601 prefix guard: Spark's parser accepts '2024' alone;
# only text starting with a full date is parsed.
ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}"
# The basic form, which Spark's parser rejects: date, hours, minutes, seconds, fraction, offset.
ISO_BASIC = (r"^(\d{4})(\d{2})(\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
             r"(Z|[+-]\d{2}(?::?\d{2})?)?)?$")
# Latest instant Python datetimes can hold (year 9999).
MAX_EPOCH_SECONDS = 253402300799


def iso_text(ts: Column) -> Column:
    """UTC instant -> ISO text the way Python's ``isoformat`` writes it:
    ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00`` (fraction only when non-zero)."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))) \
            .otherwise(F.lit(""))
    return F.when(ts.isNotNull(), F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), frac,
                                           F.lit("+00:00")))


def _extended(text: Column) -> Column:
    """The extended form of text in the basic form."""
    part = [F.regexp_extract(text, ISO_BASIC, n) for n in range(9)]
    two = lambda n: F.coalesce(F.nullif(part[n], F.lit("")), F.lit("00"))
    fraction = F.when(part[7] != "", F.concat(F.lit("."), F.substring(part[7], 1, 6))).otherwise(F.lit(""))
    offset = F.replace(part[8], F.lit(":"), F.lit(""))
    offset = (F.when(F.length(offset) == 3, F.concat(offset, F.lit(":00")))
              .when(F.length(offset) == 5, F.concat(F.substring(offset, 1, 3), F.lit(":"), F.substring(offset, 4, 2)))
              .otherwise(offset))
    return F.concat(part[1], F.lit("-"), part[2], F.lit("-"), part[3], F.lit("T"), two(4), F.lit(":"), two(5), F.lit(":"),
                    two(6), fraction, offset)


def parse_iso(text: Column) -> Column:
    """OP-12: ISO text, extended or basic -> instant. Naive text is UTC (session zone), offsets
    keep their instant; text that is not a full ISO date gives null."""
    return F.when(text.rlike(ISO_PREFIX), F.try_to_timestamp(text)).when(
        text.rlike(ISO_BASIC), F.try_to_timestamp(_extended(text)))


def from_epoch_seconds(x: Column) -> Column:
    """Epoch seconds (int or float) -> instant; out of Python's range -> null."""
    return F.when((x >= 0 - MAX_EPOCH_SECONDS) & (x <= MAX_EPOCH_SECONDS),
                  F.timestamp_micros((x * F.lit(1_000_000)).cast("long")))


def between_inclusive(ts: Column, since=None, until=None) -> Column:
    """OP-17: both ends inclusive; bounds compared as instants."""
    cond = F.lit(True)
    if since is not None:
        cond = cond & (ts >= F.to_timestamp(F.lit(since)))
    if until is not None:
        cond = cond & (ts <= F.to_timestamp(F.lit(until)))
    return cond
