"""MQTT topic filters (OP-08) and topic parsing (OP-09)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def filter_regex(topic_filter: str) -> str:
    """MQTT filter -> anchored regex: '+' is exactly one level, a trailing
    '#' is any number of levels (including none)."""
    levels = topic_filter.split("/")
    out = []
    for i, lv in enumerate(levels):
        if lv == "#" and i == len(levels) - 1:
            out.append("#")
        elif lv == "+":
            out.append("[^/]*")
        else:
            out.append(re.escape(lv))
    rx = "/".join(out)
    if rx.endswith("/#"):
        rx = rx[:-2] + "(/.*)?"
    elif rx == "#":
        rx = ".*"
    return "^" + rx + "$"


def topic_matches(topic: Column, topic_filter: str) -> Column:
    return topic.rlike(filter_regex(topic_filter))


def topic_parts(topic: Column) -> Column:
    """Strip '/' at both ends, split on '/'."""
    return F.split(F.regexp_replace(topic, r"^/+|/+$", ""), "/")
