"""JSON value helpers over VARIANT (Python ``json`` semantics, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TYPE = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)"


def vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_number_or_bool(v: Column) -> Column:
    """Python ``isinstance(x, (int, float))``: numbers and booleans."""
    return v.isNotNull() & vtype(v).rlike(NUMERIC_TYPE)


def as_double(v: Column) -> Column:
    """Number or boolean as double (``true`` -> 1.0)."""
    return F.try_variant_get(v, "$", "double")


def as_text(v: Column) -> Column:
    """Python ``str(x)`` for strings and numbers (None -> 'None')."""
    return F.when(v.isNull() | (vtype(v) == "VOID"), F.lit("None")) \
            .otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))


def truthy(value: Column) -> Column:
    """Python truthiness of a parsed JSON value (missing = False)."""
    def body(v):
        t = vtype(v)
        return (F.when(v.isNull() | (t == "VOID"), F.lit(False))
                .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
                .when(t.rlike(NUMERIC_TYPE), as_double(v) != 0)
                .when(t == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
                .when(t.startswith("ARRAY"), F.to_json(v) != "[]")
                .when(t.startswith("OBJECT"), F.to_json(v) != "{}")
                .otherwise(F.lit(True)))
    return let(value, body)


def last_value(entries: Column, key: str) -> Column:
    """Value of the *last* entry with ``key`` (a JSON object's repeated key)."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == F.lit(key)), F.lit(-1))["value"]


def dedupe_last_wins(pairs: Column, name_field: str = "name", value_field: str = "value") -> Column:
    """array<struct<name, value>> in order -> map where the later pair of a
    name wins (Python dict assignment in a loop)."""
    def body(ps):
        names = F.array_distinct(F.transform(ps, lambda p: p[name_field]))
        vals = F.transform(names, lambda n: F.try_element_at(
            F.filter(ps, lambda p: p[name_field] == n), F.lit(-1))[value_field])
        return F.map_from_arrays(names, vals)
    return let(pairs, body)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it any number of times in ``body``.

    ``body`` gets a lambda variable, so optimizer rewrites that substitute
    column aliases (filter push-down, project collapsing) copy ``value``
    once instead of once per use: expression size stays linear."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def python_object_entries(entries: Column) -> Column:
    """Entries of a JSON object as Python's ``json.loads`` dict iterates
    them: each key at its first position, with its last value."""
    def body(es):
        keys = F.array_distinct(F.transform(es, lambda e: e["key"]))
        return F.transform(keys, lambda k: F.struct(
            k.alias("key"),
            F.try_element_at(F.filter(es, lambda e: e["key"] == k), F.lit(-1))["value"].alias("value")))
    return let(entries, body)
