"""Record helpers over VARIANT: field text, object test, canonical form, hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant_path(*keys: str) -> str:
    """``$['a']['b']`` path for literal keys (quotes escaped)."""
    return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in keys)


def field_text(record: Column, *keys: str) -> Column:
    """Text of a (nested) field: strings as is, numbers / booleans as their
    JSON text, objects / arrays as compact JSON; NULL when absent or null."""
    return F.try_variant_get(record, variant_path(*keys), "string")


def is_object(v: Column, *keys: str) -> Column:
    """True when a VARIANT, or its (nested) field, holds a JSON object (an empty one included).

    Only objects cast to a struct; arrays, scalars and JSON null give NULL.
    The struct without fields reads none, where a map would copy each value.
    """
    return F.try_variant_get(v, variant_path(*keys), "struct<>").isNotNull()


def canonical_text(value: Column) -> Column:
    """Compact JSON with keys sorted at every level and nulls kept.

    VARIANT objects serialise with sorted keys; structs keep field order,
    so callers build them with sorted field names. Key order in the source
    therefore never changes the text (or its hash).
    """
    return F.to_json(value, {"ignoreNullFields": "false"})


def row_hash(text: Column) -> Column:
    """SHA-256 hex of the text (dead-letter key, deterministic row id)."""
    return F.sha2(text, 256)
