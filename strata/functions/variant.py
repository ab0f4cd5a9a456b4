"""VARIANT type tests used by the semi-structured operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_object(v: Column) -> Column:
    """True for a JSON object (empty or not), false for anything else or null.

    Casting to an empty struct only checks the value's header, unlike
    ``schema_of_variant``, which walks the whole value.
    """
    return F.coalesce(F.try_variant_get(v, "$", "struct<>").isNotNull(), F.lit(False))


def type_tag(v: Column) -> Column:
    """The value's type as text (``STRING``, ``BIGINT``, ``DECIMAL(1,0)``,
    ``OBJECT<...>``, ``VOID`` for JSON null); use on scalars, it walks objects."""
    return F.schema_of_variant(v)


def path(*keys: str) -> str:
    """A VARIANT extraction path for object keys, any characters allowed
    except a key holding both quote characters (no escape exists for it)."""
    parts = []
    for key in keys:
        if "'" not in key:
            parts.append(f"['{key}']")
        elif '"' not in key:
            parts.append(f'["{key}"]')
        else:
            raise ValueError(f"object key with both quote characters: {key!r}")
    return "$" + "".join(parts)
