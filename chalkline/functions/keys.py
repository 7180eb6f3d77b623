"""Deterministic hash surrogate keys (SHA-256, hex)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit separator between natural-key parts, so ("ab","c") != ("a","bc").
KEY_SEPARATOR = "\u001f"


def surrogate_key(*parts: Column) -> Column:
    """sha2-256 of one natural key, or of several joined by U+001F.

    NULL in -> NULL out for a single part; for several parts a NULL part makes
    the key NULL as well, so an unresolved member can never collide."""
    if len(parts) == 1:
        return F.sha2(parts[0].cast("string"), 256)
    joined = F.concat_ws(KEY_SEPARATOR, *[p.cast("string") for p in parts])
    any_null = None
    for p in parts:
        any_null = p.isNull() if any_null is None else (any_null | p.isNull())
    return F.when(any_null, F.lit(None).cast("string")).otherwise(F.sha2(joined, 256))
