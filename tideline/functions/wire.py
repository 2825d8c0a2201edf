"""Byte keys and values of a message log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(key: Column, default: str) -> Column:
    """UTF-8 text of a key; ``default`` when it is missing or empty."""
    return F.coalesce(F.nullif(F.decode(key, "UTF-8"), F.lit("")), F.lit(default))


def to_bytes(value: Column) -> Column:
    """UTF-8 bytes of any scalar."""
    return F.encode(value.cast("string"), "UTF-8")
