"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of ASCII letters and apostrophes.
WORD = "[A-Za-z']+"


def words(text: Column) -> Column:
    """Lower-cased word tokens of a text, as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def clock(ts: Column) -> Column:
    """UTC ``HH:MM:SS`` of a timestamp (the session time zone is UTC)."""
    return F.date_format(ts, "HH:mm:ss")
