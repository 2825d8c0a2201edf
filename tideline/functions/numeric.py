"""Units of time, sums and means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_S = 86_400
US = 1_000_000


def total(value: Column) -> Column:
    """Sum as DOUBLE. Nothing is rounded on the way; a decimal column makes it independent of the order of rows."""
    return F.sum(value).cast("double")


def mean(value: Column) -> Column:
    """Mean as (sum, count) so both halves combine before the shuffle; NULLs are left out, NaN for no values."""
    n = F.count(value)
    return F.when(n > 0, total(value) / n).otherwise(F.lit(float("nan")))
