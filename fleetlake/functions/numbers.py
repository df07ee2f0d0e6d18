"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_nan(c: Column) -> Column:
    """NaN to NULL: Spark averages skip NULL but not NaN, and NaN compares above every number."""
    return F.when(~F.isnan(c), c)


def settle(c: Column, digits: int) -> Column:
    """Round half up after dropping floating noise below nine decimals.

    A distributed sum adds doubles in no fixed order, so the last bits of an average
    vary from run to run. Going through a decimal keeps the rounded value the same.
    """
    exact = F.round(c.try_cast("decimal(27,9)"), digits).cast("double")
    return F.coalesce(exact, F.round(c, digits))


def clamp(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit ``c`` to ``[low, high]``; NULL stays NULL."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)
