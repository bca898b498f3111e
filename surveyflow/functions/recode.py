"""Recoding of sentinel and missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_above(column: str, limit: float) -> Column:
    """Null where the value exceeds ``limit`` (the limit itself is valid); everything else is unchanged."""
    value = F.col(column)
    return F.when(value > limit, F.lit(None)).otherwise(value)


def nan_to_null(column: str) -> Column:
    """NaN compares greater than any number and poisons averages, so it must not get past ingest."""
    return F.nanvl(F.col(column), F.lit(None).cast("double"))


def fill_category(column: str, missing: str) -> Column:
    """The value as a string, with missing values as a category of their own."""
    return F.coalesce(F.col(column).cast("string"), F.lit(missing))
