"""Most frequent value per group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mode_or(col: str, default: str) -> Column:
    """Aggregate: most frequent non-null value, ties -> smallest, none -> default.

    ``mode(deterministic=True)`` keeps a value->count map per group, merged
    across partial aggregates, so a group's rows are never gathered.
    """
    return F.coalesce(F.mode(F.col(col), True), F.lit(default))
