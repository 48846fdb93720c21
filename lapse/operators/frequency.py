"""Normalised frequency tables (share of each value among non-null rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def frequency_share(df: DataFrame, value: str, by: list[str] | tuple[str, ...] = (), out: str = "share") -> DataFrame:
    """One row per (by..., value): ``count / count of non-null values in by``.

    The count is a partial+final aggregation; the per-group total is a
    window over the small result (one row per distinct value), not over rows.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*by)) if by else F.sum("_n").over(Window.partitionBy())
    return counts.select(*by, value, (F.col("_n") / total).alias(out))
