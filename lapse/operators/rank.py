"""Ranks of any ordered column, without a one-partition global sort.

Distinct values (a hot value is one row with its count) are dealt into ranges
by bounds that Spark samples, so each task holds a run of the order. The ranges
are landed; their sizes, one row per range and group, are cumulated to offsets,
and a window orders only inside a range. This serves text, numbers, dates:
whatever Spark orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.operators.materialize import join_small, land

_PRE = Window.unboundedPreceding


def running_totals(
    distinct: DataFrame, value: str, weight: str, by: list[str] | tuple[str, ...] = (), ranges: int | None = None
) -> DataFrame:
    """``distinct`` (one row per (by..., value), landed by range) plus ``before``,
    the sum of ``weight`` over smaller values of the group, and ``total``.

    ``ranges``: number of ranges (default: the session's shuffle partitions).
    """
    by = list(by)
    order = [*by, value]
    dealt = distinct.repartitionByRange(ranges, *order) if ranges else distinct.repartitionByRange(*order)
    # The range's number is written with the rows, so it does not change when
    # the table is read again.
    dealt = land(dealt.withColumn("_range", F.spark_partition_id()), "rank-ranges")
    sizes = dealt.groupBy(*by, "_range").agg(F.sum(weight).alias("_size"))
    earlier = Window.partitionBy(*by).orderBy("_range")
    sizes = sizes.select(
        *by, "_range",
        F.coalesce(F.sum("_size").over(earlier.rowsBetween(_PRE, -1)), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy(*by)).alias("total"),
    )
    inside = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(_PRE, -1)
    numbered = dealt.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    placed = join_small(numbered, land(sizes, "rank-offsets"), [*by, "_range"], "inner")
    return placed.withColumn("before", F.col("_offset") + F.col("_inside")).drop("_range", "_offset", "_inside")


def percent_rank_table(
    df: DataFrame, value: str, by: list[str] | tuple[str, ...] = (), out: str = "pct_rank", ranges: int | None = None
) -> DataFrame:
    """One row per (by..., distinct non-null value) with its percent rank: the
    average 1-based rank of the tied values over the number of non-null values."""
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    placed = running_totals(counts, value, "_c", by, ranges)
    return placed.select(*by, value, ((F.col("before") + (F.col("_c") + 1) / 2.0) / F.col("total")).alias(out))


def with_percent_rank(
    df: DataFrame, value: str, by: list[str] | tuple[str, ...] = (), out: str = "pct_rank", ranges: int | None = None
) -> DataFrame:
    """``df`` plus its percent-rank column (left join on the distinct values;
    null stays null)."""
    return df.join(percent_rank_table(df, value, by, out, ranges), [*by, value], "left")


def value_positions(df: DataFrame, value: str, out: str = "position", ranges: int | None = None) -> DataFrame:
    """(value, position): each distinct non-null value with its position in
    order, from 0."""
    distinct = df.where(F.col(value).isNotNull()).select(value).distinct().withColumn("_one", F.lit(1))
    return running_totals(distinct, value, "_one", (), ranges).select(value, F.col("before").cast("int").alias(out))
