"""Daily activity: bits of fixed length with the features read off them, and
runs of days over the whole calendar.

The functions of bits work on an ``array<int>`` of 0/1 with Spark's
higher-order functions; ``runs_of_days`` works on (key, day) rows of any span.
No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bits_array(columns: list[str]) -> Column:
    return F.array(*[F.col(c) for c in columns])


def first_quit_day(bits: Column, length: int) -> Column:
    """First inactive day at or after the first active one; ``length`` if none.

    With no active day at all the search starts at day 0.
    """
    first_active = F.greatest(F.array_position(bits, 1) - 1, F.lit(0))
    rest = F.slice(bits, first_active + 1, length)
    p = F.array_position(rest, 0)
    return F.when(p == 0, F.lit(length)).otherwise(first_active + p - 1).cast("int")


def longest_run(bits: Column) -> Column:
    """Length of the longest run of consecutive 1s."""
    zero = F.struct(F.lit(0).alias("cur"), F.lit(0).alias("best"))

    def step(acc, x):
        cur = F.when(x == 1, acc["cur"] + 1).otherwise(F.lit(0))
        return F.struct(cur.alias("cur"), F.greatest(acc["best"], cur).alias("best"))

    return F.aggregate(bits, zero, step, lambda acc: acc["best"]).cast("int")


def window_sum(bits: Column, start: int, length: int) -> Column:
    """Sum of ``length`` bits starting at 0-based ``start``."""
    return F.aggregate(F.slice(bits, start + 1, length), F.lit(0), lambda a, x: a + x).cast("int")


def runs_of_days(days: DataFrame, key: list[str], day: str) -> DataFrame:
    """Per key over its distinct dates ``day`` (nulls left out): active days,
    longest run of consecutive days, the run that holds the last day, and the
    number of breaks between runs.

    Days of a run share the difference of day number and position, so runs are
    groups. A key has a row per day it was active, so its window is bounded by
    the calendar whatever its number of events.
    """
    once = days.where(F.col(day).isNotNull()).select(*key, F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).alias("_day")).distinct()
    position = F.row_number().over(Window.partitionBy(*key).orderBy("_day"))
    runs = once.withColumn("_run", F.col("_day") - position).groupBy(*key, "_run").agg(F.count(F.lit(1)).alias("_n"))
    # Later runs have larger differences.
    return runs.groupBy(*key).agg(
        F.sum("_n").alias("active_days"),
        F.max("_n").alias("longest_run"),
        F.max_by("_n", "_run").alias("current_run"),
        (F.count(F.lit(1)) - 1).alias("n_breaks"),
    )
