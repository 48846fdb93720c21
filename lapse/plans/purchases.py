"""Purchase profile per user: counts, spend, types, span.

Purchases are rolled up twice: per (user, type), then per user. The partials
carry all sums, so distinct types are a count of rows and every aggregation is
a hash aggregation over fixed-length buffers; the types that become columns
come from the roll-up too, so the purchases are scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.text import column_suffix
from lapse.functions.time import day_number
from lapse.operators.materialize import land
from lapse.operators.spine import USER_KEY, attach

SUMMARY_COLUMNS = (
    "total_purchases", "total_spend", "avg_purchase_amount",
    "max_purchase", "min_purchase", "n_purchase_types",
)


def purchase_rollup(purchases: DataFrame) -> DataFrame:
    """Partial sums per (user, type)."""
    amount, day = F.col("purchase_amount_dollars"), day_number("purchase_time")
    return purchases.groupBy(*USER_KEY, "purchase_type").agg(
        F.count(F.lit(1)).alias("p_rows"),
        F.count("transaction_id").alias("p_ids"),
        F.sum(amount).alias("p_sum"),
        F.count(amount).alias("p_n"),
        F.max(amount).alias("p_max"),
        F.min(amount).alias("p_min"),
        F.max(day).alias("p_last"),
        F.min(day).alias("p_first"),
    )


def _summary_aggs() -> list:
    return [
        F.sum("p_ids").alias("total_purchases"),
        F.sum("p_sum").alias("total_spend"),
        F.try_divide(F.sum("p_sum"), F.sum("p_n")).alias("avg_purchase_amount"),
        F.max("p_max").alias("max_purchase"),
        F.min("p_min").alias("min_purchase"),
        # One row per type; a missing type is none.
        F.count("purchase_type").alias("n_purchase_types"),
    ]


def purchase_types(purchases: DataFrame) -> tuple[str, ...]:
    """The column suffixes of the types that occur, sorted (one small job over
    a landed roll-up; the purchases themselves do as well)."""
    found = purchases.select(column_suffix("purchase_type").alias("t")).where(F.col("t").isNotNull()).distinct()
    return tuple(sorted(r.t for r in found.collect()))


def _type_aggs(types: tuple[str, ...]) -> list:
    name = column_suffix("purchase_type")
    return [F.coalesce(F.sum(F.when(name == t, F.col("p_rows"))), F.lit(0)).alias(f"ptype_{t}") for t in types]


def _span_agg():
    return (F.max("p_last") - F.min("p_first")).alias("days_between_first_last")


def purchase_summary(purchases: DataFrame) -> DataFrame:
    """count / sum / mean / max / min of amounts and distinct types per user."""
    return purchase_rollup(purchases).groupBy(*USER_KEY).agg(*_summary_aggs())


def purchase_type_counts(purchases: DataFrame, types: tuple[str, ...] | None = None) -> DataFrame:
    """Purchases per user and type as ``ptype_<type>`` columns, absent = 0.
    The types are those of ``purchases`` unless given."""
    rolled = land(purchase_rollup(purchases).select(*USER_KEY, "purchase_type", "p_rows"), "purchase-types")
    types = purchase_types(rolled) if types is None else types
    return rolled.groupBy(*USER_KEY).agg(F.sum("p_rows").alias("_rows"), *_type_aggs(types)).drop("_rows")


def purchase_span(purchases: DataFrame) -> DataFrame:
    """Day-number span between a user's first and last purchase."""
    return purchase_rollup(purchases).groupBy(*USER_KEY).agg(_span_agg())


def purchase_table(rolled: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """All purchase aggregates from the roll-up, for users with purchases."""
    return rolled.groupBy(*USER_KEY).agg(*_summary_aggs(), *_type_aggs(types), _span_agg(), F.lit(1).alias("has_purchases"))


def purchase_columns(types: tuple[str, ...]) -> list[str]:
    return [*SUMMARY_COLUMNS, *[f"ptype_{t}" for t in types], "days_between_first_last", "has_purchases"]


def purchase_features(purchases: DataFrame, users: DataFrame, types: tuple[str, ...] | None = None) -> DataFrame:
    """All purchase features on the user spine: one roll-up, one join.

    ``has_purchases`` marks users that appear in the purchases at all; every
    numeric gap becomes 0.
    """
    rolled = land(purchase_rollup(purchases), "purchase-types")
    types = purchase_types(rolled) if types is None else types
    return attach(users.select(*USER_KEY), purchase_table(rolled, types))


def purchase_types_by_split(purchases: DataFrame, splits: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """Type counts with the type columns discovered per split, then aligned.

    The purchases are read once, into counts per (user, type), which are
    landed; each split's type columns come from them, and the splits are then
    given the same columns (absent ones 0) and stacked.
    """
    from lapse.plans.assemble import align_columns

    typed = purchases.select(*USER_KEY, "purchase_type")
    counts = land(typed.groupBy(*USER_KEY, "purchase_type").agg(F.count(F.lit(1)).alias("n")), "purchase-types")
    suffix = column_suffix("purchase_type")
    frames = []
    for split in splits:
        part = counts.where(F.col("split") == split)
        sums = [F.coalesce(F.sum(F.when(suffix == t, F.col("n"))), F.lit(0)).alias(f"ptype_{t}") for t in purchase_types(part)]
        frames.append(part.groupBy(*USER_KEY).agg(F.sum("n").alias("_rows"), *sums).drop("_rows"))
    out = frames[0]
    for other in frames[1:]:
        out, other = align_columns(out, other)
        out = out.unionByName(other)
    cols = sorted(c for c in out.columns if c.startswith("ptype_"))
    return out.select(*USER_KEY, *cols)
