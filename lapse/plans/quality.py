"""Input and stage reports: row counts per split, users without purchases,
timestamps that could not be parsed (counted here instead of failing), and the
shape of the feature table after each stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lapse.functions.time import datetime_parts, day_number
from lapse.operators.spine import USER_KEY
from lapse.sources.fixtures import ChurnInputs

REPORT_COLUMNS = (
    "n_users", "n_property_rows", "n_purchase_rows", "n_attempts", "n_generation_rows", "n_quiz_rows",
    "n_users_without_purchases", "n_unparsed_event_times", "n_unparsed_start_dates",
)


def stage_report(i: ChurnInputs) -> DataFrame:
    """One row per split. Every part counts rows where they lie (no raw row is
    shuffled): a few rows per part meet in the joins. Purchases are reduced to
    their distinct users before these are taken off the spine."""
    one = F.lit(1)
    unparsed_start = F.count_if(datetime_parts("subscription_start_date")["month"].isNull())
    unparsed_event = F.count_if(day_number("created_at").isNull())
    parts = [
        i.users.groupBy("split").agg(F.count(one).alias("n_users")),
        i.props.groupBy("split").agg(F.count(one).alias("n_property_rows"), unparsed_start.alias("n_unparsed_start_dates")),
        i.purchases.groupBy("split").agg(F.count(one).alias("n_purchase_rows")),
        i.tx.groupBy("split").agg(F.count(one).alias("n_attempts")),
        i.generations.groupBy("split").agg(F.count(one).alias("n_generation_rows"), unparsed_event.alias("n_unparsed_event_times")),
        i.quizzes.groupBy("split").agg(F.count(one).alias("n_quiz_rows")),
        i.users.join(i.purchases.select(*USER_KEY).distinct(), list(USER_KEY), "left_anti")
        .groupBy("split")
        .agg(F.count(one).alias("n_users_without_purchases")),
    ]
    out = reduce(lambda a, b: a.join(b, "split", "full_outer"), parts)
    return out.select("split", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in REPORT_COLUMNS])


SPLITS = ("train", "test")
# Report columns counted on the way of each input into its table.
COUNTED = {
    "users": {"n_users": lambda: F.lit(True)},
    "props": {
        "n_property_rows": lambda: F.lit(True),
        "n_unparsed_start_dates": lambda: datetime_parts("subscription_start_date")["month"].isNull(),
    },
    "purchases": {"n_purchase_rows": lambda: F.lit(True)},
    "tx": {"n_attempts": lambda: F.lit(True)},
    "generations": {"n_generation_rows": lambda: F.lit(True), "n_unparsed_event_times": lambda: day_number("created_at").isNull()},
    "quizzes": {"n_quiz_rows": lambda: F.lit(True)},
}


def load_report(i: ChurnInputs) -> DataFrame:
    """``stage_report`` from metrics that the landing jobs of the feature table
    observe as they write: no scan is made for it. Users without purchases come
    from two landed tables bucketed by user."""
    from lapse.plans.assemble import land_inputs

    seen: dict[str, Observation] = {}

    def watch(name: str, df: DataFrame) -> DataFrame:
        seen[name] = Observation(f"load-{name}")
        return df.observe(
            seen[name], *[F.count_if((F.col("split") == s) & test()).alias(f"{c}__{s}") for c, test in COUNTED[name].items() for s in SPLITS]
        )

    landed = land_inputs(i, watch)
    found = {k: v for o in seen.values() for k, v in o.get.items()}
    names = [c for c in REPORT_COLUMNS if c != "n_users_without_purchases"]
    rows = [(s, *(found[f"{c}__{s}"] for c in names)) for s in SPLITS if found[f"n_users__{s}"]]
    report = i.users.sparkSession.createDataFrame(rows, ", ".join(["split string", *[f"{c} long" for c in names]]))
    without = landed["users"].join(landed["purchase-types"].select(*USER_KEY), list(USER_KEY), "left_anti")
    without = without.groupBy("split").agg(F.count(F.lit(1)).alias("n_users_without_purchases"))
    out = report.join(without, "split", "left")
    return out.select("split", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in REPORT_COLUMNS])


def stage_shapes(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns after each stage, per split (stages in given order)."""
    parts = [
        df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("stage_no"), F.lit(name).alias("stage"), "split", "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for n, (name, df) in enumerate(stages.items())
    ]
    return reduce(DataFrame.unionByName, parts)
