"""Assemble the per-user feature table: spine + five feature blocks,
interaction terms (on raw values), clipping, then log terms (on clipped values).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.numeric import clip, log1p_pos, smooth_ratio
from lapse.operators.keys import require_unique
from lapse.operators.materialize import land_all_bucketed
from lapse.operators.spine import USER_KEY
from lapse.plans.activity import ACTIVITY_COLUMNS, activity_from_slots, activity_slots
from lapse.plans.onboarding import QUIZ_COLUMNS, quiz_fills, quiz_table
from lapse.plans.payments import PAYMENT_COLUMNS, card_table, classify_attempts, failures_from_cards, paid_cards, payment_fills, risk_from_cards
from lapse.plans.properties import PROPERTY_COLUMNS, properties_frame, properties_from_frame
from lapse.plans.purchases import purchase_columns, purchase_rollup, purchase_table, purchase_types
from lapse.sources.fixtures import ChurnInputs

# Interaction terms, computed before clipping.
INTERACTIONS = {
    "credits_x_failure_rate": lambda c: c("gen_total_credits") * c("tx_failure_rate"),
    "trend_x_recency": lambda c: c("gen_trend") * c("days_since_last_gen"),
    "spend_per_gen": lambda c: smooth_ratio(c("total_spend"), c("gen_total")),
    "gen_total_x_purchases": lambda c: c("gen_total") * c("total_purchases"),
    "prepaid_x_failure": lambda c: c("tx_is_prepaid") * c("tx_failure_rate"),
    "prepaid_x_cvc": lambda c: c("tx_is_prepaid") * (1 - c("tx_cvc_pass_rate")),
    "payment_risk_score": lambda c: (
        c("tx_is_prepaid") + c("tx_is_virtual") + (1 - c("tx_cvc_pass_rate")) + c("tx_failure_rate")
    ) / 4,
    "burst_x_short_life": lambda c: c("burst_flag") * c("is_short_life"),
    "high_usage_short_life": lambda c: c("gen_total") * c("is_short_life"),
    "credits_per_active_day": lambda c: smooth_ratio(c("gen_total_credits"), c("gen_active_days")),
    "abrupt_decline": lambda c: c("day01_ratio") * (1 - c("completion_rate")),
    "sustained_engagement": lambda c: c("gen_active_days") * c("completion_rate"),
    "exploration_score": lambda c: c("gen_unique_types") * c("gen_active_days"),
    "purchase_engagement": lambda c: c("has_purchases") * c("gen_active_days"),
}

# Clip bounds (lo, hi).
CLIP_RULES = {
    "gen_trend": (-5, 10),
    "credits_trend": (-5, 10),
    "gen_total_credits": (0, 500000),
    "gen_avg_credits": (0, 10000),
    "total_spend": (0, 500),
    "tx_avg_amount": (0, 500),
    "tx_max_amount": (0, 500),
    "gen_total": (0, 500),
    "gen_intensity": (0, 100),
}

# Columns that get a ``<name>_log`` = log1p(max(x, 0)) twin.
LOG_COLUMNS = (
    "gen_total", "gen_total_credits", "gen_completed", "gen_failed", "total_spend",
    "tx_success_count", "tx_fail_count_weighted", "gen_video_count", "gen_image_count",
    "credits_week1", "credits_week2", "gen_week1_count", "gen_week2_count",
)


def merge_features(users: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """Left-join every one-row-per-user block onto the users table.

    All blocks are keyed by (split, user_id); where they come from tables
    bucketed by it, the chain of joins needs no exchange.
    """
    out = users
    for block in blocks:
        out = out.join(block, list(USER_KEY), "left")
    return out


def add_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({name: f(F.col) for name, f in INTERACTIONS.items()})


def clip_and_log(df: DataFrame) -> DataFrame:
    """Clip outliers, then add the log twins of the clipped values."""
    present = set(df.columns)
    clipped = df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in CLIP_RULES.items() if c in present})
    return clipped.withColumns({f"{c}_log": log1p_pos(c) for c in LOG_COLUMNS if c in present})


def land_inputs(inputs: ChurnInputs, watch: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """What the blocks are made of, reduced and key-checked, landed in buckets
    of (split, user_id): every later aggregation and join by user reads the
    buckets without an exchange. ``watch`` may attach metrics to the rows of an
    input on their way into its table."""
    i = inputs
    attempts = classify_attempts(watch("tx", i.tx), i.purchases)
    tables = {
        "users": watch("users", require_unique(i.users, "users")),
        "properties": watch("props", properties_frame(i.props)),
        "purchase-types": purchase_rollup(watch("purchases", i.purchases)),
        "activity-slots": activity_slots(watch("generations", i.generations)),
        "quizzes": watch("quizzes", quiz_table(i.quizzes)),
    }
    # Failed attempts have no user, so the card table is landed as it lies and
    # its paid part is put into the buckets.
    cards = card_table(attempts)
    tables["paid-cards"] = paid_cards(cards)
    landed = land_all_bucketed([(df, name) for name, df in tables.items()], USER_KEY)
    return {**dict(zip(tables, landed)), "card-table": cards}


def build_tables(landed: dict[str, DataFrame], types: tuple[str, ...]) -> dict[str, DataFrame]:
    """The per-user aggregate tables (only users with data in each)."""
    return {
        "properties": properties_from_frame(landed["properties"]),
        "purchases": purchase_table(landed["purchase-types"], types),
        "card_risk": risk_from_cards(landed["paid-cards"]),
        "failures": failures_from_cards(landed["card-table"]),
        "activity": activity_from_slots(landed["activity-slots"], landed["users"]),
        "quizzes": landed["quizzes"],
    }


def feature_fills(types: tuple[str, ...]) -> dict[str, F.Column]:
    """Gap filling of every block after the spine join, as one projection."""
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in [*purchase_columns(types), *ACTIVITY_COLUMNS]}
    return {**{c: F.col(c) for c in PROPERTY_COLUMNS}, **zero, **payment_fills(), **quiz_fills()}


def merged_features(inputs: ChurnInputs) -> DataFrame:
    """users + every block: one spine, one chain of left joins on (split,
    user_id), then all gap fills in a single projection. A user listed twice
    in a split fails the job."""
    landed = land_inputs(inputs)
    types = purchase_types(landed["purchase-types"])
    blocks = build_tables(landed, types)
    merged = merge_features(landed["users"], list(blocks.values()))
    fills = feature_fills(types)
    order = [*PROPERTY_COLUMNS, *purchase_columns(types), *PAYMENT_COLUMNS, *ACTIVITY_COLUMNS, *QUIZ_COLUMNS]
    return merged.select(*inputs.users.columns, *[fills[c].alias(c) for c in order])


def user_features(inputs: ChurnInputs) -> DataFrame:
    """The full per-user feature table: users columns, 5 blocks, 14 interactions,
    clipping, 13 log terms (the type columns are those that occur)."""
    return clip_and_log(add_interactions(merged_features(inputs)))


def align_columns(a: DataFrame, b: DataFrame, keep_out: tuple[str, ...] = ("churn_status", "target")) -> tuple[DataFrame, DataFrame]:
    """Give both frames the union of their columns, missing ones filled 0.

    Columns in ``keep_out`` are never added to the frame lacking them.
    Column order: ``a``'s columns, then ``b``'s extra ones.
    """
    a_cols, b_cols = a.columns, b.columns
    b_extra = [c for c in b_cols if c not in a_cols]
    a_extra = [c for c in a_cols if c not in b_cols and c not in keep_out]
    a2 = a.withColumns({c: F.lit(0) for c in b_extra}) if b_extra else a
    b2 = b.withColumns({c: F.lit(0) for c in a_extra}) if a_extra else b
    a2_cols, b2_cols = a2.columns, b2.columns
    order = [c for c in a2_cols if c in b2_cols]
    return a2, b2.select(*order, *[c for c in b2_cols if c not in order])
