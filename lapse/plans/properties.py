"""Subscription properties: plan, country share, calendar parts, date rank.

Share and rank are computed within each split (train and test are scored
as separate populations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.time import datetime_parts, weekday_sat0
from lapse.operators.frequency import frequency_share
from lapse.operators.keys import require_unique
from lapse.operators.materialize import join_small, land
from lapse.operators.rank import with_percent_rank
from lapse.operators.spine import USER_KEY


PROPERTY_COLUMNS = (
    "subscription_plan", "country_code", "country_freq",
    "sub_month", "sub_day_of_week", "sub_hour", "sub_date_rank",
)


def country_frequency(props: DataFrame) -> DataFrame:
    """Share of each country among the split's non-null country codes."""
    return frequency_share(props, "country_code", ["split"], out="country_freq")


def subscription_calendar(props: DataFrame) -> DataFrame:
    """Month, day of week (0 = Saturday) and hour of the subscription start."""
    p = datetime_parts("subscription_start_date")
    return props.select(
        *USER_KEY,
        p["month"].cast("int").alias("sub_month"),
        weekday_sat0(p["year"], p["month"], p["day"]).alias("sub_day_of_week"),
        p["hour"].cast("int").alias("sub_hour"),
    )


def subscription_date_rank(props: DataFrame) -> DataFrame:
    """Percent rank of the start-date text within the split, ties averaged."""
    p = land(properties_frame(props).select(*USER_KEY, "subscription_start_date"), "properties-dates")
    ranked = with_percent_rank(p, "subscription_start_date", ["split"], out="sub_date_rank")
    return ranked.select(*USER_KEY, "sub_date_rank")


def properties_frame(props: DataFrame) -> DataFrame:
    """Key-checked properties (not yet landed)."""
    return require_unique(props, "properties")


def properties_features(props: DataFrame) -> DataFrame:
    """One row per user with properties (not yet joined to the full spine)."""
    # Landed: the share, the rank (two branches) and the main projection all
    # read it, and Spark would otherwise re-run the key check for each.
    return properties_from_frame(land(properties_frame(props), "properties"))


def properties_from_frame(p: DataFrame) -> DataFrame:
    """Property features from a (landed) ``properties_frame``."""
    # One row per (split, country): landed, counted, and broadcast while small,
    # so that users are not shuffled on some tens of keys.
    freq = land(frequency_share(p, "country_code", ["split"], out="country_freq"), "country-share")
    parts = datetime_parts("subscription_start_date")
    out = with_percent_rank(p, "subscription_start_date", ["split"], out="sub_date_rank")
    out = join_small(out, freq, ["split", "country_code"])
    return out.select(
        *USER_KEY,
        "subscription_plan",
        "country_code",
        "country_freq",
        parts["month"].cast("int").alias("sub_month"),
        weekday_sat0(parts["year"], parts["month"], parts["day"]).alias("sub_day_of_week"),
        parts["hour"].cast("int").alias("sub_hour"),
        "sub_date_rank",
    )
