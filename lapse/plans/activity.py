"""Usage-event ("generation") features: counts, credits, recency, trends and
daily activity sequences over the first two weeks of each user.

Plan, chosen so that one user holding a large share of all events never
lands whole in one task:

1. ``activity_slots``: events are aggregated per (user, date, day number,
   hour, type) -- a partial + final hash aggregation, so map-side combine
   collapses a hot user before the shuffle. Everything later reads slots
   (at most hours x types rows per user and day), never raw events. Only the
   sums that the wanted features need are computed, and the slots are landed
   only if more than one branch reads them.
2. The user's first day number is an aggregate of the slots, joined back; a
   roll-up per (user, date), then per user, computes every count, first-48h,
   weekly and daily-bit value. Its partials carry all sums, so distinct days
   are a count of its rows, as distinct types are of a roll-up per (user,
   type): all are hash aggregations, and no distinct count expands the rows.
3. Users outside the spine are dropped per user, not per event.
4. The split-wide last day is a one-row-per-split aggregate, broadcast.

The day number ignores the year and counts 31 days per month (see
``lapse.functions.time.day_number``); pass ``calendar=True`` for true days.
Events without a parseable day number count in totals but not in the
day-relative features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.numeric import safe_ratio, smooth_ratio, to_number
from lapse.functions.text import contains_ci
from lapse.functions.time import date_text, day_number, hour_of
from lapse.operators.sequence import bits_array, first_quit_day, longest_run, runs_of_days, window_sum
from lapse.operators.materialize import land
from lapse.operators.spine import USER_KEY, attach

# Feature names, statuses counted, horizon of the daily bits, window lengths.
STATUSES = ("completed", "failed", "nsfw", "canceled")
N_DAYS = 14
FIRST_DAYS = 2
WEEK = 7
BURST_SHARE = 0.5
SHORT_LIFE_DAYS = 2
DECELERATION = 0.7

DAY_BITS = [f"active_day_{d}" for d in range(N_DAYS)]

ACTIVITY_COLUMNS = (
    "gen_total", "gen_completed", "gen_failed", "gen_nsfw", "gen_canceled",
    "gen_total_credits", "gen_video_count", "gen_image_count", "gen_active_days", "gen_unique_types",
    "gen_avg_credits", "completion_rate", "nsfw_rate", "gen_intensity", "gen_video_ratio",
    "gen_avg_duration", "gen_avg_hour",
    "gen_week1_count", "credits_week1", "gen_week2_count", "credits_week2", "gen_day01_count", "credits_day01",
    *DAY_BITS, "first_quit_day", "max_active_streak", "week1_active_days", "week2_active_days",
    "day01_ratio", "day01_credits_ratio", "burst_flag", "is_short_life", "is_one_day_user",
    "gen_trend", "credits_trend", "deceleration_flag", "days_since_last_gen", "days_since_first_gen",
    "gen_has_generations",
)

SLOT_KEYS = [*USER_KEY, "day_date", "day_num", "hour", "generation_type"]
SLOT_SUMS = ("s_rows", "s_n", *[f"s_{s}" for s in STATUSES], "s_credits", "s_video", "s_image", "s_dur_sum", "s_dur_n")

# What features need beyond row counts and credits.
EXTRA_SUMS = {
    **{f"gen_{s}": (f"s_{s}",) for s in STATUSES},
    "completion_rate": ("s_completed",),
    "nsfw_rate": ("s_nsfw",),
    "gen_video_count": ("s_video",),
    "gen_video_ratio": ("s_video",),
    "gen_image_count": ("s_image",),
    "gen_avg_duration": ("s_dur_sum", "s_dur_n"),
}
TYPES = {"gen_unique_types"}
LAST_DAY = {"days_since_last_gen", "days_since_first_gen"}
PLAIN = {
    "gen_total", *EXTRA_SUMS, "gen_total_credits", "gen_avg_credits", "gen_avg_hour", "gen_active_days",
    "gen_intensity", "is_short_life", "is_one_day_user", "gen_has_generations", *TYPES, *LAST_DAY,
}


def slot_sums(columns) -> tuple[str, ...]:
    """The slot sums that the wanted features are computed from."""
    needed = {"s_rows", "s_n", "s_credits", *[x for c in columns for x in EXTRA_SUMS.get(c, ())]}
    return tuple(x for x in SLOT_SUMS if x in needed)


def activity_slots(generations: DataFrame, calendar: bool = False, sums: tuple[str, ...] = SLOT_SUMS) -> DataFrame:
    """Partial sums per (user, date, day number, hour, type)."""
    credit = F.coalesce(to_number("credit_cost"), F.lit(0.0))
    ev = generations.select(
        *USER_KEY,
        "generation_id",
        "status",
        "generation_type",
        date_text("created_at").alias("day_date"),
        day_number("created_at", calendar).alias("day_num"),
        hour_of("created_at").alias("hour"),
        credit.alias("credit"),
        to_number("duration").alias("dur"),
    )
    every = {
        "s_rows": F.count(F.lit(1)),
        "s_n": F.count("generation_id"),
        **{f"s_{s}": F.count_if(F.col("status") == s) for s in STATUSES},
        "s_credits": F.sum("credit"),
        "s_video": F.count_if(contains_ci("generation_type", "video")),
        "s_image": F.count_if(contains_ci("generation_type", "image")),
        "s_dur_sum": F.sum("dur"),
        "s_dur_n": F.count("dur"),
    }
    return ev.groupBy(*SLOT_KEYS).agg(*[every[c].alias(c) for c in sums])


def _zsum(c) -> F.Column:
    return F.coalesce(F.sum(c), F.lit(0))


def merge_slots(partials: DataFrame) -> DataFrame:
    """Combine slot partials computed over separate batches of the events
    (all slot values are sums or counts, so they merge by summing)."""
    return partials.groupBy(*SLOT_KEYS).agg(*[F.sum(c).alias(c) for c in SLOT_SUMS])


def activity_table(
    generations: DataFrame, users: DataFrame, calendar: bool = False, materialize: bool = True, columns: tuple[str, ...] = ACTIVITY_COLUMNS
) -> DataFrame:
    """The activity features ``columns`` for users with at least one event.

    With ``materialize`` the slots are landed in the shared folder if several
    branches of the plan read them, so that the events are scanned once.
    """
    slots = activity_slots(generations, calendar, slot_sums(columns))
    if materialize and not set(columns) <= PLAIN - TYPES - LAST_DAY:
        slots = land(slots, "activity-slots")
    return activity_from_slots(slots, users, columns)


def activity_from_slots(slots: DataFrame, users: DataFrame, columns: tuple[str, ...] = ACTIVITY_COLUMNS) -> DataFrame:
    """User-level activity features from (merged) slot partials."""
    key, wanted, present = list(USER_KEY), set(columns), set(slots.columns)

    def s(name: str) -> F.Column:
        return F.col(name) if name in present else F.lit(0)

    n, cr = F.col("s_n"), F.col("s_credits")
    sums = {
        "gen_total": n,
        **{f"gen_{x}": s(f"s_{x}") for x in STATUSES},
        "gen_total_credits": cr,
        "gen_video_count": s("s_video"),
        "gen_image_count": s("s_image"),
        "_dur_sum": s("s_dur_sum"),
        "_dur_n": s("s_dur_n"),
        "_hour_sum": F.col("hour") * F.col("s_rows"),
    }
    bits = {}
    if not wanted <= PLAIN:
        first = slots.groupBy(*key).agg(F.min("day_num").alias("_first"))
        slots = slots.join(first, key).withColumn("rel", F.col("day_num") - F.col("_first"))
        rel = F.col("rel")
        day_int = F.least(F.floor(rel), F.lit(N_DAYS - 1))
        sums |= {
            "gen_week1_count": F.when(rel < WEEK, n),
            "credits_week1": F.when(rel < WEEK, cr),
            "gen_week2_count": F.when(rel >= WEEK, n),
            "credits_week2": F.when(rel >= WEEK, cr),
            "gen_day01_count": F.when(rel < FIRST_DAYS, n),
            "credits_day01": F.when(rel < FIRST_DAYS, cr),
        }
        bits = {b: (day_int == d).cast("int") for d, b in enumerate(DAY_BITS)}
    parts = [
        *[F.sum(c).alias(name) for name, c in sums.items()],
        *[F.max(c).alias(name) for name, c in bits.items()],
        F.min("day_num").alias("_first_day"),
        F.max("day_num").alias("_last_day"),
    ]
    # A missing date is a day of its own.
    days = slots.groupBy(*key, "day_date").agg(*parts)
    aggs = [
        *[_zsum(name).alias(name) for name in sums],
        *[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in bits],
        F.min("_first_day").alias("_first_day"),
        F.max("_last_day").alias("_last_day"),
        F.count(F.lit(1)).alias("gen_active_days"),
    ]
    known = users.select(*key)
    out = days.groupBy(*key).agg(*aggs).join(known, key, "left_semi")
    if wanted & TYPES:
        types = slots.select(*key, "generation_type").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("gen_unique_types"))
        out = out.join(types, key)
    if wanted & LAST_DAY:
        last = slots.groupBy(*key).agg(F.max("day_num").alias("_day")).join(known, key, "left_semi")
        last_day = last.groupBy("split").agg(F.max("_day").alias("_split_last_day"))
        out = out.join(F.broadcast(last_day), "split", "left")
    features = _features(wanted)
    return out.withColumns(features).select(*key, *columns)


def _features(wanted: set[str]) -> dict[str, F.Column]:
    """Ratios, flags and sequences over one row per user."""
    total = F.col("gen_total")
    active = F.col("gen_active_days")
    bits = bits_array(DAY_BITS)
    w1, w2 = F.col("gen_week1_count"), F.col("gen_week2_count")
    c1, c2 = F.col("credits_week1"), F.col("credits_week2")
    day01_ratio = smooth_ratio("gen_day01_count", total)
    features = {
        "gen_avg_credits": safe_ratio("gen_total_credits", total),
        "completion_rate": safe_ratio("gen_completed", total),
        "nsfw_rate": safe_ratio("gen_nsfw", total),
        "gen_intensity": safe_ratio(total, active),
        "gen_video_ratio": safe_ratio("gen_video_count", total),
        "gen_avg_duration": safe_ratio("_dur_sum", "_dur_n"),
        "gen_avg_hour": safe_ratio("_hour_sum", total),
        "first_quit_day": first_quit_day(bits, N_DAYS),
        "max_active_streak": longest_run(bits),
        "week1_active_days": window_sum(bits, 0, WEEK),
        "week2_active_days": window_sum(bits, WEEK, N_DAYS - WEEK),
        "day01_ratio": day01_ratio,
        "day01_credits_ratio": smooth_ratio("credits_day01", "gen_total_credits"),
        "burst_flag": (day01_ratio > BURST_SHARE).cast("int"),
        "is_short_life": (active <= SHORT_LIFE_DAYS).cast("int"),
        "is_one_day_user": (active == 1).cast("int"),
        "gen_trend": (w2 - w1) / (w1 + 1),
        "credits_trend": (c2 - c1) / (c1 + 1),
        "deceleration_flag": (w2 < w1 * DECELERATION).cast("int"),
        "days_since_last_gen": F.col("_split_last_day") - F.col("_last_day"),
        "days_since_first_gen": F.col("_split_last_day") - F.col("_first_day"),
        "gen_has_generations": F.lit(1),
    }
    return {name: c for name, c in features.items() if name in wanted}


def activity_features(generations: DataFrame, users: DataFrame, calendar: bool = False) -> DataFrame:
    """Activity features on the user spine; users without events get zeros."""
    return attach(users.select(*USER_KEY), activity_table(generations, users, calendar))


def streaks_calendar(generations: DataFrame, users: DataFrame) -> DataFrame:
    """Runs of active days over the whole calendar (the daily bits end at day
    13), for users with a dated event."""
    days = generations.select(*USER_KEY, date_text("created_at").try_cast("date").alias("day"))
    return runs_of_days(days, list(USER_KEY), "day").join(users.select(*USER_KEY), list(USER_KEY), "left_semi")
