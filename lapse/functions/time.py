"""Timestamp-string parsing and the engine's day numbers.

Timestamps arrive as text. Text laid out as ``YYYY-MM-DD hh:mm`` (all of a
well-formed export) is cut at fixed places; any other text goes through
regular expressions, and what does not match yields null parts
(``regexp_extract`` gives '' and ``try_cast`` turns that into null) instead of
failing the job. Both ways give the same parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that cut a timestamp string into parts.
DATETIME_PATTERN = r"(\d+)-(\d+)-(\d+)\s+(\d+):(\d+):(\d+)"
DAY_NUMBER_PATTERN = r"(\d+)-(\d+)-(\d+)\s+(\d+):(\d+)"
HOUR_PATTERN = r"\d+-\d+-\d+\s+(\d+):"
DATE_PATTERN = r"(\d+-\d+-\d+)"


# Start and length of each part in the fixed layout.
PLACES = {"year": (1, 4), "month": (6, 2), "day": (9, 2), "hour": (12, 2), "minute": (15, 2), "second": (18, 2)}


def _fixed_layout(c: Column, with_seconds: bool = False) -> Column:
    """Whether the text begins like ``2024-01-31 23:59`` (``:58``)."""
    n, rest = (19, "-- ::") if with_seconds else (16, "-- :")
    head = F.substring(c, 1, n)
    at = {5: "-", 8: "-", 11: " ", 14: ":"} | ({17: ":"} if with_seconds else {})
    out = F.translate(head, "0123456789", "") == rest
    for place, sign in at.items():
        out = out & (F.substring(c, place, 1) == sign)
    return out


def _part(col: Column | str, name: str, pattern: str, group: int, with_seconds: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    cut = F.substring(c, *PLACES[name]).try_cast("double")
    return F.when(_fixed_layout(c, with_seconds), cut).otherwise(F.regexp_extract(c, pattern, group).try_cast("double"))


def datetime_parts(col: Column | str) -> dict[str, Column]:
    """year, month, day, hour, minute, second as doubles (null when no match)."""
    return {n: _part(col, n, DATETIME_PATTERN, i + 1, True) for i, n in enumerate(PLACES)}


def day_number(col: Column | str, calendar: bool = False) -> Column:
    """The engine's day number of a timestamp string.

    Default (parity): ``month * 31 + day + hour / 24`` -- the year and the
    minutes are ignored and every month counts 31 days, so December to
    January runs backwards. ``calendar=True`` gives true elapsed days since
    1970-01-01 at hour resolution instead.
    """
    if calendar:
        c = F.col(col) if isinstance(col, str) else col
        ts = F.try_to_timestamp(F.regexp_extract(c, r"(\d+-\d+-\d+\s+\d+):", 1), F.lit("yyyy-MM-dd HH"))
        return F.unix_timestamp(ts).cast("double") / 86400.0
    month = _part(col, "month", DAY_NUMBER_PATTERN, 2)
    day = _part(col, "day", DAY_NUMBER_PATTERN, 3)
    hour = _part(col, "hour", DAY_NUMBER_PATTERN, 4)
    return month * 31 + day + hour / 24.0


def hour_of(col: Column | str) -> Column:
    """Hour of a timestamp string as double, null when absent."""
    return _part(col, "hour", HOUR_PATTERN, 1)


def date_text(col: Column | str) -> Column:
    """The ``y-m-d`` text of a timestamp string, null when absent."""
    c = F.col(col) if isinstance(col, str) else col
    matched = F.nullif(F.regexp_extract(c, DATE_PATTERN, 1), F.lit(""))
    return F.when(_fixed_layout(c), F.substring(c, 1, 10)).otherwise(matched)


def weekday_sat0(year: Column, month: Column, day: Column) -> Column:
    """Day of week with 0 = Saturday ... 6 = Friday (Zeller's numbering).

    Spark's ``dayofweek`` is 1 = Sunday ... 7 = Saturday, so ``% 7`` maps it
    to Zeller's numbering for every valid Gregorian date. Invalid parts give
    null.
    """
    d = F.try_make_timestamp_ntz(
        year.cast("int"), month.cast("int"), day.cast("int"), F.lit(0), F.lit(0), F.lit(0)
    )
    return F.dayofweek(d) % 7
