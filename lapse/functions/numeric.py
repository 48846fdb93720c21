"""Numeric helpers: tolerant parsing, guarded ratios, clipping, logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The engine's ratio guards.
EPS = 1e-6


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_number(col: Column | str) -> Column:
    """Parse text to double; text that is no number becomes null (never an
    error): also ``nan``, and the type suffixes that a Java parse admits."""
    c = _c(col)
    suffixed = c.cast("string").rlike(r"[0-9.][dDfF]\s*$")
    number = F.when(~suffixed, c).try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / (den + 1e-6)``."""
    return _c(num) / (_c(den) + F.lit(EPS))


def smooth_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / (den + 1)``."""
    return _c(num) / (_c(den) + F.lit(1))


def clip(col: Column | str, lo: float | None, hi: float | None) -> Column:
    """Clamp to [lo, hi]; null stays null (``greatest`` alone would skip it)."""
    c = _c(col)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def log1p_pos(col: Column | str) -> Column:
    """``log1p(max(x, 0))``; null stays null."""
    return F.log1p(clip(col, 0, None))
