"""Attach per-user feature tables to the user spine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# A user id may occur in both splits; it then names two users.
USER_KEY = ("split", "user_id")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def fill_numeric(df: DataFrame, value: float = 0, exclude: tuple[str, ...] = USER_KEY) -> DataFrame:
    """Fill null (and NaN) with ``value`` in numeric columns only; text is left alone."""
    cols = numeric_columns(df, exclude)
    return df.na.fill(value, subset=cols) if cols else df


def attach(spine: DataFrame, features: DataFrame, key: tuple[str, ...] = USER_KEY, fill: float | None = 0) -> DataFrame:
    """Left-join one-row-per-key features onto the spine, then fill numeric gaps.

    Features are aggregated before this join, so the join never sees raw
    rows of a hot key; Spark picks broadcast or sort-merge from runtime size.
    """
    out = spine.join(features, list(key), "left")
    return fill_numeric(out, fill, exclude=tuple(spine.columns)) if fill is not None else out
