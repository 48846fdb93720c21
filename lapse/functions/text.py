"""Text helpers: case-insensitive contains, pivot names, card fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Placeholder and separator of the card fingerprint text.
FINGERPRINT_NULL = "unk"
FINGERPRINT_SEP = "|"


def contains_ci(col: Column | str, needle: str) -> Column:
    """Case-insensitive substring test; null text gives false."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def column_suffix(value: Column | str) -> Column:
    """Lower-case with spaces replaced by underscores (pivot column names)."""
    c = F.col(value) if isinstance(value, str) else value
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def _as_text(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        # Booleans print as True/False in the fingerprint text.
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    return c.cast("string")


def fingerprint(df: DataFrame, columns: list[str] | tuple[str, ...]) -> Column:
    """Join the columns as text with '|', nulls written as 'unk'.

    ``concat_ws`` would skip a null field and let two different cards
    collide, so every field is coalesced first.
    """
    parts = [F.coalesce(_as_text(df, c), F.lit(FINGERPRINT_NULL)) for c in columns]
    return F.concat_ws(FINGERPRINT_SEP, *parts)
