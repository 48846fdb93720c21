"""Column helpers shared by the training-data operators."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of the contracts: maximal runs of anything but space and \t \n \v \f \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Maps the bytes A-Z to a-z and leaves all others, also those of UTF-8.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

UNIT = 1 << 62


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unit_hash(*columns) -> Column:
    """A hash in [0, 2**62): a reproducible uniform draw per row."""
    return F.pmod(F.xxhash64(*columns), F.lit(UNIT))


def held_out(divisor: int, remainder: int = 2, column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves the remainder (a null id: no)."""
    crc = F.crc32(F.encode(F.col(column).cast("string"), "UTF-8"))
    return F.coalesce(crc % divisor == remainder, F.lit(False))


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker process, for what
    is costly to load (tokenizers); tasks of one worker share it."""
    return sys.__dict__.setdefault("_lapse_llm_cache", {})
