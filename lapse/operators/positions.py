"""Row positions within groups in a random-but-reproducible order, and
hash-based fold keys.

``row_positions`` numbers the rows of each group 1..n by (hash key, id)
without ordering a whole group in one task: rows are bucketed by a prefix
of the hex hash (uniform, 16^k buckets), bucket sizes are cumulated on the
small (group, bucket) table, and only a bucket is ordered by a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PRE = Window.unboundedPreceding


def hash_key(id_col: str, seed: int) -> Column:
    """md5 hex of ``'<id>:<seed>'`` (reproducible in SQL engines)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def hash_fold(id_col: str, seed: int, k: int | Column) -> Column:
    """Fold in [0, k) from the first 32 bits of the md5 key."""
    bits = F.conv(F.substring(hash_key(id_col, seed), 1, 8), 16, 10).cast("bigint")
    kk = k if isinstance(k, Column) else F.lit(k)
    return (bits % kk).cast("int")


def row_positions(
    df: DataFrame, id_col: str, seed: int, by: list[str] | tuple[str, ...] = (), out: str = "pos", bucket_chars: int = 3
) -> DataFrame:
    """``df`` plus a 1-based position within ``by`` ordered by (md5 key, id)."""
    by = list(by)
    keyed = df.withColumn("_k", hash_key(id_col, seed)).withColumn("_b", F.substring("_k", 1, bucket_chars))
    sizes = keyed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    offsets = sizes.select(
        *by, "_b", F.coalesce(F.sum("_bn").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(_PRE, -1)), F.lit(0)).alias("_off")
    )
    inner = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_k", id_col))
    ranked = keyed.withColumn("_r", inner).join(offsets, [*by, "_b"])
    return ranked.withColumn(out, F.col("_off") + F.col("_r")).drop("_k", "_b", "_r", "_off")
