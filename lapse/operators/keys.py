"""Key checks that fail the job instead of multiplying rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.operators.spine import USER_KEY


def require_unique(df: DataFrame, what: str = "table", key: tuple[str, ...] = USER_KEY) -> DataFrame:
    """``df`` unchanged (null keys dropped), or the job fails naming a duplicated key.

    A left join with a duplicated key would silently multiply user rows.
    Only the key columns are aggregated (hash aggregation with map-side
    combine). The duplicate set is normally empty; AQE then turns the guard
    join into a broadcast of nothing, though with broadcasts disabled it
    shuffles ``df`` on its key.
    """
    for c in key:
        df = df.where(F.col(c).isNotNull())
    dups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_dup_rows")).where(F.col("_dup_rows") > 1)
    guard = F.when(
        F.col("_dup_rows").isNotNull(),
        F.raise_error(F.concat(F.lit(f"duplicate user_id in {what}: "), F.col(key[-1]).cast("string"))),
    )
    return df.join(dups, list(key), "left").where(guard.isNull()).drop("_dup_rows")
