"""Weighted attribution of anonymous failed payments to card holders.

A failed attempt carries no user. It is attributed to every user who paid
successfully with a card of the same fingerprint (within the same split),
each receiving weight 1/n for n such users.

Instead of expanding each failure into one row per matching user, failures
are first counted per fingerprint (partial aggregation), users per
fingerprint are counted once, and only the (fingerprint, user) pairs --
at most one per distinct card a user paid with -- meet the per-fingerprint
counts. A card shared by many users therefore costs one row per user, not
one per (failure, user).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprint_users(success_fp: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (keys..., fingerprint, user_id) pairs of successful attempts."""
    return success_fp.where(F.col("user_id").isNotNull()).select(*keys, "fingerprint", "user_id").distinct()


def users_per_fingerprint(pairs: DataFrame, keys: list[str]) -> DataFrame:
    return pairs.groupBy(*keys, "fingerprint").agg(F.count(F.lit(1)).alias("n_users"))


def failures_per_fingerprint(failed_fp: DataFrame, keys: list[str], codes: tuple[str, ...] = (), code_col: str = "failure_code") -> DataFrame:
    """Failed attempts per fingerprint: ``n_fail`` and ``n_<code>`` of each code."""
    code = F.coalesce(F.col(code_col), F.lit("unknown"))
    return failed_fp.groupBy(*keys, "fingerprint").agg(
        F.count(F.lit(1)).alias("n_fail"), *[F.count_if(code == c).alias(f"n_{c}") for c in codes]
    )


def attribute_counts(pairs: DataFrame, fails: DataFrame, keys: list[str], codes: tuple[str, ...] = ()) -> DataFrame:
    """Per (keys..., user): weighted and raw failure counts, and weighted
    counts per code, from distinct (fingerprint, user) pairs and failures per
    fingerprint. Users without matched failures are absent."""
    n = users_per_fingerprint(pairs, keys)
    matched = pairs.join(fails.join(n, [*keys, "fingerprint"]), [*keys, "fingerprint"])
    w = F.lit(1.0) / F.col("n_users")
    return matched.groupBy(*keys, "user_id").agg(
        F.sum(F.col("n_fail") * w).alias("tx_fail_count_weighted"),
        F.sum("n_fail").alias("tx_fail_count_raw"),
        *[F.sum(F.col(f"n_{c}") * w).alias(f"fail_{c}") for c in codes],
    )


def attribute_failures(success_fp: DataFrame, failed_fp: DataFrame, keys: list[str], codes: tuple[str, ...] = ()) -> DataFrame:
    """``attribute_counts`` from rows of successful and failed attempts."""
    fails = failures_per_fingerprint(failed_fp, keys, codes)
    return attribute_counts(fingerprint_users(success_fp, keys), fails, keys, codes)
