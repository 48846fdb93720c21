"""Payment features: card risk over successful attempts, attributed failures.

An attempt is successful when its transaction id occurs in the purchases of
the same split, whoever bought; the purchase gives it a user. Failed attempts
have no user and are attributed by card fingerprint
(``lapse.operators.attribution``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.functions.text import fingerprint
from lapse.operators.attribution import attribute_counts, fingerprint_users, users_per_fingerprint
from lapse.operators.materialize import land
from lapse.operators.mode import mode_or
from lapse.operators.spine import USER_KEY

# Card attributes forming the fingerprint, in this order.
FINGERPRINT_COLUMNS = (
    "card_brand", "card_country", "card_funding", "bank_name",
    "billing_address_country", "is_prepaid", "is_virtual",
)
# Failure codes with their own weighted count.
FAILURE_CODES = ("card_declined", "expired_card", "incorrect_cvc", "incorrect_number", "processing_error")
UNKNOWN = "unknown"
RISK_FLAGS = ("tx_has_digital_wallet", "tx_has_3d_secure", "tx_is_prepaid", "tx_is_virtual", "tx_is_business")

PAYMENT_COLUMNS = (
    "tx_success_count", *RISK_FLAGS, "tx_cvc_pass_rate", "tx_avg_amount", "tx_max_amount",
    "tx_country_mismatch_rate", "tx_card_brand", "tx_card_funding",
    "tx_fail_count_weighted", "tx_fail_count_raw", *[f"fail_{c}" for c in FAILURE_CODES],
    "tx_failure_rate",
)

KEYS = ["split"]


def purchase_map(purchases: DataFrame) -> DataFrame:
    """Distinct (split, transaction_id, user_id) of the purchases."""
    known = purchases.where(F.col("transaction_id").isNotNull())
    return known.select("split", "transaction_id", "user_id").distinct()


def classify_attempts(tx: DataFrame, purchases: DataFrame) -> DataFrame:
    """Every attempt once per matching purchase user, with ``is_success``.

    One left join on (split, transaction_id) serves both the successful
    rows (matched, with their user) and the failed rows (unmatched), so the
    attempts are shuffled once. The purchases, three narrow columns, are hashed
    in each partition, so the wide attempts need no sort.
    """
    pm = purchase_map(purchases).withColumn("_hit", F.lit(True))
    out = tx.join(pm.hint("shuffle_hash"), ["split", "transaction_id"], "left")
    return out.withColumn("is_success", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def tx_success(tx: DataFrame, purchases: DataFrame) -> DataFrame:
    return classify_attempts(tx, purchases).where("is_success").drop("is_success")


def tx_failed(tx: DataFrame, purchases: DataFrame) -> DataFrame:
    return classify_attempts(tx, purchases).where(~F.col("is_success")).drop("is_success", "user_id")


def _risk_aggs() -> list:
    amt = F.col("amount_in_usd")
    any_true = lambda c: F.bool_or(F.coalesce(F.col(c), F.lit(False))).cast("int")
    return [
        F.count("transaction_id").alias("tx_success_count"),
        F.bool_or(F.coalesce(F.col("digital_wallet"), F.lit("none")) != "none").cast("int").alias("tx_has_digital_wallet"),
        any_true("is_3d_secure").alias("tx_has_3d_secure"),
        any_true("is_prepaid").alias("tx_is_prepaid"),
        any_true("is_virtual").alias("tx_is_virtual"),
        any_true("is_business").alias("tx_is_business"),
        F.avg(F.when(F.coalesce(F.col("cvc_check"), F.lit("")) == "pass", 1.0).otherwise(0.0)).alias("tx_cvc_pass_rate"),
        F.avg(amt).alias("tx_avg_amount"),
        F.max(amt).alias("tx_max_amount"),
    ]


def _mismatch_agg():
    differs = F.coalesce(F.col("billing_address_country"), F.lit("")) != F.coalesce(F.col("card_country"), F.lit(""))
    return F.avg(differs.cast("double")).alias("tx_country_mismatch_rate")


def _mode_aggs() -> list:
    return [mode_or("card_brand", UNKNOWN).alias("tx_card_brand"), mode_or("card_funding", UNKNOWN).alias("tx_card_funding")]


def card_risk(success: DataFrame) -> DataFrame:
    """Per user over successful attempts: count, any-flags, cvc pass rate, amounts."""
    return success.groupBy(*USER_KEY).agg(*_risk_aggs())


def country_mismatch(success: DataFrame) -> DataFrame:
    """Share of successful attempts whose billing country differs from the card's."""
    return success.groupBy(*USER_KEY).agg(_mismatch_agg())


def card_mode(success: DataFrame) -> DataFrame:
    """Most used card brand and funding per user ('unknown' when none)."""
    return success.groupBy(*USER_KEY).agg(*_mode_aggs())


def with_fingerprint(df: DataFrame) -> DataFrame:
    return df.withColumn("fingerprint", fingerprint(df, FINGERPRINT_COLUMNS))


def fingerprint_user_counts(success: DataFrame) -> DataFrame:
    """Distinct paying users per (split, fingerprint)."""
    return users_per_fingerprint(fingerprint_users(with_fingerprint(success), KEYS), KEYS)


def card_table(attempts: DataFrame, materialize: bool = True) -> DataFrame:
    """One row per (split, card fingerprint, user, success) with the partial
    sums that every payment feature needs; a failed attempt has no user.

    Brand, funding, prepaid, virtual and both countries are fingerprint
    fields, so they are constant inside a group; brand and funding are kept
    as keys. The risk roll-up, the most-used brand and funding and the
    failure attribution all read this table, which is landed once, so the
    attempts are scanned and joined once for all of them.
    """
    passed = F.coalesce(F.col("cvc_check"), F.lit("")) == "pass"
    differs = F.coalesce(F.col("billing_address_country"), F.lit("")) != F.coalesce(F.col("card_country"), F.lit(""))
    any_true = lambda c: F.bool_or(F.coalesce(F.col(c), F.lit(False)))
    keys = ["split", "fingerprint", "user_id", "is_success", "card_brand", "card_funding"]
    cards = with_fingerprint(attempts).groupBy(*keys).agg(
        F.count("transaction_id").alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
        F.bool_or(F.coalesce(F.col("digital_wallet"), F.lit("none")) != "none").alias("_wallet"),
        any_true("is_3d_secure").alias("_3ds"),
        any_true("is_prepaid").alias("_prepaid"),
        any_true("is_virtual").alias("_virtual"),
        any_true("is_business").alias("_business"),
        F.count_if(passed).alias("_cvc_pass"),
        F.sum("amount_in_usd").alias("_amt_sum"),
        F.count("amount_in_usd").alias("_amt_n"),
        F.max("amount_in_usd").alias("_amt_max"),
        F.count_if(differs).alias("_mismatch"),
        *[F.count_if(F.col("failure_code") == c).alias(f"n_{c}") for c in FAILURE_CODES],
    )
    return land(cards, "card-table") if materialize else cards


def paid_cards(cards: DataFrame) -> DataFrame:
    return cards.where(F.col("is_success") & F.col("user_id").isNotNull())


def _most_used(paid: DataFrame, col: str, out: str) -> DataFrame:
    """Per user the value of ``col`` on most successful attempts; ties -> smallest.

    Top-1 per user by ``row_number``: Spark limits each group before the
    shuffle (window group limit), and a user has one row per distinct value.
    """
    counts = paid.where(F.col(col).isNotNull()).groupBy(*USER_KEY, col).agg(F.sum("_rows").alias("_c"))
    rank = F.row_number().over(Window.partitionBy(*USER_KEY).orderBy(F.desc("_c"), F.asc(col)))
    return counts.withColumn("_r", rank).where(F.col("_r") == 1).select(*USER_KEY, F.col(col).alias(out))


def risk_from_cards(cards: DataFrame) -> DataFrame:
    """Card-risk features per user, rolled up from the card table."""
    paid, rows = paid_cards(cards), F.sum("_rows")
    risk = paid.groupBy(*USER_KEY).agg(
        F.sum("_n").alias("tx_success_count"),
        *[F.bool_or(f"_{k}").cast("int").alias(n) for k, n in zip(("wallet", "3ds", "prepaid", "virtual", "business"), RISK_FLAGS)],
        (F.sum("_cvc_pass") / rows).alias("tx_cvc_pass_rate"),
        F.try_divide(F.sum("_amt_sum"), F.sum("_amt_n")).alias("tx_avg_amount"),
        F.max("_amt_max").alias("tx_max_amount"),
        (F.sum("_mismatch") / rows).alias("tx_country_mismatch_rate"),
    )
    for col, name in (("card_brand", "tx_card_brand"), ("card_funding", "tx_card_funding")):
        risk = risk.join(_most_used(paid, col, name), list(USER_KEY), "left")
    return risk


def failures_from_cards(cards: DataFrame) -> DataFrame:
    """Attributed failures per user (users with a matched failure only)."""
    pairs = fingerprint_users(paid_cards(cards), KEYS)
    fails = cards.where(~F.col("is_success")).groupBy(*KEYS, "fingerprint").agg(
        F.sum("_rows").alias("n_fail"), *[F.sum(f"n_{c}").alias(f"n_{c}") for c in FAILURE_CODES]
    )
    return attribute_counts(pairs, fails, KEYS, FAILURE_CODES)


def payment_fills() -> dict[str, F.Column]:
    """Gap filling after the spine join, plus the failure rate on filled values."""
    out = {c: F.coalesce(F.col(c), F.lit(0)) for c in PAYMENT_COLUMNS if c not in ("tx_card_brand", "tx_card_funding", "tx_failure_rate")}
    out["tx_card_brand"] = F.coalesce(F.col("tx_card_brand"), F.lit(UNKNOWN))
    out["tx_card_funding"] = F.coalesce(F.col("tx_card_funding"), F.lit(UNKNOWN))
    w = F.coalesce(F.col("tx_fail_count_weighted"), F.lit(0.0))
    s = F.coalesce(F.col("tx_success_count"), F.lit(0))
    out["tx_failure_rate"] = w / (w + s + F.lit(1e-6))
    return out


def payment_features(tx: DataFrame, purchases: DataFrame, users: DataFrame) -> DataFrame:
    """All 20 payment features on the user spine."""
    cards = card_table(classify_attempts(tx, purchases))
    out = users.select(*USER_KEY)
    for table in (risk_from_cards(cards), failures_from_cards(cards)):
        out = out.join(table, list(USER_KEY), "left")
    fills = payment_fills()
    return out.select(*USER_KEY, *[fills[c].alias(c) for c in PAYMENT_COLUMNS])
