"""The six input views of the churn engine, derived from the driver tables.

The engine's raw inputs are users, properties, purchases, payment attempts,
usage events ("generations") and onboarding answers. The test data has
none of these, so each is a deterministic view over the TPC-H-like tables
(see FIXTURES.md). The views are built with the DataFrame API here and
kept as SQL text in ``FIXTURE_SQL`` for the DuckDB oracle; both give the
same rows.

Instead of train/test file twins every view carries a ``split`` column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.sources.tables import Tables

# Class and split assignment of the fixture users.
NOT_CHURNED = "not_churned"
VOL_CHURN = "vol_churn"
INVOL_CHURN = "invol_churn"


def _split_of(key: Column) -> Column:
    return F.when(key % 5 < 3, F.lit("train")).otherwise(F.lit("test"))


def users_view(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("user_id"),
        F.when((k % 4).isin(0, 1), F.lit(NOT_CHURNED))
        .when(k % 4 == 2, F.lit(VOL_CHURN))
        .otherwise(F.lit(INVOL_CHURN))
        .alias("churn_status"),
        _split_of(k).alias("split"),
    )


def props_view(t: Tables) -> DataFrame:
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_ts"))
    k = F.col("c_custkey")
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first, F.col("o_custkey") == k)
        .select(
            _split_of(k).alias("split"),
            k.alias("user_id"),
            F.col("c_mktsegment").alias("subscription_plan"),
            F.when(k % 37 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("n_name"))
            .alias("country_code"),
            F.expr("first_ts + INTERVAL '1' HOUR * CAST(c_custkey % 24 AS INT)")
            .cast("string")
            .alias("subscription_start_date"),
        )
    )


def purchases_view(t: Tables) -> DataFrame:
    o = t.orders
    k = F.col("o_custkey")
    return o.where(F.col("o_orderstatus") == "F").select(
        _split_of(k).alias("split"),
        F.when(F.col("o_orderkey") % 41 != 0, F.col("o_orderkey")).alias("transaction_id"),
        # Every 13th customer's purchases belong to buyers who are no users.
        F.when(k % 13 == 0, -k).otherwise(k).alias("user_id"),
        (F.col("o_totalprice") / 1000).alias("purchase_amount_dollars"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Subscription Create"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Subscription Update"))
        # A type of one split only.
        .when((F.col("o_orderpriority") == "5-LOW") & (k % 5 == 4), F.lit("Gift Card"))
        .otherwise(F.lit("Credits Package"))
        .alias("purchase_type"),
        F.col("o_orderdate").cast("string").alias("purchase_time"),
    )


def tx_view(t: Tables) -> DataFrame:
    ok = F.col("o_orderkey")
    ck = F.col("c_custkey")
    null_str = F.lit(None).cast("string")
    codes = (
        F.when(ok % 7 == 0, F.lit("card_declined"))
        .when(ok % 7 == 1, F.lit("expired_card"))
        .when(ok % 7 == 2, F.lit("incorrect_cvc"))
        .when(ok % 7 == 3, F.lit("incorrect_number"))
        .when(ok % 7 == 4, F.lit("processing_error"))
        .when(ok % 7 == 5, F.lit("do_not_honor"))
    )
    return (
        t.orders.join(t.customer, F.col("o_custkey") == ck)
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            ok.alias("transaction_id"),
            _split_of(ck).alias("split"),
            F.when(ok % 23 == 0, null_str).otherwise(F.col("c_mktsegment")).alias("card_brand"),
            F.col("n_name").alias("card_country"),
            F.when(ok % 3 == 0, F.lit("credit"))
            .when(ok % 3 == 1, F.lit("debit"))
            .otherwise(F.lit("prepaid"))
            .alias("card_funding"),
            F.when(ck % 11 == 0, null_str)
            .otherwise(F.concat(F.lit("BANK_"), (ck % 3).cast("string")))
            .alias("bank_name"),
            F.when(ok % 10 == 0, F.lit("NATION_0"))
            .when(ok % 29 == 0, null_str)
            .otherwise(F.col("n_name"))
            .alias("billing_address_country"),
            F.when(ok % 31 == 0, F.lit(None).cast("boolean"))
            .otherwise(ok % 5 == 0)
            .alias("is_prepaid"),
            (ok % 7 == 0).alias("is_virtual"),
            (ok % 6 == 0).alias("is_business"),
            (ok % 4 == 0).alias("is_3d_secure"),
            F.when(ok % 4 == 0, F.lit("apple_pay"))
            .when(ok % 4 == 1, F.lit("none"))
            .otherwise(null_str)
            .alias("digital_wallet"),
            F.when(ok % 9 == 0, F.lit("fail"))
            .when(ok % 9 == 1, null_str)
            .otherwise(F.lit("pass"))
            .alias("cvc_check"),
            (F.col("o_totalprice") / 1000).alias("amount_in_usd"),
            F.when(F.col("o_orderstatus") == "F", null_str).otherwise(codes).alias("failure_code"),
        )
    )


def generations_view(t: Tables) -> DataFrame:
    return generations_of(t.events)


def generations_of(e: DataFrame) -> DataFrame:
    """Usage events from the raw events (also a stream of them)."""
    uid = F.col("user_id")
    ts = F.col("ts")
    eid = F.col("event_id")
    # Some users' events are moved in time: all to the first day, off every
    # third day, or into the first nine days.
    back = (
        F.when((uid % 7 == 0) & (ts >= F.expr("TIMESTAMP '2024-01-02 12:00:00'")), F.dayofmonth(ts) - 1)
        .when((uid % 7 == 1) & (F.dayofmonth(ts) % 3 == 0), F.lit(1))
        .when((uid % 7 == 2) & (ts >= F.expr("TIMESTAMP '2024-01-10 00:00:00'")), F.dayofmonth(ts) - 1 - F.dayofmonth(ts) % 9)
        .otherwise(F.lit(0))
        .cast("int")
    )
    null_str = F.lit(None).cast("string")
    moved = e.withColumn("_back", back)
    return moved.select(
        _split_of(uid).alias("split"),
        eid.alias("generation_id"),
        uid,
        F.expr("CAST(ts - INTERVAL '1' DAY * _back AS STRING)").alias("created_at"),
        F.when(F.col("event_type") == "error", F.lit("failed"))
        .when(F.col("event_type") == "view", F.lit("nsfw"))
        .when(F.col("event_type") == "signup", F.lit("canceled"))
        .otherwise(F.lit("completed"))
        .alias("status"),
        F.when(eid % 5 == 0, F.lit("text_to_image"))
        .when(eid % 5 == 1, F.lit("image_to_video"))
        .when(eid % 5 == 2, F.lit("Text_To_Video"))
        .when(eid % 5 == 3, F.lit("audio"))
        .otherwise(null_str)
        .alias("generation_type"),
        F.when(eid % 17 == 0, F.lit("n/a"))
        .when(eid % 19 == 0, null_str)
        .when(eid % 23 == 0, F.lit("nan"))
        .when(eid % 29 == 0, F.lit("1d"))
        .otherwise(F.col("value").cast("string"))
        .alias("credit_cost"),
        F.when((eid % 5).isin(1, 2), (eid % 30).cast("string"))
        .otherwise(null_str)
        .alias("duration"),
    )


def quizzes_view(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    null_str = F.lit(None).cast("string")
    return t.customer.select(
        _split_of(k).alias("split"),
        # Every third answer row belongs to nobody on the user list.
        F.when(k % 3 == 0, -k).otherwise(k).alias("user_id"),
        F.when(k % 4 == 0, null_str).otherwise(F.concat(F.lit("src"), (k % 6).cast("string"))).alias("source"),
        F.when(k % 11 == 0, F.lit("unknown"))
        .when(k % 7 == 0, null_str)
        .when(k % 10 == 1, F.lit("NaN"))
        .otherwise((k % 50).cast("string"))
        .alias("team_size"),
        F.when(k % 4 == 0, null_str).otherwise(F.lit("beginner")).alias("experience"),
        F.col("c_mktsegment").alias("usage_plan"),
        F.when(k % 8 == 1, F.lit('too "dear", I\nthink')).otherwise(null_str).alias("frustration"),
        F.when(k % 4 == 0, null_str).otherwise(F.lit("video")).alias("first_feature"),
        F.when(k % 16 == 4, F.lit("creator")).otherwise(null_str).alias("role"),
    )


@dataclass
class ChurnInputs:
    """The six inputs of the engine, as lazy DataFrames."""

    users: DataFrame
    props: DataFrame
    purchases: DataFrame
    tx: DataFrame
    generations: DataFrame
    quizzes: DataFrame


def load_inputs(spark: SparkSession, sf_dir: str) -> ChurnInputs:
    t = Tables(spark, sf_dir)
    return ChurnInputs(
        users=users_view(t),
        props=props_view(t),
        purchases=purchases_view(t),
        tx=tx_view(t),
        generations=generations_view(t),
        quizzes=quizzes_view(t),
    )


# SQL text of the same views (FIXTURES.md); runs in DuckDB and Spark SQL.
FIXTURE_SQL = {
    "users": """
SELECT c_custkey AS user_id,
       CASE WHEN c_custkey % 4 IN (0,1) THEN 'not_churned' WHEN c_custkey % 4 = 2 THEN 'vol_churn' ELSE 'invol_churn' END AS churn_status,
       CASE WHEN c_custkey % 5 < 3 THEN 'train' ELSE 'test' END AS split
FROM customer""",
    "props": """
SELECT CASE WHEN c_custkey % 5 < 3 THEN 'train' ELSE 'test' END AS split,
       c_custkey AS user_id,
       c_mktsegment AS subscription_plan,
       CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE n_name END AS country_code,
       CAST(first_ts + INTERVAL '1' HOUR * CAST(c_custkey % 24 AS INT) AS STRING) AS subscription_start_date
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_ts
FROM orders GROUP BY o_custkey) f ON o_custkey = c_custkey""",
    "purchases": """
SELECT CASE WHEN o_custkey % 5 < 3 THEN 'train' ELSE 'test' END AS split,
       CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey END AS transaction_id,
       CASE WHEN o_custkey % 13 = 0 THEN -o_custkey ELSE o_custkey END AS user_id,
       o_totalprice / 1000 AS purchase_amount_dollars,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Subscription Create' WHEN o_orderpriority = '2-HIGH' THEN 'Subscription Update'
            WHEN o_orderpriority = '5-LOW' AND o_custkey % 5 = 4 THEN 'Gift Card' ELSE 'Credits Package' END AS purchase_type,
       CAST(o_orderdate AS STRING) AS purchase_time
FROM orders
WHERE o_orderstatus = 'F'""",
    "tx": """
SELECT o_orderkey AS transaction_id,
       CASE WHEN c_custkey % 5 < 3 THEN 'train' ELSE 'test' END AS split,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE c_mktsegment END AS card_brand,
       n_name AS card_country,
       CASE o_orderkey % 3 WHEN 0 THEN 'credit' WHEN 1 THEN 'debit' ELSE 'prepaid' END AS card_funding,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CONCAT('BANK_', CAST(c_custkey % 3 AS STRING)) END AS bank_name,
       CASE WHEN o_orderkey % 10 = 0 THEN 'NATION_0' WHEN o_orderkey % 29 = 0 THEN NULL ELSE n_name END AS billing_address_country,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey % 5 = 0 END AS is_prepaid,
       o_orderkey % 7 = 0 AS is_virtual,
       o_orderkey % 6 = 0 AS is_business,
       o_orderkey % 4 = 0 AS is_3d_secure,
       CASE o_orderkey % 4 WHEN 0 THEN 'apple_pay' WHEN 1 THEN 'none' ELSE NULL END AS digital_wallet,
       CASE o_orderkey % 9 WHEN 0 THEN 'fail' WHEN 1 THEN NULL ELSE 'pass' END AS cvc_check,
       o_totalprice / 1000 AS amount_in_usd,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CASE o_orderkey % 7 WHEN 0 THEN 'card_declined' WHEN 1 THEN 'expired_card' WHEN 2 THEN 'incorrect_cvc' WHEN 3 THEN 'incorrect_number' WHEN 4 THEN 'processing_error' WHEN 5 THEN 'do_not_honor' ELSE NULL END END AS failure_code
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey""",
    "generations": """
SELECT CASE WHEN user_id % 5 < 3 THEN 'train' ELSE 'test' END AS split,
       event_id AS generation_id,
       user_id,
       CAST(ts - INTERVAL '1' DAY * CAST(CASE
         WHEN user_id % 7 = 0 AND ts >= TIMESTAMP '2024-01-02 12:00:00' THEN EXTRACT(DAY FROM ts) - 1
         WHEN user_id % 7 = 1 AND EXTRACT(DAY FROM ts) % 3 = 0 THEN 1
         WHEN user_id % 7 = 2 AND ts >= TIMESTAMP '2024-01-10 00:00:00' THEN EXTRACT(DAY FROM ts) - 1 - EXTRACT(DAY FROM ts) % 9
         ELSE 0 END AS INT) AS STRING) AS created_at,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'nsfw' WHEN 'signup' THEN 'canceled' ELSE 'completed' END AS status,
       CASE event_id % 5 WHEN 0 THEN 'text_to_image' WHEN 1 THEN 'image_to_video' WHEN 2 THEN 'Text_To_Video' WHEN 3 THEN 'audio' ELSE NULL END AS generation_type,
       CASE WHEN event_id % 17 = 0 THEN 'n/a' WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 'nan' WHEN event_id % 29 = 0 THEN '1d' ELSE CAST(value AS STRING) END AS credit_cost,
       CASE WHEN event_id % 5 IN (1,2) THEN CAST(event_id % 30 AS STRING) ELSE NULL END AS duration
FROM events""",
    "quizzes": """
SELECT CASE WHEN c_custkey % 5 < 3 THEN 'train' ELSE 'test' END AS split,
       CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS user_id,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CONCAT('src', CAST(c_custkey % 6 AS STRING)) END AS source,
       CASE WHEN c_custkey % 11 = 0 THEN 'unknown' WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'NaN' ELSE CAST(c_custkey % 50 AS STRING) END AS team_size,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'beginner' END AS experience,
       c_mktsegment AS usage_plan,
       CASE WHEN c_custkey % 8 = 1 THEN 'too "dear", I' || chr(10) || 'think' ELSE NULL END AS frustration,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'video' END AS first_feature,
       CASE WHEN c_custkey % 16 = 4 THEN 'creator' ELSE NULL END AS role
FROM customer""",
}


def fixture_ctes() -> str:
    """``users AS (...), props AS (...), ...`` for the head of a WITH clause."""
    return ",\n".join(f"{name} AS ({sql}\n)" for name, sql in FIXTURE_SQL.items())
