"""Decisions, evaluation and report tables over scored users.

A scored table has ``split``, ``user_id``, the class probabilities
``prob_<class>`` (classes in code order) and, for evaluated rows, ``target``.
The classes are those of its columns. The same functions serve the forest's
output and the weighted country prior.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROB = "prob_"
NOT_CHURNED = "not_churned"
TOP_K = 10


def prob_columns(scored: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in scored.columns if c.startswith(PROB))


def _class_names(scored: DataFrame) -> F.Column:
    return F.array(*[F.lit(c.removeprefix(PROB)) for c in prob_columns(scored)])


def decide(scored: DataFrame) -> DataFrame:
    """prediction = argmax (first class on ties), confidence = max probability."""
    p = F.array(*[F.col(c) for c in prob_columns(scored)])
    pred = (F.array_position(p, F.array_max(p)) - 1).cast("int")
    return scored.withColumns(
        {"prediction": pred, "predicted_class": F.get(_class_names(scored), pred), "confidence": F.array_max(p)}
    )


def prior_scores(te: DataFrame, classes: tuple[str, ...], col: str = "country_code") -> DataFrame:
    """Baseline scorer: the class shares of the user's country (out of fold for
    train users, full-train shares for test users), each times a fixed weight
    of 1 to 5 that depends on user and class, normalised. The weights make
    every class win somewhere, which the bare shares do not."""
    raw = [F.col(f"{col}_te_cls{k}") * (1 + (F.col("user_id") * (k + 2) + 3 * k) % 5) for k in range(len(classes))]
    total = sum(raw[1:], raw[0])
    return te.select("split", "user_id", *[F.try_divide(r, total).alias(f"{PROB}{c}") for r, c in zip(raw, classes)])


def confusion_matrix(decided: DataFrame) -> DataFrame:
    """Rows per (true target, predicted class code)."""
    return decided.groupBy("target", "prediction").agg(F.count(F.lit(1)).alias("n_users"))


def _class_table(decided: DataFrame) -> DataFrame:
    """Per class: support, true positives, predicted count (a few rows)."""
    truth = decided.groupBy(F.col("target").alias("class_id")).agg(
        F.count(F.lit(1)).alias("support"), F.count_if(F.col("prediction") == F.col("target")).alias("_tp")
    )
    predicted = decided.groupBy(F.col("prediction").alias("class_id")).agg(F.count(F.lit(1)).alias("_np"))
    t = truth.join(predicted, "class_id", "full_outer").na.fill(0, subset=["support", "_tp", "_np"])
    precision = F.when(F.col("_np") > 0, F.col("_tp") / F.col("_np")).otherwise(F.lit(0.0))
    recall = F.when(F.col("support") > 0, F.col("_tp") / F.col("support")).otherwise(F.lit(0.0))
    pr = precision + recall
    return t.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "f1": F.when(pr > 0, 2 * precision * recall / pr).otherwise(F.lit(0.0)),
        }
    )


def classification_report(decided: DataFrame) -> DataFrame:
    """Per class: precision, recall, f1, support (0 where undefined)."""
    names = _class_names(decided)
    return _class_table(decided).select(
        "class_id", F.get(names, F.col("class_id")).alias("class_name"),
        "precision", "recall", "support", "f1",
    )


def macro_f1(decided: DataFrame) -> DataFrame:
    """One row: unweighted mean of per-class F1, accuracy, users evaluated
    (all read off the per-class table)."""
    return _class_table(decided).agg(
        F.avg("f1").alias("macro_f1"),
        (F.sum("_tp") / F.sum("support")).alias("accuracy"),
        F.sum("support").alias("n_users"),
    )


def prediction_distribution(decided: DataFrame) -> DataFrame:
    """Users per predicted class and their share (label distribution report)."""
    counts = decided.groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n_users"))
    return counts.withColumn("share", F.col("n_users") / F.sum("n_users").over(Window.partitionBy()))


def mean_probabilities(decided: DataFrame) -> DataFrame:
    return decided.agg(*[F.avg(c).alias(c) for c in prob_columns(decided)])


def churn_share(decided: DataFrame) -> DataFrame:
    """Users scored and the share predicted to churn (any churn class)."""
    return decided.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.avg((F.col("predicted_class") != NOT_CHURNED).cast("double")).alias("churn_share"),
    )


def top_confident(decided: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k most confident users (ties by user id): a top-k, so a limit."""
    return decided.orderBy(F.desc("confidence"), F.asc("user_id")).limit(k).select(
        "user_id", "predicted_class", *prob_columns(decided), "confidence"
    )


def display_top(top: DataFrame, id_chars: int = 12) -> DataFrame:
    """Dashboard rows: id cut to ``id_chars`` characters plus '...', confidence
    as a percent with one decimal."""
    return top.select(
        F.concat(F.substring(F.col("user_id").cast("string"), 1, id_chars), F.lit("...")).alias("user_label"),
        "predicted_class",
        F.format_string("%.1f%%", F.col("confidence") * 100).alias("confidence_pct"),
        F.round(F.col("confidence") * 100, 1).alias("bar_width"),
    )


def submission(decided: DataFrame) -> DataFrame:
    """``user_id, churn_status`` (the predicted class) of one split's users."""
    return decided.select("user_id", F.col("predicted_class").alias("churn_status"))


def submission_detailed(decided: DataFrame) -> DataFrame:
    return decided.select("user_id", "predicted_class", *prob_columns(decided), "confidence")
