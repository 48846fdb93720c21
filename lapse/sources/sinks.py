"""Result sinks: the submission tables, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lapse.plans.report import submission, submission_detailed


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write ``df`` in parallel; CSV gets a header line per part file."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_submission(decided: DataFrame, path: str, fmt: str = "csv") -> None:
    """``user_id, churn_status`` of every scored user."""
    write_table(submission(decided), path, fmt)


def write_submission_detailed(decided: DataFrame, path: str, fmt: str = "csv") -> None:
    """``user_id, predicted_class, prob_<class>..., confidence``."""
    write_table(submission_detailed(decided), path, fmt)
