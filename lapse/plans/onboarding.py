"""Onboarding-quiz answers per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.numeric import to_number
from lapse.operators.keys import require_unique
from lapse.operators.spine import USER_KEY

# Quiz answer columns and the placeholder of a missing answer.
QUIZ_TEXT = ("source", "experience", "usage_plan", "frustration", "first_feature", "role")
QUIZ_PRESENCE = ("source", "experience", "frustration", "first_feature", "role")
MISSING = "missing"

QUIZ_COLUMNS = (
    "quiz_source", "quiz_team_size", "quiz_experience", "quiz_usage_plan",
    "quiz_frustration", "quiz_first_feature", "quiz_role", "has_quiz_data",
)


def quiz_table(quizzes: DataFrame) -> DataFrame:
    """One row per user with a quiz: renamed answers, parsed team size and
    ``has_quiz_data`` = any of five answers present. Duplicate rows fail."""
    q = require_unique(quizzes.select(*USER_KEY, "source", "team_size", *QUIZ_TEXT[1:]), "quizzes")
    return q.select(
        *USER_KEY,
        *[F.col(c).alias(f"quiz_{c}") for c in QUIZ_TEXT],
        to_number("team_size").alias("quiz_team_size"),
        F.coalesce(*[F.col(c) for c in QUIZ_PRESENCE]).isNotNull().cast("int").alias("has_quiz_data"),
    )


def quiz_fills() -> dict[str, F.Column]:
    out = {f"quiz_{c}": F.coalesce(F.col(f"quiz_{c}"), F.lit(MISSING)) for c in QUIZ_TEXT}
    out["quiz_team_size"] = F.coalesce(F.col("quiz_team_size"), F.lit(0.0))
    out["has_quiz_data"] = F.coalesce(F.col("has_quiz_data"), F.lit(0))
    return out


def quiz_features(quizzes: DataFrame, users: DataFrame) -> DataFrame:
    """Answers on the user spine: text null -> 'missing', team size parsed (bad -> 0),
    ``has_quiz_data`` = any of five answers present."""
    out = users.select(*USER_KEY).join(quiz_table(quizzes), list(USER_KEY), "left")
    fills = quiz_fills()
    return out.select(*USER_KEY, *[fills[c].alias(c) for c in QUIZ_COLUMNS])
