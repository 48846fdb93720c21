"""lapse: churn-type feature engineering and scoring on Spark DataFrames.

Raw subscription tables (users, properties, purchases, payment attempts,
usage events, onboarding answers) are reduced to one feature row per user,
then encoded, clustered and scored with MLlib. Every feature is a
DataFrame expression so Catalyst plans it; nothing is collected to the
driver except model summaries.
"""

from lapse.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
