"""What plans may scan and shuffle, landing jobs included."""

import os
import sys

import pytest

from conftest import SF_SMALL
from lapse import catalog
from lapse.operators import materialize

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_report import plan_of, scans_of  # noqa: E402


@pytest.fixture
def no_broadcast(spark):
    """Joins as at scale: no broadcast by estimated or measured size."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def plans(spark, name: str) -> list[str]:
    """Plans of a query and of the tables it lands first."""
    found = []
    observer = lambda what, df: found.append(plan_of(df))
    materialize.observers.append(observer)
    try:
        df = catalog.QUERIES[name](spark, SF_SMALL)
    finally:
        materialize.observers.remove(observer)
    return [*found, plan_of(df)]


def scans(spark, name: str) -> list[tuple[str, list[str]]]:
    return [s for p in plans(spark, name) for s in scans_of(p)]


@pytest.mark.parametrize("name", ["payments_features", "failure_attribution", "user_features"])
def test_payment_attempts_scanned_once(spark, no_broadcast, name):
    # The attempts are the only reader of orders that needs their customer.
    attempts = [c for t, c in scans(spark, name) if t == "orders" and "o_totalprice" in c and "o_orderpriority" not in c]
    assert len(attempts) == 1


@pytest.mark.parametrize("name", ["activity_features", "gen_weekly", "gen_distinct_days_types", "gen_status_counts", "user_features"])
def test_events_scanned_once_and_never_expanded(spark, no_broadcast, name):
    assert [t for t, _ in scans(spark, name)].count("events") == 1
    assert not any("Expand" in p for p in plans(spark, name))


def test_a_query_reads_only_its_tables(spark):
    assert {t for t, _ in scans(spark, "label_index")} == {"customer"}
    assert {t for t, _ in scans(spark, "gen_status_counts")} <= {"events", "customer"}


def test_reports_read_only_landed_scores(spark):
    assert {t for t, _ in scans_of(plans(spark, "macro_f1")[-1])} == {"landed:prior-scores"}


@pytest.mark.parametrize("name", ["stage_report", "align_splits"])
def test_counts_shuffle_no_raw_rows(spark, no_broadcast, name):
    for plan in plans(spark, name):
        for part in plan.split("Exchange hashpartitioning(")[1:]:
            keys, _, below = part.partition("\n")
            below = below.split("Exchange")[0]
            if "user_id" in keys and "HashAggregate" not in below:
                # Only the user list itself may move row by row.
                assert {t for t, _ in scans_of(below)} <= {"customer"}, part[:400]


@pytest.mark.parametrize("name", ["purchases_features", "purchase_summary", "activity_features", "gen_distinct_days_types", "user_features"])
def test_aggregations_by_user_are_hash_aggregations(spark, no_broadcast, name):
    found = plans(spark, name)
    assert not any("ObjectHashAggregate" in p for p in found)
    if name in ("purchases_features", "activity_features"):
        assert not any("SortAggregate" in p for p in found)


def test_purchases_scanned_once_with_their_types(spark, no_broadcast):
    amounts = [c for t, c in scans(spark, "purchases_features") if t == "orders"]
    assert len(amounts) == 1


def test_joins_of_bucketed_tables_need_no_exchange(spark, no_broadcast):
    """Of the feature table's 44 exchanges with unbucketed landed tables, those
    by user are gone; what is left joins by date, card or country."""
    plan = plans(spark, "user_features")[-1]
    assert plan.count("Exchange hashpartitioning") <= 20
    left = [p.split("]")[0] for p in plan.split("Exchange hashpartitioning(")[1:]]
    by_user = [x for x in left if x.startswith("split") and "user_id" in x.split(",")[1]]
    assert len(by_user) <= 4


def test_attempts_are_not_sorted_to_find_their_purchase(spark, no_broadcast):
    from lapse.plans.payments import classify_attempts
    from lapse.sources.fixtures import load_inputs

    i = load_inputs(spark, SF_SMALL)
    plan = plan_of(classify_attempts(i.tx, i.purchases))
    # The join on the transaction, the outermost one, builds on the purchases.
    joins = [line for line in plan.splitlines() if "Join" in line and "transaction_id" in line]
    assert joins and all("ShuffledHashJoin" in line and "BuildRight" in line for line in joins)
