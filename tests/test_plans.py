"""Physical plans of the registered batch queries."""

import pytest

import __spark_entry__ as entry
from riskspark.operators import metrics, profiles
from riskspark.sources import views

SLOW = {
    "ablation", "cross_validate", "train_eval", "score_batch", "gbt_scores", "logistic_baseline", "explain_batch",
    "tree_contributions", "tree_importance", "tree_importance_by_class", "tree_additivity", "score_batch_rows",
    "logistic_by_formula", "bootstrap_ci", "bootstrap_significance",
}
NAMES = sorted(n for n in entry.queries() if not n.startswith("stream_") and n not in SLOW)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(metrics.latency_percentiles(views.table(spark, sf, "events").filter("user_id > 3"), "value"))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans
    for line in scans:
        assert "GreaterThan(user_id,3)" in line and "ReadSchema: struct<user_id:bigint,value:double>" in line


def test_small_profiles_are_broadcast(spark, sf):
    df = views.tx_events(spark, sf)
    out = profiles.add_merchant_risk(df, profiles.risk_profile(df))
    assert "BroadcastHashJoin" in plan_of(out)


def test_profiles_combine_before_the_shuffle(spark, sf):
    plan = plan_of(profiles.card_stats(views.tx_events(spark, sf)))
    assert plan.count("Exchange ") == 1 and "partial_avg" in plan
