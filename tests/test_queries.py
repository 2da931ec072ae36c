"""Every registered query against its SQL twin, and the shape of some plans."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402

SLOW = {  # searches and sweeps, run one by one by the comparison tool
    "linear_regression_predict", "gbt_regression_predict", "rf_regression_predict",
    "logistic_predict", "svm_predict", "rf_classify_predict", "cross_validate_grid",
    "train_validation_grid", "grid_search_leaderboard", "kmeans_cost_sweep",
    "kmeans_entropy_sweep", "text_classify", "kmeans_cluster_labels", "decision_tree_predict",
    "model_parameter_table", "categorical_tree_predict", "kmeans_anomalies",
    "leaderboard_is_sorted", "reloaded_search_scores_as_before", "claims_severity_job_ids",
    "text_probabilities_add_up", "forest_predictions_are_known_classes", "cost_sweep_has_every_point",
    "cluster_labels_add_up", "churn_tree_grid",
}


@pytest.fixture(scope="module")
def connection(folder):
    found = duckdb.connect()
    for table in compare.TABLES:
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(set(compare.QUERIES) - SLOW))
def test_query(spark, connection, folder, name):
    verdict, detail = compare.compare(spark, connection, name, folder)
    assert verdict in ("same", "rows"), f"{verdict}: {detail}"


def test_entry(spark, folder):
    assert contract.entry(spark).count() > 0


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(compare.QUERIES) <= set(contract.queries())
    assert not [n for n in compare.QUERIES if n.startswith("op") or n == "pipeline"]


def test_filters_and_columns_reach_the_scan(spark, folder, plan_text):
    plan = plan_text(contract.queries()["filter_predicates"](spark, folder))
    assert "PushedFilters: [" in plan and "EqualTo(l_returnflag,R)" in plan
    assert "l_shipdate" not in plan and "l_extendedprice" not in plan


def test_reports_read_the_table_once(spark, folder, plan_text):
    for name in ("binary_outcome_report", "regression_metrics", "column_profile"):
        plan = plan_text(contract.queries()[name](spark, folder))
        assert plan.count("Location:") == 1, name


def test_counts_combine_before_the_shuffle(spark, folder, plan_text):
    plan = plan_text(contract.queries()["join_multiplicity_count"](spark, folder))
    first_exchange = plan.index("Exchange")
    assert "HashAggregate" in plan[first_exchange:]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize(
    "name",
    ["grouping_sets_mixed", "interaction_counts", "popularity_predict", "chi_square_stat",
     "weighted_group_entropy", "class_priors", "mean_user_auc_popularity", "threshold_curve"],
)
def test_no_pairs_are_made(spark, folder, plan_text, name):
    plan = plan_text(contract.queries()[name](spark, folder))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
