"""Plan-shape guard: no Cartesian products, nested-loop joins, sort-based
aggregates or Python UDFs in the registered (non-model) queries."""

import re

import pytest

from conftest import SF_SMALL

from cartographer.plans.registry import QUERIES, load_all

load_all()

MODEL_KEYS = {"churn_rf", "churn_lr", "churn_nb", "churn_dt", "churn_scores", "multi_category_rf",
              "category_propensities", "propensity_rf", "sentiment_rf", "sentiment_lr", "sentiment_dt",
              "sentiment_nb", "review_scores", "review_class_scores", "behaviour_clusters", "propensity_clusters", "cluster_profile",
              "propensity_pca", "churn_model_comparison", "churn_model_curves", "churn_model_confusion", "offer_scores", "next_best_offer_models",
              "sentiment_model_comparison"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "BatchEvalPython", "ArrowEvalPython"]
KEYS = sorted(k for k in QUERIES if k not in MODEL_KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [p for p in FORBIDDEN if re.search(p, plan)]
    assert not found, f"{key}: {found}"


@pytest.mark.parametrize("key", ["rfm", "churn_features"])
def test_customer_keyed_queries_read_buckets_without_a_shuffle(spark, key):
    """The prepared table is bucketed by customer: no exchange on customer_id follows its scan."""
    plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert not re.search(r"Exchange hashpartitioning\(customer_id", plan)
