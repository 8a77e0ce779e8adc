"""Every catalogue query against its SQL on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import parity
from storecast.plans.catalog import QUERIES
from storecast.plans.oracles import ORACLES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")

MODELS = {"pca_scores", "elbow_curve", "segment_stores", "train_forecast", "score_forecast",
          "feature_importance", "seasonal_order_search", "seasonal_fitted",
          "seasonal_order_search_suppliers", "train_and_score"}


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF_DIR)


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == MODELS and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert parity.compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name]) is None


SLOW = {"score_forecast", "feature_importance", "train_and_score"}


@pytest.mark.parametrize("name", sorted(MODELS - SLOW))
def test_model_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_golden_anomaly_counts(spark):
    for sf, n in (("sf0.001", 12), ("sf0.01", 482)):
        path = f"/root/testdata/{sf}"
        assert QUERIES["anomaly_summary"](spark, path).first()["total_anomalies"] == n
