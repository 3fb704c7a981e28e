"""Every query with a SQL counterpart agrees with it on all tables."""

import pytest

import __spark_entry__ as contract
from checks import compare
from checks.oracles import ORACLES

#: Fits of whole models, about half a minute each; ``python -m checks.compare`` runs them, tests/test_models.py their parts.
FITS = {
    "svm_scores", "svm_rbf_scores", "knn_scores", "rf_scores", "gbt_scores", "soft_vote", "random_search", "lda_topics",
    "pca_variance", "training_run", "softmax_boost_scores", "random_search_draws", "relu_head_scores", "guided_trials", "pruned_forest_scores",
}


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_contract(spark):
    registered, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(registered) and len(registered) >= 85 and set(ORACLES) <= set(sql)
    assert contract.entry(spark).count() == 200


@pytest.mark.parametrize("name", sorted(set(ORACLES) - FITS))
def test_against_sql(spark, con, small, name):
    good, note = compare.compare(spark, con, small, name)
    assert good, note
