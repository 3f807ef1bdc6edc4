"""Every registered query that has SQL gives the rows of that SQL."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
from check import compare, connect
from claimscope.plans.catalog import QUERIES

TRAINING = {"cv_auc", "train_ensemble", "train_forest_fallback", "train_metrics", "topk_importance",
            "importance_global", "model_store", "score_claims", "stream_score"}

#: The stream whose keyed state is a Python function.
PYTHON_STATE = {"stream_load"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", [k for k in entry_point.queries() if k not in TRAINING])
def test_query(spark, con, sf_dir, key, plans_since):
    status, note = compare(spark, con, sf_dir, key)
    if key in QUERIES:  # every step it ran, and not only the last plan
        bad = [p for p in plans_since() if re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|MapInArrow|FlatMapGroups", p)]
        assert not bad or key in PYTHON_STATE, bad[0]
    assert status in ("ok", "rows-only"), note
    assert status == "ok" or key not in entry_point.oracle_sql()


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5


def test_sql_has_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
