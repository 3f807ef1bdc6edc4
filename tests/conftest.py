from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from claimscope.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", **{
        "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plans_since(spark):
    """A function that gives the physical plans run since its last call, those of eager steps and writes among them."""
    store = spark._jsparkSession.sharedState().statusStore()
    last = [-1]

    def plans() -> list[str]:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        runs, n = [], store.executionsList()
        for i in range(n.size() - 1, -1, -1):
            run = n.apply(i)
            if run.executionId() <= last[0]:
                break
            runs.append((run.executionId(), run.physicalPlanDescription()))
        last[0] = max([last[0], *[i for i, _ in runs]])
        return [text for _, text in reversed(runs)]

    plans()
    return plans


@pytest.fixture(scope="session")
def sf_dir():
    return os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.001")


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(
        [(None, 35, 5000.0, 0), ("POL123", -5, None, 0), ("POL456", 150, -1000.0, 10)],
        "policy_number string, age int, total_claim_amount double, witnesses int")


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [("POL1", 12, 25, "OH", 1200.0, 5000.0, "N", None), ("POL2", None, 35, " ny ", 800.0, 15000.0, "Y", "x"),
         ("POL3", 0, None, None, None, 0.0, "N", None), ("POL4", 500, 100, "3rd o'neil-PhD", 100.5, None, "y", None)],
        "policy_number string, months_as_customer int, age int, policy_state string, policy_annual_premium double, "
        "total_claim_amount double, fraud_reported string, _c39 string")
