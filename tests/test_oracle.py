"""Every query against its SQL text. TEST_SF_DIR names other test data."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from conftest import SMALL

SF_DIR = os.environ.get("TEST_SF_DIR", SMALL)
LLM = set(driver._llm_queries())  # these have tests of their own
QUERIES = {name: query for name, query in driver.queries().items() if name not in LLM}
ORACLE = {name: sql for name, sql in driver.oracle_sql().items() if name not in LLM}
NO_SQL = {"split_random", "rf_fit_predict", "rf_fit_predict_lite", "feature_importance", "forecast_24h"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


def test_random_split_keeps_every_row(spark):
    rows = QUERIES["split_random"](spark, SF_DIR)
    assert rows.count() == rows.select("reading_id").distinct().count()
