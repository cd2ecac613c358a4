"""Every query against its SQL statement on another engine."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tallyward.catalog import QUERIES
from tests.compare import connect, differences

DIRECTORY = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(DIRECTORY)


# Operators no query may contain: Python workers, cross joins, nested loops.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result_and_plan(spark, connection, name):
    frame = entry_points.queries()[name](spark, DIRECTORY)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    assert differences(frame, name, connection) is None


def test_every_statement_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 2486
