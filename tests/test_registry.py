"""Every registered query against its SQL twin on the smallest tables."""

import inspect

import pytest

import __spark_entry__ as entry
from ledgerloom.registry import ORACLES, QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    for query in QUERIES.values():
        assert list(inspect.signature(query).parameters) == ["spark", "sf"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    n, problem = compare(spark, SF, name, QUERIES[name], ORACLES[name], con)
    assert problem == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["flat_range", "prevout_join", "chain_breaks", "dedup_identity",
                                  "block_tx_join", "control_unmatched"])
def test_no_pairwise_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
