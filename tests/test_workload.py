"""Every workload query against its SQL over the smallest data set."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check_oracle

from __spark_entry__ import entry, oracle_sql, queries

from tillmark.workload.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = check_oracle.compare(spark, con, SF, name, oracle_sql().get(name))
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["store_id", "store_name", "city", "order_count", "revenue"]
    assert entry(spark).count() > 0
