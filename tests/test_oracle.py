"""Every query with a SQL twin returns the same rows as DuckDB (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_compare import compare, duck  # noqa: E402

from keysieve.plans.registry import ORACLE, QUERIES, load_all  # noqa: E402

load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    info = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], con)
    assert info["ok"], info


def test_every_query_is_registered_with_a_callable():
    assert len(QUERIES) >= 70
    assert set(ORACLE) <= set(QUERIES)
