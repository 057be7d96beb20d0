"""Every query against its SQL twin on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402
from wardrisk.plans import catalog  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    problem, n = check_oracle.compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLES.get(name), SF_DIR)
    assert not problem
    assert n >= 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"lda_topics", "lda_counts", "lda_metrics"}
