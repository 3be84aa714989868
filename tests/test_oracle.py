"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from conftest import SF_DIR

from workload.check import compare
from workload.oracles import ORACLES
from workload.queries import QUERIES


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["puuid", "tier", "league_points"]
    assert contract.entry(spark).count() > 0
