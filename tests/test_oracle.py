"""Every query of the core that has SQL gives the same rows."""

import pytest

from tests.oracle import same
from tickflow.plans import registry


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, sf, name):
    same(registry.QUERIES[name](spark, sf), registry.SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf.replace("sf0.001", "sf0.01")).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(registry.QUERIES) <= set(e.queries())
