import pytest
from oracle import compare, connect

from tidemark import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, con, name):
    compare(spark, con, registry.QUERIES[name], registry.ORACLES[name], SF)


def test_probed_recall_is_a_share(spark):
    (r,) = registry.QUERIES["ivf_recall"](spark, SF).first()
    assert 0 < r <= 1


def test_entry_runs():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
