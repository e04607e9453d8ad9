import pytest

from marlstone.queries import oracle_sql, queries

from .compare import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_equals_standard_sql(spark, con, name):
    got, want = compare(spark, con, queries()[name], oracle_sql()[name], SF)
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
