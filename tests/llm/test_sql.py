import pytest

from marlstone.llm.queries import oracle_sql, queries

from ..compare import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, name):
    got, want = compare(spark, connection(SF), queries()[name], oracle_sql()[name], SF)
    assert got == want


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries()} == set(range(1, 11))
