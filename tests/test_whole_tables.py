import pytest

from marlstone.queries import oracle_sql, queries

from .compare import compare, connection

SF = "/root/testdata/sf0.01"
TABLES = {
    "division_by_zero_is_null": "orders", "index_hints": "customer", "filter_bit_operators": "orders", "filter_json": "events", "func_string_1": "customer",
    "func_string_2": "customer", "func_string_3": "documents", "func_dates": "orders", "func_cast": "customer",
}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_every_row_of_the_table_is_computed(spark, name):
    con = connection(SF)
    got, want = compare(spark, con, queries()[name], oracle_sql()[name], SF)
    assert got == want
    assert len(got[1]) == con.sql(f"select count(*) from {TABLES[name]}").fetchall()[0][0]


def test_texts_are_measured_whole(spark):
    longest = connection(SF).sql("select max(length(text)), max(strlen(text)) from documents").fetchall()[0]
    rows = queries()["func_string_3"](spark, SF).collect()
    assert (max(r.c for r in rows), max(r.b for r in rows)) == longest
