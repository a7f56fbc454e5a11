"""The driver contract."""

import __spark_entry__ as E
from corate.plans import catalog


def test_every_query_has_a_twin_or_is_declared_sql_free():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    # the reference's queries are all SQL-expressible; corpus operators come
    # from their own subpackage, which may be absent
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(q)


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == ["item_id", "neighbour_id", "sim", "rank"]
    assert df.count() > 0
