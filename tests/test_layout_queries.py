"""Every layout query against its SQL."""

import pytest

from vellumgrid.oracles import ORACLE_SQL
from vellumgrid.queries import QUERIES

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, same, name):
    same(QUERIES[name](spark, SMALL), ORACLE_SQL[name])


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).columns == ["page_id", "line_no", "region_id", "bucket_no", "order_no"]
