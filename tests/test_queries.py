"""Every registered query against its SQL at the smallest scale, where the data are there."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

from oracle import connect, differences

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(DATA), DATA, name, entry.queries()[name], entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["table_name", "row_id", "ref_id", "kind", "period"]
