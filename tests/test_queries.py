import pytest

import __spark_entry__ as entry
from oracle import SF, of_spark, of_sql
from voxweave import queries as core


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, name):
    got = of_spark(core.QUERIES[name](spark, SF))
    if name in core.SQL:
        assert got == of_sql(core.SQL[name])
    else:
        assert got[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
