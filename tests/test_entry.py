"""The driver's three functions."""

import __spark_entry__ as contract
from landinglake.registry import ORACLES, QUERIES


def test_contract(spark):
    assert set(QUERIES) == set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert "flagship" in contract.queries()
    first = contract.entry(spark)
    assert first.columns == ["year", "month", "day", "records", "users", "total_value"]
    assert first.count() > 0
