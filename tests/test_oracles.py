"""Every registered query against its SQL."""

import oracle
import pytest

from landinglake.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf_dir, duck, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []
