"""Every operator that has SQL against it."""

import sys
from pathlib import Path

import oracle
import pytest

from landinglake.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, sf_dir, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir),
                              ORACLES[name]) == []


def test_there_is_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
