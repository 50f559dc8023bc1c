"""Every registered query against its independent SQL."""

import pytest

from compare import assert_same
from shopfloor.oracle import oracle_sql
from shopfloor.registry import QUERIES

ORACLE = oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, folder, name):
    assert assert_same(QUERIES[name](spark, folder), duck, ORACLE[name]) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
