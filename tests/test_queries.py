"""Every core query against its SQL."""

from __future__ import annotations

import oracle
import pytest

from quillon.plans.queries import ORACLE_SQL, QUERIES, flagship


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connection(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    oracle.same(QUERIES[name](spark, small), ORACLE_SQL[name], duck)


def test_entry_has_rows(spark, small):
    assert flagship(spark, small).count() > 0
