"""Each query against its SQL on the test tables."""

from __future__ import annotations

import pytest

from tessellar.plans.oracles import ORACLES
from tessellar.plans.queries import QUERIES
from tests.oracle import DATA, check


@pytest.mark.parametrize("name", sorted(QUERIES))
@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, name, sf):
    df = QUERIES[name](spark, str(DATA / sf))
    if name in ORACLES:
        check(df, ORACLES[name], sf)
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
