"""Every registered query beside its SQL on the smallest data."""

import pytest

from spindrift.queries import load
from tests.conftest import SF
from tests.oracle import compare, connect

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    matches, note = compare(spark, duck, SF, name)
    assert matches is not False, note


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
