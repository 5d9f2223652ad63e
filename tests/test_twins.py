"""Every registered query against its SQL twin."""

import pytest
from compare import compare, duck

from millrace.plans import registry

registry.load_all()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, sf, name):
    problem, _ = compare(spark, con, sf, name)
    assert problem is None
