"""Every registered query runs and equals its SQL on the smallest tables."""

import os

import pytest

from quoteflow.plans import registry
from tests import oracle

SF = os.environ.get("QUOTEFLOW_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    assert not oracle.differences(spark, duck, registry.QUERIES[name], registry.ORACLE[name], SF)


def test_every_query_has_its_sql():
    assert set(registry.ORACLE) == set(registry.QUERIES)


def test_every_sql_text_belongs_to_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)
