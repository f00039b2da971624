import pytest

from checks.catalog import ORACLES, QUERIES
from checks.compare import compare
from tests.conftest import SF_DIR


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
