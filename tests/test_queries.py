"""Every query against its SQL, on the driver's small tables."""

import pytest

from coverspark.plans.queries import QUERIES, SQL
from tests.oracle import differences

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert differences(QUERIES[name](spark, DIR), SQL[name], DIR) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0
