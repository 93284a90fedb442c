"""Every query of the catalogue against its SQL on the smallest scale."""

import pytest
from side_by_side import compare, duck

from strataloom.plans import catalogue  # noqa: F401
from strataloom.plans.registry import CATALOGUE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR).startswith("ok")


def test_every_query_has_sql():
    assert [n for n, q in CATALOGUE.items() if q.sql is None] == []
