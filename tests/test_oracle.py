"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from tests.check_oracle import compare, duck
from tidewater import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) in ("", "both empty")


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
