"""Every driver query against its SQL in DuckDB, on the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import oracle_check
import pytest

import __spark_entry__ as entry
from rosterlens.plans.driver_queries import QUERIES
from rosterlens.plans.driver_sql import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) >= {"req_id", "network_id", "npi_count"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert oracle_check.differences(df, con, entry.oracle_sql()[name]) is None
