"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import sys

import pytest
from conftest import SF

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_oracles  # noqa: E402

import __spark_entry__ as contract  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == [
        "id", "image", "price_raw", "currency_original", "year", "make", "model", "engine", "location", "mileage", "fuel",
    ]
    assert len(frame.collect()) <= 24


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    outcome = check_oracles.compare(spark, con, name, SF)
    assert outcome.startswith(("ok", "rows-only")), outcome
