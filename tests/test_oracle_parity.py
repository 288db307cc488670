"""Every registered key against its DuckDB oracle (the driver's check, on the
smallest scale so the suite stays quick; tests/parity.py runs it at sf0.01)."""

import pytest

from tests.parity import compare, duck
from tidewater.plans.catalog import REGISTRY

from .conftest import SF_SMALL

KEYS = [k for k, v in REGISTRY.items() if v.sql]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    r = compare(spark, REGISTRY[key], SF_SMALL, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    assert r["types_match"], r


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
