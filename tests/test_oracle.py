"""Every registered query against its SQL oracle (DuckDB) on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from pulse.plans import ORACLE_SQL, QUERIES  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = os.environ.get("PULSE_TEST_SF", "/root/testdata/sf0.001")
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF, name, E.queries()[name], ORACLE[name], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["logHour", "ct"]
    assert df.count() == 24
