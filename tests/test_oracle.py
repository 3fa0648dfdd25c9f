"""Every registered plan against its DuckDB oracle (the driver's correctness gate).

Runs on sf0.001 by default; set TRIPWIRE_ORACLE_SF=/root/testdata/sf0.01 for the
driver's scale."""

import os

import pytest

import __spark_entry__ as entry_module
from oracle_compare import compare, duck

SF = os.environ.get("TRIPWIRE_ORACLE_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables absent")

# the engine's own plans; the optional corpus queries have tests of their own
QUERIES, ORACLES = entry_module.ENGINE_QUERIES, entry_module.ENGINE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert result["ok"], result


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["window_start", "window_end", "user_id", "ip_address", "anomaly_type", "severity",
                          "event_count", "total_amount", "details"]
    assert df.count() == 129  # 30 + 49 + 50 alerts at sf0.001
