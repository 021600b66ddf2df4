"""Every registered query against its oracle SQL on the smallest sample."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return compare.connect(sf)


def test_contract(spark):
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) > 100
    assert len(contract.entry(spark).collect()) == 20


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf, key):
    message, _ = compare.compare(spark, duck, sf, key, QUERIES[key], ORACLE.get(key))
    assert message.startswith(("ok", "rows only")), message
    assert not message.startswith(("ok 0", "rows only 0")) or key in {"market_day_scan"}


@pytest.mark.parametrize("key", ["or_join_users", "price_tx_join", "lag_health", "market_gold", "corridor_share"])
def test_no_cross_join_in_the_plan(spark, sf, key):
    plan = QUERIES[key](spark, sf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
