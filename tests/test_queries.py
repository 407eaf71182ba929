"""Every registered query runs, and equals its oracle where it has one."""

import pytest
from helpers import duck_rows, spark_rows

from gristmill import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
#: Greedy, stateful or Python-bound queries, tested by behaviour instead.
NO_ORACLE = {"val3_segments", "agg11_trace_states", "ded7_near_dedup", "con5_status", "smp3_stratified"}


def test_every_query_has_an_oracle_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE
    assert len(ORACLES) >= 100


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, name):
    names, rows = spark_rows(QUERIES[name](spark, sf))
    want_names, want = duck_rows(ORACLES[name], sf)
    assert names == want_names
    assert rows == want


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
