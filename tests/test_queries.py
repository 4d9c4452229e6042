"""Every registered query against its SQL; queries without SQL must give rows twice alike."""

import pytest
from oracle import compare, connect

from foldwise.plans import registry

SLOW = {
    "baseline_leaderboard", "regression_leaderboard", "further_models", "tune_random", "stacked",
}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_sql(spark, con, folder, name):
    assert compare(spark, con, name, registry.QUERIES[name], registry.ORACLE[name], folder) == []


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE) - SLOW))
def test_gives_rows(spark, folder, name):
    assert registry.QUERIES[name](spark, folder).take(1)


def test_entry_is_registered(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 8
