"""The three entry functions agree with each other."""

import __spark_entry__ as entry_module

from millrace.plans import registry


def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["c_custkey", "c_name", "n_name", "c_acctbal"] and df.count() > 0


def test_every_query_has_a_twin():
    entry_module.queries()
    assert set(registry.QUERIES) == set(registry.SQL) and len(registry.QUERIES) >= 140
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
