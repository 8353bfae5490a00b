"""The registered queries and the flagship query."""
import re

import __spark_entry__ as entry


def test_names_and_sql():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 200
    for name in queries:
        assert re.fullmatch(r"[a-z0-9_]+", name)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "rsi" in df.columns and "session" in df.columns
