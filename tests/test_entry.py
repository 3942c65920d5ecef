"""Driver contract: entry runs, every query has a stable schema, oracle
keys are a subset of the query keys."""

import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"year_month", "payments", "successful_payments", "revenue"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 35
