"""Driver contract: entry runs, every query has an oracle, schemas stable."""

import __spark_entry__ as E
from shopfloor.plans import catalog


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["seq", "event_id", "machine_id", "anomaly_score", "anomaly_flags"]
    assert all(r.anomaly_score >= 0.5 for r in rows)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_oracles_match_at_small_scale(spark):
    from tests.conftest import SF001
    from tests.oracle_compare import compare
    res = compare(spark, list(catalog.QUERIES), SF001, verbose=False)
    assert all(res.values()), [k for k, v in res.items() if not v]
