"""Every registered job against its DuckDB oracle at sf0.001."""

from .conftest import SF001
from .oracle_check import compare


def test_all_jobs_match_oracle(spark):
    res = compare(spark, SF001, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS-ONLY")}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["edition_id", "work_id", "time_id", "number_of_pages"]
    assert set(E.oracle_sql()) <= set(E.queries())
