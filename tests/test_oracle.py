"""Every registered query against its DuckDB oracle (the driver's correctness gate), at sf0.001."""

import pytest

from conftest import SF_SMALL
from listingflow.plans.registry import ORACLE, QUERIES
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name not in ORACLE:
        assert df.count() > 0
        return
    result = compare(df, ORACLE[name], con)
    assert result["ok"], result


def test_entry_contract(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["Developer_Name", "best_score", "avg_score", "listings"]
    df.collect()
