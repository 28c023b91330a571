"""The registered queries of this subpackage."""

import re

import __spark_entry__ as entry
from listingflow.llm import queries


def test_one_query_per_operator_and_the_pipeline():
    names = entry.queries()
    numbers = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_queries_equal_sql(spark):
    import duckdb
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    for name, sql in queries.ORACLE.items():
        got = queries.QUERIES[name](spark, path).toPandas()
        want = con.execute(sql).df()[list(got.columns)]
        by = list(got.columns)
        got, want = (d.sort_values(by).reset_index(drop=True) for d in (got, want))
        assert len(got) == len(want) and all(((got[c] - want[c]).abs() < 1e-6).all() for c in by), name
