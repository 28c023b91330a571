"""Driver contract: names, oracle coverage and flagship schema."""

import re

import __spark_entry__ as entry
from listingflow.plans import registry


def test_every_query_has_an_oracle_with_a_plain_name():
    queries, oracle = registry.QUERIES, registry.ORACLE
    assert set(oracle) == set(queries) and set(queries) <= set(entry.queries())
    for name in queries:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert "pipeline" not in name and not re.match(r"op\d+_", name)


def test_oracle_sql_reads_only_driver_tables():
    allowed = set("region nation customer supplier part orders lineitem events documents "
                  "embeddings pages benchmark labels conversations".split())
    for name, sql in registry.ORACLE.items():
        sql = re.sub(r"'([^']|'')*'", "''", sql)          # generated SQL inside literals
        for table in re.findall(r"(?<!DISTINCT )\b(?:FROM|JOIN)\s+([a-z_][a-z0-9_]*)\b", sql,
                                flags=re.I):
            assert table in allowed or re.search(rf"\b{table}\s+AS\s*\(", sql, flags=re.I) \
                or table in ("information_schema", "range"), (name, table)
