"""The silver step over listing versions that are narrow until they are picked: the rows of a window over
whole raw rows, from one pass over the line items."""

import datetime as dt

from conftest import SF_SMALL
from listingflow.operators.merge import dedup_latest
from listingflow.plans.queries.base import silver_flagged
from listingflow.plans.silver import newest_versions
from listingflow.sources.fixtures import VERSION_ORDER, listing_versions, raw_listings
from test_scale_plans import no_broadcast


def newest(spark, sf_dir):
    versions, shape = listing_versions(spark, sf_dir)
    return newest_versions(versions, shape=shape, narrow=True).drop("__missing_key")


def rows(df):
    return sorted(map(str, df.collect()))


def test_equals_window_over_whole_rows(spark):
    want = dedup_latest(raw_listings(spark, SF_SMALL), "Property_ID", VERSION_ORDER)
    got = newest(spark, SF_SMALL)
    assert got.schema == want.schema
    assert rows(got) == rows(want)


def write_tables(spark, root, parts, lines):
    day = dt.datetime(1996, 3, 1)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "R")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(7, "N", 0)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "S1", 7), (1, "S1", 7), (2, "lost", 99), (None, "null", 7)]),
        "customer": ("c_custkey long, c_mktsegment string", [(5, "seg"), (5, "seg")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(10, 5, day, "high"), (11, 5, day, "low"), (12, 6, day, "no customer"), (None, 5, day, "null")]),
        "part": ("p_partkey long, p_name string, p_type string, p_size int", parts),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_shipdate timestamp_ntz",
                     [(o, p, s, n, 2.0, 100.0 * n, 0.05, day + dt.timedelta(days=n)) for o, p, s, n in lines])}
    for name, (schema, values) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_repeated_missing_and_null_keys(spark, tmp_root):
    root = write_tables(
        spark, tmp_root, [(3, "P3", "T", 4), (3, "P3", "T", 4), (None, "null", "T", 1), (4, "P4", "T", 9)],
        # The newest lines of order 10 have no part, no supplier's nation or no key: the one before counts.
        [(10, 3, 1, 1), (10, 4, 1, 2), (10, 99, 1, 3), (10, 3, 2, 4), (10, None, 1, 5), (10, 3, None, 6),
         (11, 3, 1, 1), (11, 3, 1, 1), (12, 3, 1, 1), (None, 3, 1, 9)])
    got = newest(spark, root)
    assert rows(got) == rows(dedup_latest(raw_listings(spark, root), "Property_ID", VERSION_ORDER))
    assert sorted((r.Property_ID, r.row_seq) for r in got.collect()) == [("P10", 20000004), ("P11", 10000003)]


def test_raw_versions_are_as_many(spark, tmp_root):
    root = write_tables(spark, tmp_root, [(3, "P3", "T", 4), (3, "P3", "T", 4)], [(10, 3, 1, 1), (11, 3, 1, 2)])
    versions, _ = listing_versions(spark, root)
    assert versions.count() == raw_listings(spark, root).count() == 2 * 2 * 2 * 2


def test_line_items_pass_once_and_narrow(spark):
    with no_broadcast(spark):
        versions, shape = listing_versions(spark, SF_SMALL)
        plan = newest_versions(versions, shape=shape, narrow=True).filter("not __missing_key")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" not in plan
    assert sum("Relation" in line and "l_linenumber" in line for line in plan.splitlines()) == 1
    # names and types of parts come after the pick
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    end = next((i for i, line in enumerate(lines) if i > window and depth(line) <= depth(lines[window])), len(lines))
    below = lines[window:end]
    assert not any("Project" in line and "p_name" in line for line in below)


def test_silver_step_writes_no_pick(spark, monkeypatch):
    """Before, the joins ran once for the keys of the pick and once more for its rows."""
    import listingflow.plans.silver as silver
    names = []
    stage = silver.stage
    monkeypatch.setattr(silver, "stage", lambda df, name: names.append(name) or stage(df, name))
    assert silver_flagged(spark, SF_SMALL).count()
    assert names == ["silver-batch"]
