"""Newest versions picked on narrow columns: the same rows as the window over whole rows, and the pick
below the joins that give the rows their other columns."""

import re

from conftest import SF_SMALL
from listingflow.operators.merge import dedup_latest, dedup_latest_wide
from listingflow.plans.silver import newest_versions
from listingflow.sources.fixtures import VERSION_ORDER, joined_listings, raw_listings, shape_listings

COLUMNS = "k string, t int, s int, v string"


def test_equals_window_with_nulls_and_ties(spark):
    rows = [("a", 1, 1, "old"), ("a", 2, 1, "new"), ("b", None, 9, "null"), ("b", 0, None, "zero"),
            (None, 1, 1, "n1"), (None, None, None, "n2"), ("c", None, None, "only"),
            ("d", 3, 3, "same"), ("d", 3, 3, "same"), ("d", 1, 3, "less")]
    df = spark.createDataFrame(rows, COLUMNS)
    got = sorted(map(str, dedup_latest_wide(df, "k", ["t", "s"]).collect()))
    assert got == sorted(map(str, dedup_latest(df, "k", ["t", "s"]).collect()))
    assert len(got) == 5            # one row per key, also of those that tie


def test_empty(spark):
    assert dedup_latest_wide(spark.createDataFrame([], COLUMNS), "k", ["t", "s"]).isEmpty()


def test_pick_is_pushed_below_the_joins(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = newest_versions(joined_listings(spark, SF_SMALL), shape=shape_listings)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Window" not in plan     # no whole row is sorted or shuffled by its key
    depth = {kind: min(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if re.search(f"Join {kind}", line))
             for kind in ("LeftSemi", "Inner")}
    assert depth["LeftSemi"] > depth["Inner"]


def test_whole_raw_rows(spark):
    raw = raw_listings(spark, SF_SMALL)
    got = newest_versions(joined_listings(spark, SF_SMALL), shape=shape_listings).drop("__missing_key")
    want = dedup_latest(raw, "Property_ID", VERSION_ORDER)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
