"""How often the batch runner's steps write the rows of a batch, and the pick in one pass."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from conftest import SF_SMALL
from listingflow.plans import lakehouse
from listingflow.plans.lakehouse import RunConfig, gold_step, silver_step
from listingflow.plans.silver import newest_versions
from listingflow.sources import tables
from listingflow.sources.fixtures import listing_versions
from listingflow.sources.tables import TableStore


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_first_write_of_a_table_is_not_copied(spark, tmp_root, monkeypatch):
    store, paths, original = TableStore(spark, tmp_root), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **k: paths.append(path) or original(w, path, *a, **k))
    data = spark.range(100).selectExpr("id AS k", "'v' AS v")
    store.upsert("t", data, ["k"], 4, move=True)
    assert paths == [f"{tmp_root}/_staged/t"]
    assert rows(store.read("t")) == rows(data)
    assert store.partition_column("t") == "__bucket_of_4" and os.listdir(f"{tmp_root}/_staged") == []
    # a folder that the catalog does not know is no new table
    spark.sql(f"DROP TABLE {store.name('t')}")
    store.upsert("t", spark.createDataFrame([(5, "w")], "k long, v string"), ["k"], 4, move=True)
    assert store.read("t").count() == 100 and store.read("t").filter("v = 'w'").count() == 1


class Crash(Exception):
    pass


@pytest.mark.parametrize("at", ["_move", "_create"])
def test_crash_in_the_first_write(spark, tmp_root, monkeypatch, at):
    """Before the staged folder is renamed, and after that, before the catalog knows the table."""
    def crash(*args):
        raise Crash
    data = spark.range(100).selectExpr("id AS k", "'v' AS v")
    with monkeypatch.context() as m:
        m.setattr(TableStore, at, crash)
        with pytest.raises(Crash):
            TableStore(spark, tmp_root).upsert("t", data, ["k"], 4, move=True)
    again = TableStore(spark, tmp_root)
    assert rows(again.read("t")) == rows(data)
    again.upsert("t", spark.createDataFrame([(5, "w"), (100, "w")], "k long, v string"), ["k"], 4)
    assert again.read("t").count() == 101 and again.read("t").filter("v = 'w'").count() == 2


def test_pick_is_one_pass_and_keeps_rows_without_key(spark, tmp_root):
    day = [dt.datetime(2020, 1, d) for d in range(1, 4)]
    values = [("A", day[0], 1), ("A", day[2], 2), ("A", day[1], 3), ("B", day[0], 1), ("B", day[0], 1), ("B", None, 9),
              (" nan ", day[0], 1), (" nan ", day[2], 1), (None, day[0], 1), (None, day[0], 1), (None, None, None), ("  ", day[0], 5),
              ("C", None, None)]
    spark.createDataFrame(values, "Property_ID string, bronze_ingested_at timestamp_ntz, row_seq long").write.parquet(f"{tmp_root}/t")
    got = newest_versions(spark.read.parquet(f"{tmp_root}/t"), narrow=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Partial" in plan and "WindowGroupLimit" in plan
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2        # the second is the partial limit's
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("A", day[2], 2, False), ("B", day[0], 1, False), ("C", None, None, False), (" nan ", day[0], 1, True), (" nan ", day[2], 1, True),
         (None, day[0], 1, True), (None, day[0], 1, True), (None, None, None, True), ("  ", day[0], 5, True)], key=repr)


def test_steps_write_a_batch_once_each(spark, tmp_root, monkeypatch):
    """Cleaned rows, changes and silver, with no copies between; gold reads the changes as they lie."""
    names, stage = [], lakehouse.stage
    for module in (lakehouse, tables):
        monkeypatch.setattr(module, "stage", lambda df, name: names.append(name) or stage(df, name))
    versions, shape = listing_versions(spark, SF_SMALL)
    store, year = TableStore(spark, tmp_root), F.year("bronze_ingested_at")
    want = []
    for i, bronze in enumerate([versions.filter(year <= 1995), versions.filter(year <= 1997), versions, versions]):
        cfg = RunConfig(root=tmp_root, as_of="2021-06-30", buckets=4, run_ts=dt.datetime(2030, 1, 1 + i))
        new = silver_step(store, bronze, cfg, shape=shape, narrow=True)["new_rows"]
        want.append(new)
        if i != 1:      # the second batch and the third go to gold together
            gold = gold_step(store, cfg)["new_rows"]
            assert (gold > 0) == (i < 3)
        if i == 0:
            # "merge-source": none of silver or fact, which are new
            assert names == ["silver-batch", "gold-developers"]
            assert gold == store.read("silver").count()
        if i == 1:
            assert names[2:] == ["silver-batch"]       # and no "merge-source" of silver
    assert want[3] == 0 and sum(want) == versions.count()
    assert names.count("gold-batch") == 1
    silver, fact = store.read("silver"), store.read("fact_listings")
    assert silver.count() == fact.count() == silver.join(fact, "Property_ID").count()
    assert rows(silver.select("Property_ID", "Total_Price", "Size_SqM")) == rows(fact.select("Property_ID", "Total_Price", "Size_SqM"))
