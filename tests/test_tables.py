"""Catalog tables: merges equal their algebra, only touched buckets are rewritten, crashes."""

import os
import random
import shutil

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from listingflow.operators.merge import insert_new, upsert
from listingflow.sources.tables import TableStore

DDL = "k long, v string, n int"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def batches(seed, count=4):
    rng = random.Random(seed)
    out = []
    for b in range(count):
        keys = rng.sample([None, *range(60)], rng.randrange(0, 25))
        out.append([(k, f"b{b}", rng.randrange(100)) for k in keys])
    return out


@pytest.mark.parametrize("merge", ["upsert", "insert_new"])
def test_merges_equal_their_algebra(spark, tmp_root, merge):
    algebra = {"upsert": upsert, "insert_new": insert_new}[merge]
    for seed in (1, 2):
        store, want = TableStore(spark, f"{tmp_root}/{seed}"), None
        for i, batch in enumerate(batches(seed)):
            source = frame(spark, batch)
            want = source if want is None else algebra(want, source, ["k"])
            getattr(store, merge)("t", source, ["k"], buckets=4 + i)      # the first number counts
            assert rows(store.read("t")) == rows(want)
        assert store.partition_column("t") == "__bucket_of_4"


def test_other_jobs_read_by_name_and_by_folder(spark, tmp_root):
    store = TableStore(spark, tmp_root, database="listing_tables_test")
    store.upsert("t", frame(spark, [(1, "a", 1), (2, "b", 2)]), ["k"], 4)
    assert spark.sql("SELECT sum(n) FROM listing_tables_test.t").first()[0] == 3
    assert spark.read.parquet(f"{tmp_root}/t").count() == 2
    # a session whose catalog does not know the table finds it by its files
    spark.sql("DROP TABLE listing_tables_test.t")
    again = TableStore(spark, tmp_root, database="listing_tables_test")
    again.upsert("t", frame(spark, [(2, "c", 5)]), ["k"], 64)
    assert rows(again.read("t")) == [(1, 1, "a"), (2, 5, "c")]
    assert again.partition_column("t") == "__bucket_of_4"


def test_only_touched_buckets_are_rewritten(spark, tmp_root):
    store = TableStore(spark, tmp_root)
    store.upsert("t", spark.range(0, 1000).selectExpr("id AS k", "'v' AS v", "0 AS n"), ["k"], 16)
    before = {f"{d}/{f}" for d, _, names in os.walk(f"{tmp_root}/t") for f in names if f.endswith(".parquet")}
    store.upsert("t", frame(spark, [(5, "w", 1)]), ["k"], 16)
    after = {f"{d}/{f}" for d, _, names in os.walk(f"{tmp_root}/t") for f in names if f.endswith(".parquet")}
    assert store.read("t").count() == 1000 and store.read("t").filter("v = 'w'").count() == 1
    assert len(after - before) == 1 and len(before & after) == 15


def test_empty_widened_and_wrong_batches(spark, tmp_root):
    store = TableStore(spark, tmp_root)
    assert store.read("t") is None
    empty = spark.createDataFrame([], "k long, v string")
    store.insert_new("t", empty, ["k"], 4)
    assert store.read("t").count() == 0 and store.read("t").columns == ["k", "v"]
    store.upsert("t", empty, ["k"], 4)
    store.upsert("t", spark.createDataFrame([(1, "a", 2.5)], "k long, v string, w double"), ["k"], 4)
    store.upsert("t", spark.createDataFrame([(2, "b")], "k long, v string"), ["k"], 4)
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a", 2.5), (2, "b", None)]
    with pytest.raises(ValueError):
        store.upsert("t", spark.createDataFrame([("x", "b")], "k string, v string"), ["k"], 4)
    with pytest.raises(ValueError):
        store.upsert("t", spark.createDataFrame([(1, "b")], "k long, v string"), ["v"], 4)
    store.publish("p", spark.range(3))
    store.publish("p", store.read("p").union(spark.range(3, 5)))
    assert store.read("p").count() == 5
    store.publish("p", spark.range(2).selectExpr("id", "'x' AS more"))
    assert store.read("p").columns == ["id", "more"] and store.read("p").count() == 2
    with pytest.raises(ValueError):
        store.upsert("p", spark.range(3), ["id"], 4)
    assert store.ensure("e", "a int").count() == 0 and store.ensure("e", "a int").columns == ["a"]


def test_batches_of_changes(spark, tmp_root):
    store = TableStore(spark, tmp_root)
    assert store.read_batches("c", 0, 9, ["k"]) is None
    store.write_batch("c", frame(spark, [(1, "a", 1), (2, "a", 2)]), 1)
    store.write_batch("c", frame(spark, [(9, "gone", 9)]), 2)
    store.write_batch("c", frame(spark, [(2, "b", 3)]), 2)              # the batch again, after a crash
    store.write_batch("c", spark.createDataFrame([(3, "c", 4, 1.5)], DDL + ", w double"), 3)
    assert rows(store.read_batches("c", 0, 2, ["k"]).select("k", "v", "n")) == [(1, 1, "a"), (2, 3, "b")]
    late = store.read_batches("c", 2, 3, ["k"])
    assert rows(late) == [(3, 4, "c", 1.5)]
    assert "PartitionFilters: [isnotnull(__batch" in late._jdf.queryExecution().executedPlan().toString()
    assert store.drop_batches("c", 2) == [1, 2] and rows(store.read_batches("c", 0, 9, ["k"])) == [(3, 4, "c", 1.5)]


class Crash(Exception):
    pass


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("action", ["upsert", "insert_new", "publish", "write_batch"])
def test_crash_at_every_write(spark, tmp_root, monkeypatch, action, after):
    """Each write to the table fails in turn, before it starts or right after its commit; the rerun
    gives the same rows as a run without a crash, and nothing that was there is lost."""
    base = [(k, "old", k) for k in range(100)]
    batch = [(k, "new", k) for k in range(0, 200, 10)]

    def run(store, data):
        source = frame(spark, data)
        if action == "publish":
            old = store.read("t")
            store.publish("t", source if old is None else upsert(old, source, ["k"]))
        elif action == "write_batch":
            store.write_batch("t", source, 1 if data is base else 2)
        else:
            getattr(store, action)("t", source, ["k"], 8)

    whole = TableStore(spark, f"{tmp_root}/whole")
    for data in (base, batch):
        run(whole, data)
    original, at = DataFrameWriter.parquet, 0
    while True:
        at += 1
        store, writes = TableStore(spark, f"{tmp_root}/{action}-{at}"), []
        run(store, base)

        def parquet(writer, path, *args, store=store, writes=writes, at=at, **kwargs):
            own = path.startswith(store.root)
            writes += [path] * own
            if own and len(writes) == at and not after:
                raise Crash
            original(writer, path, *args, **kwargs)
            if own and len(writes) == at:
                raise Crash

        with monkeypatch.context() as m:
            m.setattr(DataFrameWriter, "parquet", parquet)
            try:
                run(store, batch)
                break                   # fewer writes than that
            except Crash:
                pass
        assert store.read("t").filter("v = 'old'").count() >= 90        # untouched rows are there
        run(store, batch)
        assert rows(store.read("t")) == rows(whole.read("t"))
    assert at >= 2


def test_crash_between_delete_and_rename(spark, tmp_root, monkeypatch):
    """The worst place: the replacement is staged, a partition of the table is already deleted."""
    store = TableStore(spark, tmp_root)
    store.upsert("t", frame(spark, [(k, "old", k) for k in range(1000)]), ["k"], 8)
    original = DataFrameWriter.parquet

    def parquet(writer, path, *args, **kwargs):
        if path == store.location("t"):
            gone = sorted(p for p in os.listdir(path) if p.startswith("__bucket"))[0]
            shutil.rmtree(f"{path}/{gone}")
            raise Crash
        original(writer, path, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", parquet)
        with pytest.raises(Crash):
            store.upsert("t", frame(spark, [(k, "new", k) for k in range(3)] + [(k, "new", k) for k in range(1000, 1100)]), ["k"], 8)
    read = TableStore(spark, tmp_root).read("t")
    assert read.count() == 1100 and read.filter("v = 'new'").count() == 103
    # a staged write that was not committed is dropped
    os.makedirs(f"{tmp_root}/_staged/t")
    assert TableStore(spark, tmp_root).read("t").count() == 1100 and not os.path.exists(f"{tmp_root}/_staged/t")
