import datetime as dt
import os

from pyspark.sql import functions as F

from listingflow.sources.calendar import dim_date
from listingflow.sources.tables import control_row, last_mark, newer_than
from listingflow.streaming.ingest import ingest_stream


def test_dim_date(spark):
    cal = dim_date(spark)
    assert cal.count() == 9496
    assert cal.filter("Is_Weekend").count() == 2714
    first = cal.orderBy("Date").first()
    assert first.Date == dt.date(2010, 1, 1) and first.Day_Name == "Friday"
    assert first.Day_Of_Week == 6 and first.Is_Weekend and first.Month_Name == "January"


def test_marks(spark):
    row = control_row(spark, "silver", "listings", dt.datetime(2020, 1, 2), 5, "SUCCESS", "r",
                      dt.datetime(2020, 1, 3))
    mark = last_mark(row, "silver", "listings")
    assert mark == "2020-01-02 00:00:00"
    assert last_mark(row, "gold", "listings") is None
    df = spark.createDataFrame([(dt.datetime(2020, 1, d),) for d in (1, 2, 3)], "t timestamp")
    assert newer_than(df, "t", mark).count() == 1
    assert newer_than(df, "t", None).count() == 3


def test_stream_drains_once_and_grows_schema(spark, tmp_root):
    src = os.path.join(tmp_root, "in")
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(os.path.join(src, "f1"))
    dst, ckpt, sch = (os.path.join(tmp_root, p) for p in ("bronze", "ckpt", "schema"))
    ingest_stream(spark, src + "/*", dst, ckpt, schema_path=sch)
    assert spark.read.parquet(dst).count() == 1
    ingest_stream(spark, src + "/*", dst, ckpt, schema_path=sch)  # rerun: nothing new
    assert spark.read.parquet(dst).count() == 1
    spark.createDataFrame([(2, "b", 9.5)], "id int, x string, y double") \
        .write.parquet(os.path.join(src, "f2"))
    ingest_stream(spark, src + "/*", dst, ckpt, schema_path=sch)
    out = spark.read.option("mergeSchema", "true").parquet(dst)
    assert sorted((r.id, r.y) for r in out.collect()) == [(1, None), (2, 9.5)]
    assert {"bronze_ingested_at", "source_file_path"} <= set(out.columns)
    assert all(r.source_file_path.startswith("file:") for r in out.collect())


def test_stream_csv_and_json(spark, tmp_root):
    csv_dir = os.path.join(tmp_root, "csv")
    os.makedirs(csv_dir)
    with open(os.path.join(csv_dir, "a.csv"), "w") as fh:
        fh.write("id,name\n1,x\n2,y\n")
    dst = os.path.join(tmp_root, "bronze_csv")
    ingest_stream(spark, csv_dir, dst, os.path.join(tmp_root, "c1"), fmt="csv",
                  options={"header": "true"})
    assert spark.read.parquet(dst).count() == 2
    json_dir = os.path.join(tmp_root, "json")
    os.makedirs(json_dir)
    with open(os.path.join(json_dir, "a.json"), "w") as fh:
        fh.write('{"id": 1, "p": {"k": 2}}\n{"id": 2}\n')
    dst2 = os.path.join(tmp_root, "bronze_json")
    ingest_stream(spark, json_dir, dst2, os.path.join(tmp_root, "c2"), fmt="json")
    assert spark.read.parquet(dst2).filter(F.col("p.k") == 2).count() == 1


def test_marks_do_not_depend_on_the_driver_zone(spark, tmp_root, monkeypatch):
    import time
    from listingflow.sources.tables import max_mark
    df = spark.sql("SELECT timestamp_micros(1577872800000001L + id * 3600000000L) AS t, id FROM range(3)")
    for zone in ("Africa/Cairo", "America/Lima", "UTC"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        mark = max_mark(df.filter("id < 1"), "t")
        row = control_row(spark, "silver", "x", mark, 1, "SUCCESS", "r", dt.datetime(2020, 1, 1))
        assert newer_than(df, "t", last_mark(row, "silver", "x")).count() == 2
    monkeypatch.undo()
    time.tzset()


def test_mark_filter_prunes_ingest_days(spark, tmp_root):
    src = os.path.join(tmp_root, "in")
    spark.range(5).write.parquet(os.path.join(src, "f1"))
    dst = os.path.join(tmp_root, "bronze")
    ingest_stream(spark, src + "/*", dst, os.path.join(tmp_root, "ck"))
    bronze = spark.read.parquet(dst)
    assert "ingest_date" in bronze.columns
    newer = newer_than(bronze, "bronze_ingested_at", dt.datetime(2000, 1, 1), "ingest_date")
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and newer.count() == 5
