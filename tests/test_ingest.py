"""Ingest: columns that arrive during a run, unreadable lines, crashes, reads without footers."""

import json
import os

import pytest
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from listingflow.streaming import ingest
from listingflow.streaming.ingest import ingest_stream, load_schema, read_ingested

SCHEMA = StructType([StructField("id", IntegerType()), StructField("x", StringType())])


def run(spark, root, **options):
    return ingest_stream(spark, f"{root}/in/*", f"{root}/table", f"{root}/ck", schema_path=f"{root}/schema", **options)


def table(spark, root):
    out = read_ingested(spark, f"{root}/table", f"{root}/schema")
    return sorted(tuple(r) for r in out.drop("bronze_ingested_at", "source_file_path", "ingest_date").collect())


def lines(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("".join(f"{r}\n" for r in rows))


def test_file_between_probe_and_listing_keeps_its_column(spark, tmp_root, monkeypatch):
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(f"{tmp_root}/in/f1")
    late = spark.createDataFrame([(2, "b", 9.5)], "id int, x string, y double")
    real, calls = ingest.stream_path, []

    def lands_now(session, src):
        calls.append(src)
        if len(calls) == 1:         # the schema is settled, the stream has not listed its files yet
            late.write.parquet(f"{tmp_root}/in/f2")
        return real(session, src)

    monkeypatch.setattr(ingest, "stream_path", lands_now)
    run(spark, tmp_root)
    assert len(calls) == 2          # stopped, widened, started again
    assert table(spark, tmp_root) == [(1, "a", None), (2, "b", 9.5)]
    assert load_schema(spark, f"{tmp_root}/schema").names == ["id", "x", "y"]
    run(spark, tmp_root)
    assert table(spark, tmp_root) == [(1, "a", None), (2, "b", 9.5)]


def test_widens_in_the_middle_of_many_batches(spark, tmp_root):
    for i in range(4):
        frame = spark.createDataFrame([(i, "a")], "id int, x string").coalesce(1)
        (frame if i != 2 else frame.selectExpr("*", "7 AS z")).write.parquet(f"{tmp_root}/in/f{i}")
    run(spark, tmp_root, schema=SCHEMA, max_files_per_trigger=1)
    assert [(r[0], r[2]) for r in table(spark, tmp_root)] == [(0, None), (1, None), (2, 7), (3, None)]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_unreadable_lines(spark, tmp_root, fmt):
    good = {"json": [json.dumps({"id": i, "x": "a"}) for i in range(5)], "csv": [f"{i},a" for i in range(5)]}[fmt]
    bad = {"json": ['{"id": 7, "x"', "no json at all"], "csv": ["seven,a", "1,a,too,many"]}[fmt]
    lines(f"{tmp_root}/in/d/a.{fmt}", *good[:3], bad[0])
    run(spark, tmp_root, fmt=fmt, schema=SCHEMA, quarantine=f"{tmp_root}/bad")
    lines(f"{tmp_root}/in/d/b.{fmt}", bad[1], *good[3:])
    for _ in range(2):
        run(spark, tmp_root, fmt=fmt, schema=SCHEMA, quarantine=f"{tmp_root}/bad")
    assert table(spark, tmp_root) == [(i, "a") for i in range(5)]
    aside = spark.read.parquet(f"{tmp_root}/bad").collect()
    assert sorted(r["_corrupt_record"] for r in aside) == sorted(bad)
    assert all(r["source_file_path"].endswith(fmt) and r["bronze_ingested_at"] for r in aside)


@pytest.mark.parametrize("at", [1, 2])
def test_batch_runs_again_after_a_crash(spark, tmp_root, monkeypatch, at):
    """The write of good or of bad rows is committed, then the run dies before the batch is: the rerun
    replaces what the batch wrote."""
    lines(f"{tmp_root}/in/d/a.json", *[json.dumps({"id": i, "x": "a"}) for i in range(5)], "broken")
    real, seen = DataFrameWriter.parquet, []

    def parquet(writer, path, *args, **kwargs):
        real(writer, path, *args, **kwargs)
        seen.append(path)
        if len(seen) == at:
            raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", parquet)
        with pytest.raises(Exception):
            run(spark, tmp_root, fmt="json", schema=SCHEMA, quarantine=f"{tmp_root}/bad")
    run(spark, tmp_root, fmt="json", schema=SCHEMA, quarantine=f"{tmp_root}/bad")
    assert table(spark, tmp_root) == [(i, "a") for i in range(5)]
    assert [r["_corrupt_record"] for r in spark.read.parquet(f"{tmp_root}/bad").collect()] == ["broken"]


def test_table_is_read_with_the_stored_schema(spark, tmp_root):
    assert read_ingested(spark, f"{tmp_root}/table", f"{tmp_root}/schema") is None
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(f"{tmp_root}/in/f1")
    run(spark, tmp_root)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("read-ingested", "read")
    try:
        out = read_ingested(spark, f"{tmp_root}/table", f"{tmp_root}/schema")
        jobs = tracker.getJobIdsForGroup("read-ingested")
        # the only job reads the one-line schema file; none opens the table's footers
        assert len(jobs) <= 1 and out.count() == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ValueError):
        run(spark, tmp_root, quarantine=f"{tmp_root}/bad")


def test_log_of_rows_and_bad_lines_per_file(spark, tmp_root, monkeypatch):
    """Also after a crash between a batch's rows and its log: the batch runs again and is counted once."""
    lines(f"{tmp_root}/in/a/1.json", '{"id": 1, "x": "a"}', '{"id": ', '{"id": 2, "x": "b"}')
    lines(f"{tmp_root}/in/b/2.json", '{"id": 3, "x": "c"}')
    options = dict(fmt="json", schema=SCHEMA, quarantine=f"{tmp_root}/bad", log=f"{tmp_root}/log")
    original = DataFrameWriter.parquet

    def parquet(writer, path, *args, **kwargs):
        if path.endswith("/log"):
            raise RuntimeError("crash")
        original(writer, path, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", parquet)
        with pytest.raises(Exception, match="crash"):
            run(spark, tmp_root, **options)
    run(spark, tmp_root, **options)
    lines(f"{tmp_root}/in/c/3.json", '{"id": 4, "x": "d", "y": 1}', '{"id": ')
    run(spark, tmp_root, **options)
    log = [(r.source_file_path.rsplit("/", 1)[1], r.rows, r.bad_lines) for r in ingest.read_log(spark, f"{tmp_root}/log").collect()]
    assert sorted(log) == [("1.json", 2, 1), ("2.json", 1, 0), ("3.json", 1, 1)]
    assert [r.rows for r in ingest.read_log(spark, f"{tmp_root}/log", after=0).collect()] == [1]
    assert [r[0] for r in table(spark, tmp_root)] == [1, 2, 3, 4]


def test_bronze_control_row_counts_the_run(spark, tmp_root):
    import datetime as dt

    from listingflow.plans.lakehouse import RunConfig, ingest_step
    from listingflow.sources.tables import TableStore
    cfg = RunConfig(root=f"{tmp_root}/lake", as_of="2021-06-30", raw_dir=f"{tmp_root}/in/*", run_ts=dt.datetime(2030, 1, 1))
    store, seen = TableStore(spark, cfg.root), []
    for i, n in enumerate((3, 5, 0)):
        if n:
            spark.range(n).selectExpr("id", "'v' AS x").write.parquet(f"{tmp_root}/in/f{i}")
        ingest_step(spark, cfg)
        seen += [(r.last_mark, r.rows_merged) for r in store.read("control").filter("layer = 'bronze'").collect()]
    assert seen == [("0", 3), ("1", 5), ("1", 5)]
