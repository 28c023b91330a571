"""Files -> append-only raw table, as a Structured Streaming query run to completion.

``trigger(availableNow=True)`` drains every file not yet recorded in the checkpoint and stops. With
a remembered schema or a quarantine, each micro-batch is written by its number, which is a partition
of the table: a batch that is run again after a crash replaces itself, so a file's rows are there
exactly once.

A batch whose files have columns that the schema lacks is not written: the schema is widened and
stored, and the query starts again from the same checkpoint, which gives it the same files. So a
column is never lost, whenever its file arrives; old files read the new columns as NULL. Lines that
CSV or JSON cannot read go to the quarantine as they are, with the same stamps.

Rows and unreadable lines per file come from the job that finds a batch's files for the look at their
columns, and are logged under the batch's number.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType, TimestampType

from listingflow.functions.keys import ts_literal

BAD_LINE = "_corrupt_record"        # Spark's name for the text of a line that could not be read
STAMPS = StructType([StructField("bronze_ingested_at", TimestampType()), StructField("source_file_path", StringType()),
                     StructField("ingest_date", DateType()), StructField("ingest_batch", IntegerType())])
LOG_SCHEMA = "source_file_path string, rows bigint, bad_lines bigint, ingest_batch int"


def evolved_schema(spark: SparkSession, src, fmt: str = "parquet",
                   known: StructType | None = None, options: dict | None = None) -> StructType:
    """``known`` plus every column the files add (in file order); types of known columns kept.
    ``src`` is a path or a list of files."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    found = reader.load(src).schema
    if known is None:
        return found
    names = {*known.names, BAD_LINE}
    return StructType(list(known.fields) + [f for f in found.fields if f.name not in names])


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """Persist a schema as one JSON line next to the checkpoint (readable with load_schema)."""
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType | None:
    try:
        row = spark.read.text(path).first()
    except Exception:  # no schema stored yet
        return None
    return StructType.fromJson(json.loads(row[0])) if row else None


def stamp_ingest(df: DataFrame, ts=None) -> DataFrame:
    """Add ``bronze_ingested_at`` (micro-batch time, or ``ts``), ``source_file_path`` and the
    ``ingest_date`` partition value."""
    stamp = F.current_timestamp() if ts is None else ts_literal(ts, "timestamp")
    return df.withColumns({"bronze_ingested_at": stamp,
                           "source_file_path": F.col("_metadata.file_path"),
                           "ingest_date": F.to_date(stamp)})


def stream_path(spark: SparkSession, src: str) -> str:
    """A file stream source watches a folder or a glob; a single file becomes a one-file glob."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(src)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        is_file = fs.exists(path) and fs.getFileStatus(path).isFile()
    except Exception:        # no JVM handle (Spark Connect): judge by the name
        is_file = not any(ch in src for ch in "*?[{") and \
            src.rsplit("/", 1)[-1].rsplit(".", 1)[-1] in ("parquet", "csv", "json", "orc", "txt")
    return src[:-1] + "[" + src[-1] + "]" if is_file else src


class SchemaGrew(RuntimeError):
    """A micro-batch has columns that the schema lacks; ``schema`` has them too."""

    def __init__(self, schema: StructType):
        super().__init__("new columns")
        self.schema = schema


def _write_batches(spark: SparkSession, dst: str, fmt: str, schema: StructType, options: dict, grow: bool,
                   quarantine: str | None, grown: list, log: str | None):
    """Function that writes one micro-batch under its number, good and bad rows apart."""
    bad = F.col(BAD_LINE).isNotNull() if quarantine else F.lit(False)

    def write(batch: DataFrame, number: int) -> None:
        counts = []
        if grow or log:         # one row per file of the batch
            per_file = batch.groupBy("source_file_path").agg(F.count_if(~bad).alias("rows"), F.count_if(bad).alias("bad_lines"))
            counts = per_file.collect()
        if grow:
            files = [r["source_file_path"] for r in counts]
            wider = evolved_schema(spark, files, fmt, schema, options) if files else schema
            if len(wider) > len(schema):
                grown.append(wider)         # the error itself comes back as text only
                raise SchemaGrew(wider)
        batch = batch.withColumn("ingest_batch", F.lit(number).cast("int"))
        parts = [(batch, dst)]
        if quarantine:
            stamps = [f.name for f in STAMPS.fields]
            parts = [(batch.filter(~bad).drop(BAD_LINE), dst), (batch.filter(bad).select(BAD_LINE, *stamps), quarantine)]
        for rows, path in parts:
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("ingest_date", "ingest_batch").parquet(path))
        if log:
            (spark.createDataFrame([(*r, number) for r in counts], LOG_SCHEMA).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch").parquet(log))

    return write


def ingest_stream(spark: SparkSession, src: str, dst: str, checkpoint: str, fmt: str = "parquet",
                  schema: StructType | None = None, options: dict | None = None,
                  schema_path: str | None = None, max_files_per_trigger: int | None = None,
                  quarantine: str | None = None, log: str | None = None):
    """Drain all new files of ``src`` into the parquet table ``dst`` and wait for the end.

    With ``schema_path`` the schema is remembered between runs and widened by new columns; a stored
    one is used as it is, so a run opens only the files that it takes in. With ``schema`` alone the
    schema is fixed. ``quarantine`` (CSV and JSON) is the table for lines that cannot be read; without
    it they are rows of NULLs. ``log`` is the table of what each batch took from each file. Returns
    the finished ``StreamingQuery`` (its ``recentProgress`` holds the row counts).
    """
    options = dict(options or {})
    stored = load_schema(spark, schema_path) if schema_path else None
    # Columns of CSV files without a header have no names of their own: nothing to widen by.
    grow = bool(schema_path) and (fmt != "csv" or str(options.get("header", "false")).lower() == "true")
    if stored is not None:
        schema = stored if schema is None else StructType([*stored.fields, *[f for f in schema.fields if f.name not in stored.names]])
    elif schema is None:
        schema = evolved_schema(spark, src, fmt, None, options)
    if quarantine and fmt not in ("csv", "json"):
        raise ValueError(f"{fmt} files have no lines to quarantine")
    schema = StructType([f for f in schema.fields if f.name != BAD_LINE])
    while True:
        if schema_path and schema != stored:
            save_schema(spark, schema, schema_path)
            stored = schema
        read_as = StructType([*schema.fields, StructField(BAD_LINE, StringType())]) if quarantine else schema
        reader = spark.readStream.format(fmt).schema(read_as).options(**options)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        # Partitioned by ingest day: a later "rows newer than the mark" read prunes whole days by
        # directory instead of opening every file footer of the table.
        writer = (stamp_ingest(reader.load(stream_path(spark, src))).writeStream.outputMode("append")
                  .option("checkpointLocation", checkpoint).trigger(availableNow=True))
        if not schema_path and not quarantine and not log:
            query = writer.format("parquet").partitionBy("ingest_date").start(dst)
        else:
            grown: list[StructType] = []
            query = writer.foreachBatch(_write_batches(spark, dst, fmt, schema, options, grow, quarantine, grown, log)).start()
        try:
            query.awaitTermination()
        except Exception:
            if grow and grown:
                schema = grown[-1]
                continue
            raise
        if query.exception() is not None:
            raise RuntimeError(f"ingest failed: {query.exception()}")
        return query


def read_ingested(spark: SparkSession, dst: str, schema_path: str) -> DataFrame | None:
    """The table that ``ingest_stream`` keeps with a remembered schema, read with that schema: no
    footer is opened to find it. ``None`` before the first run."""
    schema = load_schema(spark, schema_path)
    if schema is None:
        return None
    names = {f.name for f in STAMPS.fields}
    whole = StructType([*[f for f in schema.fields if f.name not in names], *STAMPS.fields])
    return spark.read.schema(whole).parquet(dst).drop("ingest_batch")


def read_log(spark: SparkSession, log: str, after: int | None = None) -> DataFrame:
    """Rows and unreadable lines per file and batch; of the batches after ``after`` only, if given."""
    rows = spark.read.schema(LOG_SCHEMA).parquet(log)
    return rows if after is None else rows.filter(F.col("ingest_batch") > after)
