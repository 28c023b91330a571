"""Shared helpers of the training-data operators.

Every operator takes DataFrames and returns DataFrames. Callers' column names can clash with the
names an operator adds, so operators first narrow their input to what they need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.session import _context, scratch_path, stage

# Words are maximal runs of anything but the six ASCII white-space bytes (fixed values).
WORD_RE = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def word_count(col) -> F.Column:
    """Words of a text column as a long (null: 0), without building the words."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD_RE)), F.lit(0)).cast("long")


def settle(df: DataFrame, name: str) -> DataFrame:
    """``stage`` a step's result, then let the driver's JVM forget the steps before it, so that
    Spark's cleaner drops their shuffle files while later steps run."""
    out = stage(df, name)
    context = _context(df.sparkSession)
    if context is not None:
        context._jvm.System.gc()
    return out


class Stages:
    """Written tables of one operator by name; a table goes as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables, if any, and let Spark's cleaner drop the shuffle files behind them."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.spark.sparkContext._jvm.System.gc()


#: Rows of a batch that Python works on together.
ROWS = 500


def small(batches, rows: int = ROWS):
    """The batches in slices, so that a worker holds the texts (and what is made of them) of few rows at a
    time; workers are used again, and keep the memory of their largest step."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_rows(df: DataFrame, fn: Callable[[dict], Iterator[dict] | dict], schema: str) -> DataFrame:
    """Run ``fn`` over each Arrow batch given as ``{column: list}``; it returns ``{column: list}``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            out = fn({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_pydict({f.name: out[f.name] for f in target}, schema=target)

    return df.mapInArrow(run, schema)
