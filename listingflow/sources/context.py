"""Schema and sample rows of allowed tables, as a DataFrame (the context a question-to-SQL
assistant is given)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_context(tables: dict[str, DataFrame], sample_rows: int = 2) -> DataFrame:
    """One row per (table, column): its type and up to ``sample_rows`` sample values as text
    (sorted, ``' | '``-joined; NULLs left out; empty for a table without rows).

    Only ``sample_rows`` rows of each table are read (``limit``); columns and types come from the
    plan, so an empty table has its rows here too.
    """
    spark = next(iter(tables.values())).sparkSession
    columns = spark.createDataFrame(
        [(name, i, f.name, f.dataType.simpleString())
         for name, df in tables.items() for i, f in enumerate(df.schema.fields)],
        "table_name string, ordinal int, column_name string, data_type string")
    parts = []
    for name, df in tables.items():
        cells = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(f"`{f.name}`").cast("string").alias("value"))
            for i, f in enumerate(df.schema.fields)]))
        parts.append(df.limit(sample_rows).select(F.lit(name).alias("t"), cells.alias("c"))
                     .groupBy("t", "c.i").agg(F.array_sort(F.collect_list("c.value")).alias("values")))
    samples = reduce(DataFrame.unionByName, parts)
    joined = columns.join(samples, (F.col("table_name") == F.col("t")) & (F.col("ordinal") == F.col("i")), "left")
    return joined.select("table_name", "ordinal", "column_name", "data_type",
                         F.coalesce(F.concat_ws(" | ", "values"), F.lit("")).alias("sample_values"))
