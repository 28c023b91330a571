"""Keyed set operations: latest version per key, upsert and insert-only merge.

Open Spark has no MERGE for plain parquet tables, so a merge is written as relational algebra;
``sources.tables.TableStore`` applies it to the buckets of a table that a batch touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import stage


def _desc(cols):
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def dedup_latest(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep the newest row per key (``order_cols`` descending, which must be a total order).

    ``row_number() == 1`` is planned with a partial ``WindowGroupLimit`` before the shuffle, so
    each map task already drops all but its newest row per key; a hot key costs one row per
    task in the exchange, not all its versions.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_desc(order_cols))
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


latest_per_key = dedup_latest


def dedup_latest_if(df: DataFrame, keys, order_cols, some: Column) -> DataFrame:
    """``dedup_latest`` among the rows where ``some`` holds; every other row stays. ``order_cols`` are names.

    One shuffle and one sort for both: the other rows are grouped by their order columns too, so they
    all have first rank and the partial limit before the shuffle keeps them. The group columns are columns
    of their own, since each window would name (and shuffle by) expressions anew."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    apart = {f"__apart_{c}": F.when(~some, F.col(c)) for c in order_cols}
    w = Window.partitionBy(*keys, *apart).orderBy(*_desc(order_cols))
    top = df.withColumns(apart).withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") == 1)
    return (top.withColumn("__rn", F.row_number().over(w)).filter((F.col("__rn") == 1) | ~some)
            .drop("__rank", "__rn", *apart))


def newest_keys(df: DataFrame, keys, order_cols) -> DataFrame:
    """Per key the ``order_cols`` of its newest row and how many rows share them (``__ties``). Only
    these columns are read, sorted and shuffled."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = list(dict.fromkeys([*keys, *order_cols]))
    w = Window.partitionBy(*keys).orderBy(*_desc(order_cols))
    top = df.select(*cols).withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") == 1)
    return top.groupBy(*cols).agg(F.count(F.lit(1)).alias("__ties"))


def dedup_latest_wide(df: DataFrame, keys, order_cols, newest: DataFrame | None = None) -> DataFrame:
    """``dedup_latest`` for wide rows that are derived by joins: no sort or window runs over them.

    ``newest_keys`` (or ``newest``, if the caller has written them) are written first. The rows are
    then a semi join with them, which the optimizer pushes below the joins that give ``df`` its other
    columns, so those run on one row per key. Only rows that tie for newest need the window.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = list(dict.fromkeys([*keys, *order_cols]))
    newest = stage(newest_keys(df, keys, order_cols), "newest-keys") if newest is None else newest
    of = lambda some: df.join(_key_side(some, cols), _null_safe_on(cols), "left_semi")
    ties = newest.filter("__ties > 1")
    single = of(newest.filter("__ties = 1"))
    return single if ties.isEmpty() else single.unionByName(dedup_latest(of(ties), keys, order_cols))


def _key_side(df: DataFrame, keys) -> DataFrame:
    """Keys of ``df`` under fresh names, so a join with a frame of the same lineage
    cannot confuse the two sides."""
    return df.select(*[F.col(k).alias(f"__r_{k}") for k in keys])


def _null_safe_on(keys):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Update-all / insert-all by key: target rows whose key is not in ``source`` plus all of
    ``source``. Columns present on one side only are kept (NULL on the other)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    kept = target.join(_key_side(source, keys), _null_safe_on(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def new_rows(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """The ``source`` rows whose key ``target`` does not have."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return source.join(_key_side(target, keys), _null_safe_on(keys), "left_anti")


def insert_new(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Insert-only merge: target plus the ``source`` rows whose key is not yet present."""
    return target.unionByName(new_rows(target, source, keys), allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once (empty when ``keys`` is unique)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, keys, what: str = "table") -> DataFrame:
    """Fail fast if ``keys`` is not unique in ``df`` (one aggregate job; returns ``df``)."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: key {keys} is not unique, e.g. {dup[0].asDict()}")
    return df
