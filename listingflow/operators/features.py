"""Derived listing features and group-mean imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from listingflow.session import stage

# The two payment classes (instalments, cash).
PAYMENT_INSTALMENTS = "تقسيط"
PAYMENT_CASH = "كاش"
CASH_DOWN_PAYMENT = 100.0


def impute_mean(df: DataFrame, cols, by, stats_from: DataFrame | None = None,
                stage_stats: bool = True) -> DataFrame:
    """Fill NULLs of ``cols`` with the mean of the same ``by`` group.

    The means come from ``stats_from`` (default: ``df`` itself, the batch) through a grouped
    aggregate, which combines map-side before its small shuffle, and are joined back NULL-safely
    on the group. Unlike a window over ``partitionBy(by)``, no task has to hold a whole group, so a
    group holding a third of the rows costs nothing extra.

    With ``stage_stats`` the (small) means are written first, so the planner sees their real
    size: below ``spark.sql.autoBroadcastJoinThreshold`` the join is a broadcast and the rows are
    never shuffled; above it, a sort-merge join whose skewed partitions AQE splits.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    by = [by] if isinstance(by, str) else list(by)
    src = df if stats_from is None else stats_from
    stats = src.groupBy(*by).agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    stats = stats.select(*[F.col(b).alias(f"__key_{b}") for b in by],
                         *[f"__mean_{c}" for c in cols])
    if stage_stats:
        stats = stage(stats, "group-means")
    cond = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__key_{b}")) for b in by])
    out = df.join(stats, cond, "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__mean_{c}")) for c in cols})
    return out.drop(*[f"__key_{b}" for b in by], *[f"__mean_{c}" for c in cols])


def group_means(src: DataFrame, spec: dict, stage_stats: bool = True) -> dict:
    """Means of several column sets over several groupings, from ONE aggregate of ``src``.

    ``spec`` maps a grouping column to the columns to average, e.g.
    ``{"City": [...], "Developer_Name": ["Down_Payment_Pct"]}``. The grouping sets are computed
    together (one scan, one small shuffle, partial aggregation) and, with ``stage_stats``, written
    once; the result maps each grouping column to a frame ``(__key_<by>, __mean_<col>...)``
    ready for ``fill_from_means``.
    """
    bys = list(spec)
    cols = sorted({c for cs in spec.values() for c in cs})
    stats = src.groupingSets([[b] for b in bys], *bys).agg(
        *[F.avg(c).alias(f"__mean_{c}") for c in cols],
        F.grouping_id().alias("__gid"))
    if stage_stats:
        stats = stage(stats, "group-means")
    out = {}
    for i, by in enumerate(bys):
        # grouping_id has a bit set for every grouping column NOT in the set
        gid = sum(1 << (len(bys) - 1 - j) for j in range(len(bys)) if j != i)
        out[by] = stats.filter(F.col("__gid") == gid).select(
            F.col(by).alias(f"__key_{by}"), *[f"__mean_{c}" for c in spec[by]])
    return out


def group_sums(src: DataFrame, spec: dict, sign: int = 1) -> DataFrame:
    """Sums and counts behind the means of ``spec``: rows ``(by, group, sum_<col>..., n_<col>...)``
    with ``by`` the grouping column's name, from one aggregate of ``src``.

    Sums are exact decimals (other numbers at 12 places), so what is added with ``sign`` 1 can be
    taken away again with ``sign`` -1 and leaves no trace.
    """
    bys, cols = list(spec), sorted({c for cs in spec.values() for c in cs})
    number = {c: F.col(c).try_cast(DecimalType(38, _scale(src, c))) for c in cols}
    signed = F.negative if sign < 0 else lambda c: c
    found = src.groupingSets([[b] for b in bys], *bys).agg(
        *[signed(F.sum(number[c])).cast(DecimalType(38, _scale(src, c))).alias(f"sum_{c}") for c in cols],
        *[signed(F.count(number[c])).alias(f"n_{c}") for c in cols],
        F.grouping_id().alias("__gid"))
    by, group = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, b in enumerate(bys):
        own = F.col("__gid") == sum(1 << (len(bys) - 1 - j) for j in range(len(bys)) if j != i)
        by, group = F.when(own, F.lit(b)).otherwise(by), F.when(own, F.col(b).cast("string")).otherwise(group)
    return found.select(by.alias("by"), group.alias("group"), *[f"sum_{c}" for c in cols], *[f"n_{c}" for c in cols])


def _scale(src: DataFrame, col: str) -> int:
    kind = src.schema[col].dataType
    return kind.scale if isinstance(kind, DecimalType) else 12


def add_sums(*sums: DataFrame) -> DataFrame:
    """One frame of ``group_sums`` from several; groups that nothing is left of are gone."""
    rows = reduce(DataFrame.unionByName, sums)
    cols = [c.removeprefix("sum_") for c in rows.columns if c.startswith("sum_")]
    total = rows.groupBy("by", "group").agg(
        *[F.coalesce(F.sum(f"sum_{c}"), F.lit(0)).cast(rows.schema[f"sum_{c}"].dataType).alias(f"sum_{c}") for c in cols],
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in cols])
    return total.filter(reduce(lambda a, b: a | b, [F.col(f"n_{c}") != 0 for c in cols]))


def means_of_sums(sums: DataFrame, spec: dict, like: DataFrame, stage_stats: bool = True) -> dict:
    """The frames of ``group_means`` from ``group_sums``, with the types that a mean over the
    columns of ``like`` has."""
    sums = stage(sums, "group-means") if stage_stats else sums
    out = {}
    for by, cols in spec.items():
        means = []
        for c in cols:
            kind, n = like.schema[c].dataType, F.nullif(F.col(f"n_{c}"), F.lit(0))
            if isinstance(kind, DecimalType):
                total = F.col(f"sum_{c}").cast(DecimalType(min(38, kind.precision + 10), kind.scale))
                mean = (total / n).cast(DecimalType(min(38, kind.precision + 4), min(38, kind.scale + 4)))
            else:
                mean = F.col(f"sum_{c}").cast("double") / n
            means.append(mean.alias(f"__mean_{c}"))
        out[by] = sums.filter(F.col("by") == by).select(F.col("group").cast(like.schema[by].dataType).alias(f"__key_{by}"), *means)
    return out


def fill_from_means(df: DataFrame, means: DataFrame, by: str, cols) -> DataFrame:
    """Fill NULLs of ``cols`` from a ``group_means`` frame, joined NULL-safely on ``by``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = df.join(means, F.col(by).eqNullSafe(F.col(f"__key_{by}")), "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__mean_{c}")) for c in cols})
    return out.drop(f"__key_{by}", *[f"__mean_{c}" for c in cols])


def payment_type(df: DataFrame, years_col: str = "Installment_Years",
                 out: str = "Payment_Type") -> DataFrame:
    """Instalments when there is at least one instalment year, otherwise cash (NULL -> cash)."""
    return df.withColumn(out, F.when(F.col(years_col) > 0, F.lit(PAYMENT_INSTALMENTS))
                         .otherwise(F.lit(PAYMENT_CASH)))


def impute_down_payment(df: DataFrame, by: str = "Developer_Name",
                        col: str = "Down_Payment_Pct", stats_from: DataFrame | None = None
                        ) -> DataFrame:
    """Cash -> 100; missing -> mean of the developer's (clamped, pre-override) values; else keep."""
    if "Payment_Type" not in df.columns:
        df = payment_type(df)
    filled = impute_mean(df, col, by, stats_from)
    return filled.withColumn(col, F.when(F.col("Payment_Type") == PAYMENT_CASH,
                                         F.lit(CASH_DOWN_PAYMENT)).otherwise(F.col(col)))


def flexibility_score(df: DataFrame, out: str = "Payment_Flexibility_Score") -> DataFrame:
    """``round(years / (down payment % + 1), 2)``."""
    return df.withColumn(out, F.round(F.col("Installment_Years") /
                                      (F.col("Down_Payment_Pct") + F.lit(1)), 2))


def ready_to_move(df: DataFrame, as_of, col: str = "Delivery_Date",
                  out: str = "Is_Ready_To_Move") -> DataFrame:
    """Delivered on or before ``as_of`` (a date given by the run, not read from the clock)."""
    return df.withColumn(out, F.coalesce(F.col(col) <= F.lit(as_of).cast("date"), F.lit(False)))
