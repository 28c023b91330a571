"""Validation, quarantine split and data-quality summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.functions.keys import ts_literal

# Quarantine reasons, tested in the order listed in listing_rules (first match wins).
REASON_MISSING_KEY = "Missing Primary Key"


def listing_rules():
    """The listing rules as fresh Column objects (safe to reuse across sessions)."""
    return (
        ("Missing or Invalid Price", F.col("Total_Price").isNull()),
        ("Missing or Invalid Size", F.col("Size_SqM").isNull()),
        ("Missing City", F.col("City") == "Unknown"),
    )


def missing_key(key: str) -> Column:
    """A business key that is NULL, blank or the text ``nan``."""
    k = F.trim(F.col(key))
    return F.col(key).isNull() | (k == "") | (F.lower(k) == "nan")


def flag_invalid(df: DataFrame, rules=None, reason_col: str = "quarantine_reason",
                 valid_col: str = "is_valid") -> DataFrame:
    """Add the first matching rule's reason (NULL when none matches) and a validity flag."""
    rules = listing_rules() if rules is None else rules
    reason = None
    for name, predicate in rules:
        test = F.coalesce(predicate, F.lit(False))
        reason = F.when(test, F.lit(name)) if reason is None else reason.when(test, F.lit(name))
    return (df.withColumn(reason_col, reason)
            .withColumn(valid_col, F.col(reason_col).isNull()))


def split_valid(df: DataFrame, valid_col: str = "is_valid",
                reason_col: str = "quarantine_reason", quarantine_ts=None
                ) -> tuple[DataFrame, DataFrame]:
    """(good, bad) from a flagged frame. Persist the flagged frame first when both sides are
    written, so the upstream plan runs once."""
    good = df.filter(F.col(valid_col)).drop(valid_col, reason_col)
    bad = df.filter(~F.col(valid_col)).drop(valid_col)
    if quarantine_ts is not None:
        bad = bad.withColumn("quarantine_ts", ts_literal(quarantine_ts))
    return good, bad


def quality_summary(flagged: DataFrame, max_bad_share: float = 0.05,
                    reason_col: str = "quarantine_reason") -> DataFrame:
    """Rows and share per reason ("Valid" for passing rows), with an alert flag on the reasons
    whose share exceeds ``max_bad_share``.

    The grouped count combines map-side; the share is taken over that tiny result (one row per
    rule), so the single-partition total never sees more rows than there are rules.
    """
    counts = (flagged.groupBy(F.coalesce(F.col(reason_col), F.lit("Valid")).alias("reason"))
              .agg(F.count(F.lit(1)).alias("rows")))
    total = F.sum("rows").over(Window.partitionBy())
    return (counts.withColumn("share", F.round(F.col("rows") / total, 6))
            .withColumn("alert", (F.col("reason") != "Valid") & (F.col("share") > max_bad_share)))


def stamp_run(df: DataFrame, run_id: str | None = None, ts=None, id_col: str = "silver_run_id",
              ts_col: str = "silver_updated_at") -> DataFrame:
    """Lineage columns of a run: its id and its time, both bound once per run (literals), so
    every row and every statement of the run carries the same values."""
    cols = {}
    if run_id is not None:
        cols[id_col] = F.lit(run_id)
    if ts is not None:
        cols[ts_col] = ts_literal(ts)
    return df.withColumns(cols)


def observe_counts(df: DataFrame, name: str, mark_col: str | None = None):
    """Attach run metrics to ``df`` that are filled in by the action that runs it (no extra
    job): ``rows`` and, with ``mark_col``, its maximum ``max_mark`` as a stored
    mark (see ``mark_value``).

    Returns ``(df, observation)``; read ``observation.get`` after the action.
    """
    from pyspark.sql import Observation

    from listingflow.sources.tables import mark_value
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if mark_col:
        metrics.append(mark_value(df, mark_col).alias("max_mark"))
    return df.observe(obs, *metrics), obs
