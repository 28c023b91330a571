"""Keyed silver queries: newest versions, group means, validation, marks and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.operators.dims import PROFILE_COLUMNS
from listingflow.operators.merge import dedup_latest
from listingflow.operators.quality import quality_summary, split_valid
from listingflow.plans import oracle as O
from listingflow.plans.queries.base import AS_OF, _round, register, silver_flagged, silver_good
from listingflow.plans.silver import silver_transform
from listingflow.session import stage
from listingflow.sources.fixtures import VERSION_ORDER, listing_versions, raw_listings


# ---------------------------------------------------------------- keyed silver steps

@register("dedup_latest", O.with_ctes(O.RAW, O.DEDUP) + """
SELECT Property_ID, bronze_ingested_at, row_seq, source_file_path FROM dd""")
def q_dedup_latest(spark, sf_dir):
    df = dedup_latest(raw_listings(spark, sf_dir), "Property_ID", VERSION_ORDER)
    return df.select("Property_ID", "bronze_ingested_at", "row_seq", "source_file_path")


@register("impute_city_mean", O.with_ctes(O.SILVER_CTES) + f"""
SELECT Property_ID, City,
  {O.spark_round('round(Transport_Index_Num, 6)', 4)} AS Transport_Index_Num,
  {O.spark_round('round(Nearby_Schools_Score_Num, 6)', 4)} AS Nearby_Schools_Score_Num
FROM silver""")
def q_impute_city_mean(spark, sf_dir):
    df = silver_flagged(spark, sf_dir)
    return df.select("Property_ID", "City", _round("Transport_Index_Num", 4),
                     _round("Nearby_Schools_Score_Num", 4))


@register("impute_down_payment", O.with_ctes(O.SILVER_CTES) + f"""
SELECT Property_ID, Developer_Name, Payment_Type,
  round(Down_Payment_Pct, 6) AS Down_Payment_Pct, Payment_Flexibility_Score
FROM silver""")
def q_impute_down_payment(spark, sf_dir):
    df = silver_flagged(spark, sf_dir)
    return df.select("Property_ID", "Developer_Name", "Payment_Type",
                     _round("Down_Payment_Pct", 6), "Payment_Flexibility_Score")


@register("ready_to_move", O.with_ctes(O.SILVER_CTES) + """
SELECT Property_ID, Delivery_Date, Is_Ready_To_Move FROM silver""")
def q_ready_to_move(spark, sf_dir):
    return silver_flagged(spark, sf_dir).select("Property_ID", "Delivery_Date", "Is_Ready_To_Move")


@register("quarantine_split", O.with_ctes(O.SILVER_CTES) + """
SELECT Property_ID, quarantine_reason, Total_Price, Size_SqM, City
FROM silver WHERE quarantine_reason IS NOT NULL""")
def q_quarantine_split(spark, sf_dir):
    _, bad = split_valid(silver_flagged(spark, sf_dir))
    return bad.select("Property_ID", "quarantine_reason", "Total_Price", "Size_SqM", "City")


@register("quality_summary", O.with_ctes(O.SILVER_CTES) + """
SELECT reason, rows, round(rows / sum(rows) OVER (), 6) AS share,
       reason <> 'Valid' AND round(rows / sum(rows) OVER (), 6) > 0.05 AS alert
FROM (SELECT coalesce(quarantine_reason, 'Valid') AS reason, count(*) AS rows
      FROM silver GROUP BY 1)""")
def q_quality_summary(spark, sf_dir):
    return quality_summary(silver_flagged(spark, sf_dir), max_bad_share=0.05)


SILVER_COLUMNS = (
    "Property_ID", "City", "District", "Compound_Name", "Unit_Type", "View_Type", "Kitchen_Type",
    "Delivery_Date", "Date", "ingestion_time", "Total_Price", "Size_SqM", "Installment_Years",
    "Has_Elevator", "Distance_To_City_Center_KM", "Kitchen_Size_SqM", "Reception_Size_SqM",
    "Balcony_Size_SqM", "Developer_Name", "Market_Reputation", "Delivery_Punctuality",
    "Rooms_Count", "Smart_Home_Ready", "bronze_ingested_at", "source_file_path", "row_seq",
    "Price_Per_SqM", "year", "has_pool", "gym", "security", "parking_spots",
    "NearbyMalls_Dist_KM", "Payment_Type", "Payment_Flexibility_Score", "Is_Ready_To_Move")


@register("silver_listings", O.with_ctes(O.SILVER_CTES) + f"""
SELECT {', '.join('"Date"' if c == 'Date' else c for c in SILVER_COLUMNS)},
  round(Down_Payment_Pct, 6) AS Down_Payment_Pct,
  {O.spark_round('round(Transport_Index_Num, 6)', 4)} AS Transport_Index_Num,
  {O.spark_round('round(Nearby_Schools_Score_Num, 6)', 4)} AS Nearby_Schools_Score_Num
FROM silver WHERE quarantine_reason IS NULL""")
def q_silver_listings(spark, sf_dir):
    return silver_good(spark, sf_dir).select(
        *SILVER_COLUMNS, _round("Down_Payment_Pct", 6), _round("Transport_Index_Num", 4),
        _round("Nearby_Schools_Score_Num", 4))


# ---------------------------------------------------------------- incremental read and merges

def _control_mark(spark, df: DataFrame, before: str):
    """High-water mark of a first batch (rows ingested before ``before``) as a control row,
    read back the way a later run reads it."""
    from listingflow.sources.tables import control_row, last_mark, max_mark
    first = df.filter(F.col("bronze_ingested_at") < F.lit(before).cast("timestamp_ntz"))
    mark = max_mark(first, "bronze_ingested_at")
    control = control_row(spark, "silver", "listings", mark, 0, "SUCCESS", "batch-1", mark)
    return last_mark(control, "silver", "listings")


@register("incremental_read", O.with_ctes(O.RAW) + """
SELECT Property_ID, row_seq, bronze_ingested_at FROM raw
WHERE bronze_ingested_at > (SELECT max(bronze_ingested_at) FROM raw
                            WHERE bronze_ingested_at < TIMESTAMP '1998-01-01')""")
def q_incremental_read(spark, sf_dir):
    from listingflow.sources.tables import newer_than
    raw = raw_listings(spark, sf_dir)
    mark = _control_mark(spark, raw, "1998-01-01 00:00:00")
    return newer_than(raw, "bronze_ingested_at", mark).select("Property_ID", "row_seq",
                                                               "bronze_ingested_at")


_FIRST = "bronze_ingested_at < TIMESTAMP '1998-01-01'"
_SECOND = "bronze_ingested_at >= TIMESTAMP '1998-01-01'"


def _halves(spark, sf_dir):
    # Each batch's time filter reaches its own lineitem scan, so the two batches together join
    # the raw tables once.
    raw, shape = listing_versions(spark, sf_dir)
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    first, _ = split_valid(silver_transform(raw.filter(F.col("bronze_ingested_at") < cut), AS_OF, shape=shape, narrow=True))
    second, _ = split_valid(silver_transform(raw.filter(F.col("bronze_ingested_at") >= cut), AS_OF, shape=shape, narrow=True))
    return first, second


_UPSERT_COLS = "Property_ID, bronze_ingested_at, row_seq, Total_Price, Size_SqM, City, Developer_Name"


@register("upsert_listings", O.with_ctes(O.RAW, *O.silver_ctes("1", _FIRST), *O.silver_ctes("2", _SECOND)) + f"""
SELECT {_UPSERT_COLS} FROM silver1 t
WHERE quarantine_reason IS NULL
  AND NOT EXISTS (SELECT 1 FROM silver2 s WHERE s.quarantine_reason IS NULL AND s.Property_ID = t.Property_ID)
UNION ALL
SELECT {_UPSERT_COLS} FROM silver2 WHERE quarantine_reason IS NULL""")
def q_upsert_listings(spark, sf_dir):
    from listingflow.operators.merge import upsert
    first, second = _halves(spark, sf_dir)
    return upsert(first, second, ["Property_ID"]).select(*_UPSERT_COLS.split(", "))


@register("impute_history_mean", O.with_ctes(O.RAW, *O.silver_ctes("1", _FIRST), *O.silver_ctes("2", _SECOND), """
hist AS (SELECT City, Developer_Name, Transport_Index_Num AS ti, Down_Payment_Pct AS dp FROM c1
         WHERE Property_ID NOT IN (SELECT Property_ID FROM c2)
         UNION ALL SELECT City, Developer_Name, Transport_Index_Num, Down_Payment_Pct FROM c2),
m AS (SELECT City, avg(ti) AS ti_mean FROM hist GROUP BY City),
d AS (SELECT Developer_Name, avg(dp) AS dp_mean FROM hist GROUP BY Developer_Name)""") + f"""
SELECT s.Property_ID, s.City,
  {O.spark_round('round(coalesce(s.Transport_Index_Num, m.ti_mean), 10)', 4)} AS Transport_Index_Num,
  {O.spark_round("CASE WHEN NOT coalesce(s.Installment_Years > 0, false) THEN 100.0 ELSE coalesce(s.Down_Payment_Pct, d.dp_mean) END", 6)} AS Down_Payment_Pct
FROM c2 s LEFT JOIN m ON s.City = m.City LEFT JOIN d ON s.Developer_Name = d.Developer_Name""")
def q_impute_history_mean(spark, sf_dir):
    """Means from history: gaps of the second batch are filled with means over its own cleaned
    values and those of the first batch's listings that it does not replace, by the first batch's
    sums per group less what the second one replaces."""
    from listingflow.operators.features import group_sums
    from listingflow.plans.history import replaced_rows, running_means
    from listingflow.plans.silver import MEANS, cleaned_batch, mean_inputs
    raw, shape = listing_versions(spark, sf_dir)
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    first = stage(mean_inputs(cleaned_batch(raw.filter(F.col("bronze_ingested_at") < cut), shape=shape, narrow=True)), "history-inputs")
    batch = stage(cleaned_batch(raw.filter(F.col("bronze_ingested_at") >= cut), shape=shape, narrow=True), "history-batch")
    replaced = replaced_rows(first, mean_inputs(batch)).filter("known")
    out = silver_transform(None, AS_OF, cleaned=batch, means=running_means(group_sums(first, MEANS), replaced, batch))
    return out.select("Property_ID", "City", _round("Transport_Index_Num", 4), _round("Down_Payment_Pct", 6))


_PROFILE = tuple(PROFILE_COLUMNS)
_PROFILE_SQL = ", ".join(_PROFILE)


@register("insert_new_profiles", O.with_ctes(O.RAW, *O.silver_ctes("1", _FIRST), *O.silver_ctes("2", _SECOND), f"""
p1 AS (SELECT DISTINCT {_PROFILE_SQL} FROM silver1 WHERE quarantine_reason IS NULL),
p2 AS (SELECT DISTINCT {_PROFILE_SQL} FROM silver2 WHERE quarantine_reason IS NULL)""") + f"""
SELECT {_PROFILE_SQL}, {O.hash_key(*_PROFILE)} AS profile_sk FROM p1
UNION ALL
SELECT {_PROFILE_SQL}, {O.hash_key(*_PROFILE)} AS profile_sk FROM p2
WHERE {O.hash_key(*_PROFILE)} NOT IN (SELECT {O.hash_key(*_PROFILE)} FROM p1)""")
def q_insert_new_profiles(spark, sf_dir):
    from listingflow.operators.dims import merge_profile, profile_batch
    first, second = _halves(spark, sf_dir)
    return merge_profile(profile_batch(first), profile_batch(second))
