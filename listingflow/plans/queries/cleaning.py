"""Row-wise cleaning queries (P4-P19, P23): every raw listing version, over the whole fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingflow.operators import cleaning as C
from listingflow.plans import oracle as O
from listingflow.plans.queries.base import register
from listingflow.sources.fixtures import raw_listings, read_driver_table


# ---------------------------------------------------------------- row-wise cleaning (P4-P19)

@register("clean_text", O.with_ctes(O.RAW) + f"""
SELECT Property_ID, row_seq,
  {O.clean_text('City')} AS City, {O.clean_text('District')} AS District,
  {O.clean_text('Compound_Name')} AS Compound_Name, {O.clean_text('Unit_Type')} AS Unit_Type,
  {O.clean_text('View_Type')} AS View_Type, {O.clean_text('Kitchen_Type', None)} AS Kitchen_Type
FROM raw""")
def q_clean_text(spark, sf_dir):
    df = C.clean_text(raw_listings(spark, sf_dir))
    df = C.clean_text(df, ["Kitchen_Type"], default=None)
    return df.select("Property_ID", "row_seq", *C.TEXT_COLUMNS, "Kitchen_Type")


@register("parse_dates", O.with_ctes(O.RAW) + f"""
SELECT Property_ID, row_seq,
  {O.within_years(O.parse_date('Delivery_Date'), 2010, 2035)} AS Delivery_Date,
  {O.within_years(f"coalesce({O.parse_date('Date')}, cast(ingestion_time AS date))", 2018, 2027)} AS "Date",
  year({O.within_years(O.parse_date('Delivery_Date'), 2010, 2035)}) AS year
FROM raw""")
def q_parse_dates(spark, sf_dir):
    df = C.parse_dates(raw_listings(spark, sf_dir), ["Delivery_Date", "Date"])
    df = C.date_fallback(df, "Date")
    df = C.within_years(df, "Delivery_Date", 2010, 2035)
    df = C.within_years(df, "Date", 2018, 2027)
    return df.select("Property_ID", "row_seq", "Delivery_Date", "Date",
                     F.year("Delivery_Date").alias("year"))


@register("parse_amounts", O.with_ctes(O.RAW) + f"""
SELECT Property_ID, row_seq, {O.parse_amount('Total_Price')} AS Total_Price,
  {O.positive_double('Size_SqM')} AS Size_SqM,
  cast({O.parse_amount('Total_Price')} AS double) / {O.positive_double('Size_SqM')} AS Price_Per_SqM
FROM raw""")
def q_parse_amounts(spark, sf_dir):
    df = C.parse_amount(raw_listings(spark, sf_dir), "Total_Price")
    df = C.positive_double(df, "Size_SqM")
    df = C.ratio(df, "Price_Per_SqM", "Total_Price", "Size_SqM")
    return df.select("Property_ID", "row_seq", "Total_Price", "Size_SqM", "Price_Per_SqM")


@register("clamp_terms", O.with_ctes(O.RAW) + f"""
SELECT Property_ID, row_seq,
  {O.clamp_double('Down_Payment_Pct', 0.0, 100.0)} AS Down_Payment_Pct,
  {O.clamp_int('Installment_Years', 0, 30)} AS Installment_Years,
  try_cast(Has_Elevator AS boolean) AS Has_Elevator,
  try_cast(Distance_To_City_Center_KM AS double) AS Distance_To_City_Center_KM,
  try_cast(Kitchen_Size_SqM AS double) AS Kitchen_Size_SqM,
  try_cast(Reception_Size_SqM AS double) AS Reception_Size_SqM,
  try_cast(Balcony_Size_SqM AS double) AS Balcony_Size_SqM,
  try_cast({O.scrub('Transport_Index')} AS decimal(10,2)) AS Transport_Index_Num,
  try_cast({O.scrub('Nearby_Schools_Score')} AS decimal(10,2)) AS Nearby_Schools_Score_Num,
  try_cast({O.scrub('Nearby_Malls_Dist_KM')} AS decimal(10,2)) AS NearbyMalls_Dist_KM
FROM raw""")
def q_clamp_terms(spark, sf_dir):
    df = C.clamp(raw_listings(spark, sf_dir), "Down_Payment_Pct", 0.0, 100.0, "double")
    df = C.clamp(df, "Installment_Years", 0, 30, "int")
    df = C.try_casts(df, {"Has_Elevator": "boolean", "Distance_To_City_Center_KM": "double",
                          "Kitchen_Size_SqM": "double", "Reception_Size_SqM": "double",
                          "Balcony_Size_SqM": "double"})
    df = C.scrub_nan(df, cols=["Transport_Index", "Nearby_Schools_Score", "Nearby_Malls_Dist_KM"])
    df = df.withColumns({"Transport_Index_Num": F.col("Transport_Index").try_cast("decimal(10,2)"),
                         "Nearby_Schools_Score_Num":
                             F.col("Nearby_Schools_Score").try_cast("decimal(10,2)"),
                         "NearbyMalls_Dist_KM":
                             F.col("Nearby_Malls_Dist_KM").try_cast("decimal(10,2)")})
    return df.select("Property_ID", "row_seq", "Down_Payment_Pct", "Installment_Years",
                     "Has_Elevator", "Distance_To_City_Center_KM", "Kitchen_Size_SqM",
                     "Reception_Size_SqM", "Balcony_Size_SqM", "Transport_Index_Num",
                     "Nearby_Schools_Score_Num", "NearbyMalls_Dist_KM")


_J = "Amenities_JSON"


@register("expand_amenities", O.with_ctes(O.RAW) + f"""
SELECT Property_ID, row_seq,
  coalesce(CASE WHEN json_valid({_J}) THEN try_cast(json_extract_string({_J}, '$.has_pool') AS boolean) END, false) AS has_pool,
  coalesce(CASE WHEN json_valid({_J}) THEN try_cast(json_extract_string({_J}, '$.gym') AS boolean) END, false) AS gym,
  coalesce(CASE WHEN json_valid({_J}) THEN json_extract_string({_J}, '$.security') END, 'None') AS security,
  coalesce(CASE WHEN json_valid({_J}) THEN try_cast(json_extract_string({_J}, '$.parking_spots') AS integer) END, 0) AS parking_spots,
  coalesce(Smart_Home_Ready, 0) AS Smart_Home_Ready
FROM raw""")
def q_expand_amenities(spark, sf_dir):
    df = C.expand_json(raw_listings(spark, sf_dir), "Amenities_JSON")
    df = C.fill_defaults(df, C.AMENITY_DEFAULTS)
    return df.select("Property_ID", "row_seq", "has_pool", "gym", "security", "parking_spots",
                     "Smart_Home_Ready")


@register("clean_names", O.with_ctes(O.RAW) + f"""
SELECT Property_ID, row_seq, {O.clean_name('Developer_Name')} AS Developer_Name FROM raw""")
def q_clean_names(spark, sf_dir):
    df = C.clean_name(raw_listings(spark, sf_dir), "Developer_Name")
    return df.select("Property_ID", "row_seq", "Developer_Name")


@register("map_values", O.with_ctes(O.RAW, f"""names AS (
  SELECT s_name AS from_value, concat(s_name, ' (', {O.initcap('n_name')}, ')') AS to_value
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)""") + f"""
SELECT Property_ID, row_seq, coalesce(to_value, {O.clean_name('Developer_Name')}) AS Developer_Name
FROM raw LEFT JOIN names ON {O.clean_name('Developer_Name')} = from_value""")
def q_map_values(spark, sf_dir):
    """Spelling map given as a table (supplier name -> labelled name), applied by a join."""
    nation = read_driver_table(spark, sf_dir, "nation")
    names = (read_driver_table(spark, sf_dir, "supplier")
             .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
             .select(F.col("s_name").alias("from_value"),
                     F.concat("s_name", F.lit(" ("), F.initcap("n_name"), F.lit(")"))
                     .alias("to_value")))
    df = C.clean_name(raw_listings(spark, sf_dir), "Developer_Name")
    df = C.map_values(df, "Developer_Name", names)
    return df.select("Property_ID", "row_seq", "Developer_Name")


@register("validate_domain", O.with_ctes(O.RAW) + f"""
SELECT Property_ID, row_seq,
  {O.domain('Market_Reputation', O.REPUTATION)} AS Market_Reputation,
  {O.domain('Delivery_Punctuality', O.PUNCTUALITY)} AS Delivery_Punctuality,
  CASE WHEN Rooms_Count = 0 THEN 1 ELSE Rooms_Count END AS Rooms_Count,
  {O.scrub(O.clean_text('City'))} AS City,
  {O.scrub('Nearby_Schools_Score')} AS Nearby_Schools_Score
FROM raw""")
def q_validate_domain(spark, sf_dir):
    df = C.validate_domain(raw_listings(spark, sf_dir), "Market_Reputation", C.REPUTATION_DOMAIN)
    df = C.validate_domain(df, "Delivery_Punctuality", C.PUNCTUALITY_DOMAIN)
    df = C.recode(df, "Rooms_Count", {0: 1})
    df = C.clean_text(df, ["City"])
    df = C.scrub_nan(df)
    return df.select("Property_ID", "row_seq", "Market_Reputation", "Delivery_Punctuality",
                     "Rooms_Count", "City", "Nearby_Schools_Score")


@register("price_digits", O.with_ctes(O.RAW) + """
SELECT Property_ID, row_seq,
  CASE WHEN try_cast(nullif(regexp_replace(Total_Price, '[^0-9]', '', 'g'), '') AS bigint) > 0
       THEN try_cast(nullif(regexp_replace(Total_Price, '[^0-9]', '', 'g'), '') AS bigint) END AS Total_Price
FROM raw""")
def q_price_digits(spark, sf_dir):
    """The digit-only price reading of the source scripts ("12.50" -> 1250), kept as a mode."""
    df = C.parse_amount(raw_listings(spark, sf_dir), "Total_Price", mode="digits")
    return df.select("Property_ID", "row_seq", "Total_Price")
