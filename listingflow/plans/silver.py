"""Silver step: raw listing versions -> one typed, imputed, validated row per listing.

Plan shape: the newest version per Property_ID is found on the key and the order columns alone (with
a partial group limit before that shuffle), its rows are a semi join (or, where ``raw`` is narrow before
its ``shape``, the pick keeps the rows themselves), row-wise cleaning fused into a single codegen stage, and two small grouped means
(City, Developer_Name) joined back. No window ever holds a whole City or Developer group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.operators import cleaning as C
from listingflow.operators.features import (CASH_DOWN_PAYMENT, PAYMENT_CASH, fill_from_means,
                                            flexibility_score, group_means, payment_type,
                                            ready_to_move)
from listingflow.operators.merge import dedup_latest_if, dedup_latest_wide, newest_keys
from listingflow.operators.quality import (REASON_MISSING_KEY, flag_invalid, listing_rules,
                                           missing_key)
from listingflow.session import stage
from listingflow.sources.fixtures import VERSION_ORDER

PRIMARY_KEY = "Property_ID"

# Accepted year ranges of the two dates, and the four numeric text columns read as
# doubles and the three read as decimal(10,2) (new name <- source column).
DELIVERY_YEARS = (2010, 2035)
LISTING_YEARS = (2018, 2027)
DOUBLE_COLUMNS = ("Distance_To_City_Center_KM", "Kitchen_Size_SqM", "Reception_Size_SqM",
                  "Balcony_Size_SqM")
DECIMAL_COLUMNS = (("Transport_Index_Num", "Transport_Index"),
                   ("Nearby_Schools_Score_Num", "Nearby_Schools_Score"),
                   ("NearbyMalls_Dist_KM", "Nearby_Malls_Dist_KM"))
CITY_MEAN_COLUMNS = ("Transport_Index_Num", "Nearby_Schools_Score_Num")


def newest_version_keys(raw: DataFrame, key: str = PRIMARY_KEY, order_cols=VERSION_ORDER) -> DataFrame:
    """Key and order columns of the newest version of every keyed listing, written once."""
    return stage(newest_keys(raw.filter(~missing_key(key)), key, order_cols), "newest-keys")


def newest_versions(raw: DataFrame, key: str = PRIMARY_KEY, order_cols=VERSION_ORDER,
                    newest: DataFrame | None = None, shape=None, narrow: bool = False) -> DataFrame:
    """Newest version of every keyed listing, plus every row without a usable key (each kept
    as it is, to be quarantined). ``__missing_key`` marks the latter. ``newest``: what
    ``newest_version_keys`` gives, if the caller has it. ``shape``: a row-wise function that gives the
    picked rows their columns, for a ``raw`` that is a join; the pick is then pushed below that join.
    ``narrow``: the rows of ``raw`` are narrow as they are, before ``shape`` (which may join) makes them
    wide, so one pass over them picks, and ``raw`` runs once.

    Rows without a key are split off with a filter, or pass the pick by: a group made up for them (a
    running id) would differ when a lost executor's task runs again.
    """
    if narrow:
        rows = dedup_latest_if(raw, key, order_cols, ~missing_key(key))
        rows = rows if shape is None else shape(rows)
        return rows.withColumn("__missing_key", missing_key(key))
    keyed, unkeyed = raw.filter(~missing_key(key)), raw.filter(missing_key(key))
    newest = newest_version_keys(raw, key, order_cols) if newest is None else newest
    keyed = dedup_latest_wide(keyed, key, order_cols, newest)
    if shape is not None:
        keyed, unkeyed = shape(keyed), shape(unkeyed)
    return keyed.withColumn("__missing_key", F.lit(False)).unionByName(unkeyed.withColumn("__missing_key", F.lit(True)))


def clean_rows(df: DataFrame, price_mode: str = "decimal", developer_map=None) -> DataFrame:
    """Row-wise part of the silver step, in its semantic order (no shuffle)."""
    df = C.clean_text(df)
    df = C.parse_dates(df, ["Delivery_Date", "Date"])
    df = C.date_fallback(df, "Date")
    df = C.within_years(df, "Delivery_Date", *DELIVERY_YEARS)
    df = C.within_years(df, "Date", *LISTING_YEARS)
    df = C.parse_amount(df, "Total_Price", price_mode)
    df = C.positive_double(df, "Size_SqM")
    df = C.ratio(df, "Price_Per_SqM", "Total_Price", "Size_SqM")
    df = df.withColumn("year", F.year("Delivery_Date"))
    df = C.clamp(df, "Down_Payment_Pct", 0.0, 100.0, "double")
    df = C.clamp(df, "Installment_Years", 0, 30, "int")
    df = C.clean_text(df, ["Kitchen_Type"], default=None)
    df = C.try_casts(df, {"Has_Elevator": "boolean", **{c: "double" for c in DOUBLE_COLUMNS}})
    if "Smart_Home_Ready" in df.columns:
        df = C.try_casts(df, {"Smart_Home_Ready": "int"})
    df = C.expand_json(df, "Amenities_JSON")
    df = C.clean_name(df, "Developer_Name")
    if developer_map:
        df = C.map_values(df, "Developer_Name", developer_map)
    df = C.validate_domain(df, "Market_Reputation", C.REPUTATION_DOMAIN)
    df = C.validate_domain(df, "Delivery_Punctuality", C.PUNCTUALITY_DOMAIN)
    df = C.scrub_nan(df)
    df = C.recode(df, "Rooms_Count", {0: 1})
    return df.withColumns({new: F.col(src).try_cast("decimal(10,2)")
                           for new, src in DECIMAL_COLUMNS})


MEANS = {"City": list(CITY_MEAN_COLUMNS), "Developer_Name": ["Down_Payment_Pct"]}


def impute_and_derive(df: DataFrame, as_of, means: dict | None = None) -> DataFrame:
    """Group means, defaults and derived payment features.

    The city means (transport, schools) and the developer mean (down payment) come from one
    grouping-sets aggregate of the batch as given (or are ``means``, as ``group_means`` gives
    them); the down-payment mean is over the clamped values of all rows, cash rows included,
    before cash is set to 100.
    """
    means = group_means(df, MEANS) if means is None else means
    df = fill_from_means(df, means["City"], "City", CITY_MEAN_COLUMNS)
    df = df.drop(*[src for _, src in DECIMAL_COLUMNS if src in df.columns])
    df = C.fill_defaults(df, C.AMENITY_DEFAULTS)
    df = payment_type(df)
    df = fill_from_means(df, means["Developer_Name"], "Developer_Name", ["Down_Payment_Pct"])
    df = df.withColumn("Down_Payment_Pct",
                       F.when(F.col("Payment_Type") == PAYMENT_CASH, F.lit(CASH_DOWN_PAYMENT))
                       .otherwise(F.col("Down_Payment_Pct")))
    df = flexibility_score(df)
    return ready_to_move(df, as_of)


MEAN_INPUTS = ("City", "Developer_Name", *CITY_MEAN_COLUMNS, "Down_Payment_Pct")


def cleaned_batch(raw: DataFrame, price_mode: str = "decimal", developer_map=None,
                  key: str = PRIMARY_KEY, order_cols=VERSION_ORDER, newest: DataFrame | None = None,
                  shape=None, narrow: bool = False) -> DataFrame:
    """Newest versions, cleaned, before any mean is filled in or value overridden."""
    return clean_rows(newest_versions(raw, key, order_cols, newest, shape, narrow), price_mode, developer_map)


def mean_inputs(cleaned: DataFrame, key: str = PRIMARY_KEY) -> DataFrame:
    """What a later run's group means need of a cleaned batch: its keyed rows' own values."""
    return cleaned.filter(~F.col("__missing_key")).select(key, *MEAN_INPUTS)


def silver_transform(raw: DataFrame | None, as_of, price_mode: str = "decimal", developer_map=None,
                     key: str = PRIMARY_KEY, order_cols=VERSION_ORDER,
                     materialize: bool = True, cleaned: DataFrame | None = None,
                     means: dict | None = None, shape=None, narrow: bool = False) -> DataFrame:
    """Raw versions -> flagged silver rows (``quarantine_reason`` NULL and ``is_valid`` true for
    good rows). Rows later rejected still feed the group means, as in the source design.

    The cleaned batch is read three times (two group means and the rows themselves); with
    ``materialize`` it is written once under the checkpoint root, so the raw scan, its joins and
    the dedup shuffle run once instead of three times. ``cleaned``: a ``cleaned_batch`` that the
    caller already has, instead of ``raw``. ``means``: group means to use in place of the batch's
    own, such as those of ``plans.history``. ``shape``, ``narrow``: see ``newest_versions``.
    """
    df = cleaned
    if df is None:
        df = cleaned_batch(raw, price_mode, developer_map, key, order_cols, shape=shape, narrow=narrow)
        if materialize:
            df = stage(df, "silver-batch")
    df = impute_and_derive(df, as_of, means)
    rules = [(REASON_MISSING_KEY, F.col("__missing_key")), *listing_rules()]
    return flag_invalid(df, rules).drop("__missing_key")
