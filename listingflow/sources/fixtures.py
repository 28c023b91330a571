"""``raw_listings``: a deterministic stand-in for raw (bronze) listings, derived by Spark from the
TPC-H-like driver tables, so its size grows with them.

Each ``l_orderkey`` is one listing; its line items are ingested versions of it. The dirty values
(spacing, ``nan``, bad JSON, several date layouts, quoted names) are produced from key residues.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.session import spread

# The column rules of the fixture (Spark SQL), in output order.
RAW_LISTING_COLUMNS = [
    ("Property_ID", "concat('P', cast(l_orderkey as string))"),
    ("City", "case when l_partkey%19=0 then cast(null as string) when l_partkey%23=0 then 'nan' "
             "when l_partkey%43=0 then '  ' when l_partkey%5=0 then concat('  ',lower(n_name),'   zone ') "
             "else concat(n_name,' ZONE') end"),
    ("District", "concat(r_name,'  ',cast(p_size%5 as string))"),
    ("Compound_Name", "case when l_partkey%31=0 then cast(null as string) else concat(' ',p_name) end"),
    ("Unit_Type", "p_type"),
    ("View_Type", "o_orderpriority"),
    ("Kitchen_Type", "case when l_partkey%27=0 then cast(null as string) else c_mktsegment end"),
    ("Delivery_Date", "case l_partkey%8 "
                      "when 0 then date_format(l_shipdate + interval 20 years,'yyyy-MM-dd HH:mm:ss') "
                      "when 1 then date_format(l_shipdate + interval 20 years,'MM/dd/yyyy') "
                      "when 2 then date_format(l_shipdate + interval 20 years,'M/d/yyyy') "
                      "when 3 then date_format(l_shipdate + interval 20 years,'dd-MM-yyyy') "
                      "when 4 then date_format(l_shipdate + interval 20 years,'dd-MMM-yyyy') "
                      "when 5 then date_format(l_shipdate + interval 20 years,'MMM-dd-yyyy') "
                      "when 6 then date_format(l_shipdate + interval 20 years,'MMM dd, yyyy') "
                      "else 'TBD' end"),
    ("Date", "case o_orderkey%4 when 0 then date_format(o_orderdate + interval 24 years,'yyyy-MM-dd') "
             "when 1 then date_format(o_orderdate + interval 24 years,'MM/dd/yyyy') when 2 then '' "
             "else date_format(o_orderdate + interval 28 years,'dd-MMM-yyyy') end"),
    ("ingestion_time", "l_shipdate + interval 24 years"),
    ("Total_Price", "case when l_partkey%29=0 then '' "
                    "when l_partkey%13=0 then concat(cast(cast(floor(l_extendedprice) as bigint) as string),'.50') "
                    "when l_partkey%17=0 then concat(cast(1+l_partkey%9 as string),' 250 000') "
                    "when l_partkey%19=0 then concat(cast(1+l_partkey%9 as string),'.250.000,5') "
                    "when l_partkey%23=0 then concat(cast(1+l_partkey%9 as string),',250,000.75 EGP') "
                    "when l_partkey%43=0 then concat(cast(1+l_partkey%9 as string),',5') "
                    "when l_partkey%47=0 then concat(cast(1+l_partkey%9 as string),'.250') "
                    "when l_partkey%7=0 then concat('EGP ',cast(cast(floor(l_extendedprice) as bigint) as string)) "
                    "else cast(cast(floor(l_extendedprice) as bigint) as string) end"),
    ("Size_SqM", "case when l_partkey%31=0 then '0' when l_partkey%37=0 then 'nan' "
                 "when l_partkey%41=0 then '-5' else cast(cast(l_quantity as int)*5 as string) end"),
    ("Down_Payment_Pct", "case when l_partkey%9=0 then cast(null as string) "
                         "else cast(cast(round(l_discount*1500) as int)-10 as string) end"),
    ("Installment_Years", "case when l_partkey%15=0 then cast(null as string) "
                          "else cast(l_linenumber*6-8 as string) end"),
    ("Has_Elevator", "case l_partkey%4 when 0 then 'true' when 1 then 'false' when 2 then '1' "
                     "else cast(null as string) end"),
    ("Distance_To_City_Center_KM", "concat(cast(p_size as string),'.5')"),
    ("Kitchen_Size_SqM", "cast(p_size%20 as string)"),
    ("Reception_Size_SqM", "cast(p_size+10 as string)"),
    ("Balcony_Size_SqM", "case when l_partkey%10=0 then 'n/a' else cast(p_size%8 as string) end"),
    ("Amenities_JSON", "case when l_partkey%11=0 then 'bad json' else concat('{\"has_pool\":',"
                       "case when l_partkey%2=0 then 'true' else 'false' end,"
                       "',\"security\":\"24/7\",\"parking_spots\":',cast(l_partkey%4 as string),'}') end"),
    ("Developer_Name", "case when l_suppkey%50=49 then cast(null as string) "
                       "when l_suppkey%6=0 then concat('\"',s_name,'\",') else s_name end"),
    ("Market_Reputation", "case (l_suppkey+year(l_shipdate))%5 when 0 then 'HIGH' when 1 then 'low' "
                          "when 2 then 'Excellent' when 3 then 'n/a' else cast(null as string) end"),
    ("Delivery_Punctuality", "case (l_suppkey*2+year(l_shipdate))%4 when 0 then 'high' "
                             "when 1 then 'MEDIUM' when 2 then 'late' else 'Low' end"),
    ("Rooms_Count", "p_size%4"),
    ("Transport_Index", "case when l_partkey%7=0 then cast(null as string) "
                        "else cast(l_partkey%100 as string) end"),
    ("Nearby_Schools_Score", "case when l_partkey%6=0 then 'nan' "
                             "else concat(cast(l_partkey%10 as string),'.25') end"),
    ("Nearby_Malls_Dist_KM", "concat(cast(p_size%15 as string),'.75')"),
    ("Smart_Home_Ready", "case when l_partkey%3=0 then cast(null as int) else cast(l_partkey%2 as int) end"),
    ("bronze_ingested_at", "l_shipdate"),
    ("source_file_path", "concat('part-',cast(l_linenumber as string),'.parquet')"),
    ("row_seq", "l_linenumber*10000000+l_partkey"),
]

# Total order of versions inside one listing: ingest time, then the tie-break.
VERSION_ORDER = ("bronze_ingested_at", "row_seq")
VERSION_COLUMNS = ("Property_ID", *VERSION_ORDER)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_driver_table(spark, sf_dir, "customer")
    return spread(read_driver_table(spark, sf_dir, "orders")).join(customer, F.col("o_custkey") == F.col("c_custkey"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (read_driver_table(spark, sf_dir, name) for name in ("nation", "region"))
    return (read_driver_table(spark, sf_dir, "supplier")
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")))


def joined_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined driver tables behind ``raw_listings``, with the columns that name a version; all other
    columns of a raw listing are made of a row by ``shape_listings``.

    Plan: lineitem joins orders (+customer) on the order key and part on the part key by
    shuffle (AQE may turn a side into a broadcast after measuring it); supplier joins the
    25-row nation and 5-row region by broadcast (fixed TPC-H sizes), then lineitem by key.
    A lineitem or orders file with fewer splits than cores is spread first
    (``session.spread``), so whichever side AQE streams through the joins runs on every core.
    The columns that name a version come from the line item alone and are made below the joins, so
    that a semi join on them can be pushed there (Spark 4.1 pushes it past plain columns only, so
    also not past ``shape_listings``).
    """
    t = lambda name: read_driver_table(spark, sf_dir, name)
    orders, supplier = _orders(spark, sf_dir), _suppliers(spark, sf_dir)
    below = [(name, expr) for name, expr in RAW_LISTING_COLUMNS if name in VERSION_COLUMNS]
    return (spread(t("lineitem")).selectExpr("*", *[f"{expr} AS {name}" for name, expr in below])
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
              .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))


def shape_listings(joined: DataFrame) -> DataFrame:
    """Rows of ``joined_listings`` as raw listings."""
    return joined.selectExpr(*[name if name in VERSION_COLUMNS else f"{expr} AS {name}"
                               for name, expr in RAW_LISTING_COLUMNS])


def listing_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows of ``raw_listings`` before part and supplier give them their columns, and the function
    that does that: ``(versions, shape)``.

    A version has the columns of its line item and order and those that name it. Part and supplier are
    joined on their keys alone here (a row without either is no listing), so what passes by those two
    shuffles is narrow; ``shape`` joins their columns to the rows that the caller has picked. The join by
    order comes last: versions of an order then lie in one task, and a partial limit per listing
    drops all but one of them before the next shuffle. A key that part or supplier repeats makes as many
    versions as in ``raw_listings``; ``shape`` takes one of its rows.
    """
    parts, suppliers = read_driver_table(spark, sf_dir, "part"), _suppliers(spark, sf_dir)
    versions = (spread(read_driver_table(spark, sf_dir, "lineitem"))
                .join(parts.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
                .join(suppliers.select("s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")
                .join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
                .selectExpr("*", *[f"{expr} AS {name}" for name, expr in RAW_LISTING_COLUMNS if name in VERSION_COLUMNS]))

    def shape(rows: DataFrame) -> DataFrame:
        part = read_driver_table(spark, sf_dir, "part").dropDuplicates(["p_partkey"])
        supplier = _suppliers(spark, sf_dir).dropDuplicates(["s_suppkey"])
        return shape_listings(rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
                              .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))

    return versions, shape


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as raw listing versions (one row per line item, nothing dropped)."""
    return shape_listings(joined_listings(spark, sf_dir))
