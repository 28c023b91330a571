"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each query is written from the operator's specification, in DuckDB's own dialect (windows where
the Spark job uses joins, ``try_strptime`` instead of Spark layouts, and so on). Spark and DuckDB
differ in a few places, handled here: DuckDB has no ``initcap`` (built from a word list), rounds
doubles half-away on the binary value where Spark rounds the shortest decimal text (rounded
through that text here), and averages decimals as doubles (results are rounded alike).
"""

from __future__ import annotations

AS_OF = "2021-06-30"

# Raw listings from the driver tables (same rules as listingflow.sources.fixtures, DuckDB form).
RAW = """raw AS (
SELECT
  'P' || cast(l_orderkey AS varchar) AS Property_ID,
  CASE WHEN l_partkey%19=0 THEN cast(NULL AS varchar) WHEN l_partkey%23=0 THEN 'nan'
       WHEN l_partkey%43=0 THEN '  ' WHEN l_partkey%5=0 THEN concat('  ',lower(n_name),'   zone ')
       ELSE concat(n_name,' ZONE') END AS City,
  concat(r_name,'  ',cast(p_size%5 AS varchar)) AS District,
  CASE WHEN l_partkey%31=0 THEN cast(NULL AS varchar) ELSE concat(' ',p_name) END AS Compound_Name,
  p_type AS Unit_Type,
  o_orderpriority AS View_Type,
  CASE WHEN l_partkey%27=0 THEN cast(NULL AS varchar) ELSE c_mktsegment END AS Kitchen_Type,
  CASE l_partkey%8
    WHEN 0 THEN strftime(l_shipdate + INTERVAL 20 YEARS,'%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(l_shipdate + INTERVAL 20 YEARS,'%m/%d/%Y')
    WHEN 2 THEN strftime(l_shipdate + INTERVAL 20 YEARS,'%-m/%-d/%Y')
    WHEN 3 THEN strftime(l_shipdate + INTERVAL 20 YEARS,'%d-%m-%Y')
    WHEN 4 THEN strftime(l_shipdate + INTERVAL 20 YEARS,'%d-%b-%Y')
    WHEN 5 THEN strftime(l_shipdate + INTERVAL 20 YEARS,'%b-%d-%Y')
    WHEN 6 THEN strftime(l_shipdate + INTERVAL 20 YEARS,'%b %d, %Y')
    ELSE 'TBD' END AS Delivery_Date,
  CASE o_orderkey%4
    WHEN 0 THEN strftime(o_orderdate + INTERVAL 24 YEARS,'%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate + INTERVAL 24 YEARS,'%m/%d/%Y')
    WHEN 2 THEN ''
    ELSE strftime(o_orderdate + INTERVAL 28 YEARS,'%d-%b-%Y') END AS "Date",
  l_shipdate + INTERVAL 24 YEARS AS ingestion_time,
  CASE WHEN l_partkey%29=0 THEN ''
       WHEN l_partkey%13=0 THEN concat(cast(cast(floor(l_extendedprice) AS bigint) AS varchar),'.50')
       WHEN l_partkey%17=0 THEN concat(cast(1+l_partkey%9 AS varchar),' 250 000')
       WHEN l_partkey%19=0 THEN concat(cast(1+l_partkey%9 AS varchar),'.250.000,5')
       WHEN l_partkey%23=0 THEN concat(cast(1+l_partkey%9 AS varchar),',250,000.75 EGP')
       WHEN l_partkey%43=0 THEN concat(cast(1+l_partkey%9 AS varchar),',5')
       WHEN l_partkey%47=0 THEN concat(cast(1+l_partkey%9 AS varchar),'.250')
       WHEN l_partkey%7=0 THEN concat('EGP ',cast(cast(floor(l_extendedprice) AS bigint) AS varchar))
       ELSE cast(cast(floor(l_extendedprice) AS bigint) AS varchar) END AS Total_Price,
  CASE WHEN l_partkey%31=0 THEN '0' WHEN l_partkey%37=0 THEN 'nan' WHEN l_partkey%41=0 THEN '-5'
       ELSE cast(cast(trunc(l_quantity) AS integer)*5 AS varchar) END AS Size_SqM,
  CASE WHEN l_partkey%9=0 THEN cast(NULL AS varchar)
       ELSE cast(cast(round(l_discount*1500) AS integer)-10 AS varchar) END AS Down_Payment_Pct,
  CASE WHEN l_partkey%15=0 THEN cast(NULL AS varchar)
       ELSE cast(l_linenumber*6-8 AS varchar) END AS Installment_Years,
  CASE l_partkey%4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '1'
       ELSE cast(NULL AS varchar) END AS Has_Elevator,
  concat(cast(p_size AS varchar),'.5') AS Distance_To_City_Center_KM,
  cast(p_size%20 AS varchar) AS Kitchen_Size_SqM,
  cast(p_size+10 AS varchar) AS Reception_Size_SqM,
  CASE WHEN l_partkey%10=0 THEN 'n/a' ELSE cast(p_size%8 AS varchar) END AS Balcony_Size_SqM,
  CASE WHEN l_partkey%11=0 THEN 'bad json'
       ELSE concat('{"has_pool":', CASE WHEN l_partkey%2=0 THEN 'true' ELSE 'false' END,
                   ',"security":"24/7","parking_spots":', cast(l_partkey%4 AS varchar), '}')
       END AS Amenities_JSON,
  CASE WHEN l_suppkey%50=49 THEN cast(NULL AS varchar)
       WHEN l_suppkey%6=0 THEN concat('"',s_name,'",') ELSE s_name END AS Developer_Name,
  CASE (l_suppkey+year(l_shipdate))%5 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'low' WHEN 2 THEN 'Excellent'
       WHEN 3 THEN 'n/a' ELSE cast(NULL AS varchar) END AS Market_Reputation,
  CASE (l_suppkey*2+year(l_shipdate))%4 WHEN 0 THEN 'high' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'late'
       ELSE 'Low' END AS Delivery_Punctuality,
  p_size%4 AS Rooms_Count,
  CASE WHEN l_partkey%7=0 THEN cast(NULL AS varchar) ELSE cast(l_partkey%100 AS varchar) END AS Transport_Index,
  CASE WHEN l_partkey%6=0 THEN 'nan' ELSE concat(cast(l_partkey%10 AS varchar),'.25') END AS Nearby_Schools_Score,
  concat(cast(p_size%15 AS varchar),'.75') AS Nearby_Malls_Dist_KM,
  CASE WHEN l_partkey%3=0 THEN cast(NULL AS integer) ELSE cast(l_partkey%2 AS integer) END AS Smart_Home_Ready,
  l_shipdate AS bronze_ingested_at,
  concat('part-',cast(l_linenumber AS varchar),'.parquet') AS source_file_path,
  l_linenumber*10000000+l_partkey AS row_seq
FROM lineitem
JOIN orders ON l_orderkey=o_orderkey
JOIN customer ON o_custkey=c_custkey
JOIN part ON l_partkey=p_partkey
JOIN supplier ON l_suppkey=s_suppkey
JOIN nation ON s_nationkey=n_nationkey
JOIN region ON n_regionkey=r_regionkey
)"""


def initcap(x: str) -> str:
    """Spark ``initcap`` on single-spaced text: lower everything, upper each word's first letter."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def clean_text(x: str, default: str | None = "'Unknown'") -> str:
    squeezed = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    tidy = f"nullif({initcap(squeezed)}, '')"
    return tidy if default is None else f"coalesce({tidy}, {default})"


def parse_date(x: str) -> str:
    d = f"regexp_replace({x}, '\\s+', '', 'g')"
    tries = [f"try_strptime(substr({d},1,10), '%Y-%m-%d')"] + [
        f"try_strptime({d}, '{fmt}')"
        for fmt in ("%m/%d/%Y", "%d-%m-%Y", "%d-%b-%Y", "%b-%d-%Y", "%b%d,%Y")]
    return f"cast(coalesce({', '.join(tries)}) AS date)"


def within_years(d: str, lo: int, hi: int) -> str:
    return f"CASE WHEN year({d}) BETWEEN {lo} AND {hi} THEN {d} END"


def parse_amount(x: str) -> str:
    """Price text read style by style: the currency word is cut off, then each style has its own
    full pattern and its own way to a plain number."""
    word = r"[\p{L}\p{Sc}]+[.]?"
    t = (f"trim(regexp_replace(regexp_replace(trim({x}), '^{word}\\s*', ''), "
         f"'([0-9.])\\s*{word}$', '\\1'))")
    three = r"\d\d\d"
    v = f"""try_cast(CASE
      WHEN regexp_full_match({t}, '[-+]?[1-9]\\d?\\d?[.]{three}') THEN NULL
      WHEN regexp_full_match({t}, '[-+]?(\\d+|\\d+[.]\\d*|[.]\\d+)([eE][-+]?\\d+)?') THEN {t}
      WHEN regexp_full_match({t}, '[-+]?\\d\\d?\\d?(,{three})+([.]\\d*)?') THEN replace({t}, ',', '')
      WHEN regexp_full_match({t}, '[-+]?\\d\\d?\\d?( {three})+([.,]\\d\\d?)?') THEN replace(replace({t}, ' ', ''), ',', '.')
      WHEN regexp_full_match({t}, '[-+]?\\d\\d?\\d?[.]{three}([.]{three})+(,\\d\\d?)?') THEN replace(replace({t}, '.', ''), ',', '.')
      END AS decimal(18,2))"""
    return f"CASE WHEN {v} > 0 THEN {v} END"


def positive_double(x: str) -> str:
    v = f"try_cast({x} AS double)"
    return f"CASE WHEN {v} > 0 AND NOT isnan({v}) THEN {v} END"


def clamp_double(x: str, lo: float, hi: float) -> str:
    v = f"(CASE WHEN isnan(try_cast({x} AS double)) THEN NULL ELSE try_cast({x} AS double) END)"
    return f"CASE WHEN {v} < {lo} THEN {lo} WHEN {v} > {hi} THEN {hi} ELSE {v} END"


def clamp_int(x: str, lo: int, hi: int) -> str:
    v = f"try_cast({x} AS integer)"
    return f"CASE WHEN {v} < {lo} THEN {lo} WHEN {v} > {hi} THEN {hi} ELSE {v} END"


def clean_name(x: str) -> str:
    n = (f"trim(regexp_replace(replace(replace(replace({x}, '\"', ''), chr(10), ' '), ',', ''), "
         f"'\\s+', ' ', 'g'))")
    return f"coalesce(nullif({n}, ''), 'Unknown Developer')"


def domain(x: str, allowed) -> str:
    vals = ", ".join(f"'{v}'" for v in allowed)
    return f"CASE WHEN {x} IS NOT NULL AND lower({x}) IN ({vals}) THEN {initcap(x)} ELSE 'Unknown' END"


def scrub(x: str) -> str:
    return f"CASE WHEN lower(trim({x})) = 'nan' THEN 'Unknown' ELSE {x} END"


def spark_round(x: str, places: int) -> str:
    """Spark's ``round(double, n)``: HALF_UP on the shortest decimal text of the double."""
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(38,18)), {places}) AS double)"


def hash_key(*parts: str) -> str:
    return "md5(concat_ws('||', " + ", ".join(
        f"coalesce(cast({p} AS varchar), '<NULL>')" for p in parts) + "))"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


REPUTATION = ("low", "medium", "high", "excellent", "poor")
PUNCTUALITY = ("low", "medium", "high")


def cleaned(src: str) -> str:
    """All row-wise silver steps over ``src`` (the DuckDB mirror of plans.silver.clean_rows)."""
    city = scrub(clean_text("City"))
    j = "Amenities_JSON"
    return f"""SELECT
  {scrub('Property_ID')} AS Property_ID,
  {city} AS City,
  {scrub(clean_text('District'))} AS District,
  {scrub(clean_text('Compound_Name'))} AS Compound_Name,
  {scrub(clean_text('Unit_Type'))} AS Unit_Type,
  {scrub(clean_text('View_Type'))} AS View_Type,
  {scrub(clean_text('Kitchen_Type', None))} AS Kitchen_Type,
  {within_years(parse_date('Delivery_Date'), 2010, 2035)} AS Delivery_Date,
  {within_years(f"coalesce({parse_date('Date')}, cast(ingestion_time AS date))", 2018, 2027)} AS "Date",
  ingestion_time,
  {parse_amount('Total_Price')} AS Total_Price,
  {positive_double('Size_SqM')} AS Size_SqM,
  {clamp_double('Down_Payment_Pct', 0.0, 100.0)} AS Down_Payment_Pct,
  {clamp_int('Installment_Years', 0, 30)} AS Installment_Years,
  try_cast(Has_Elevator AS boolean) AS Has_Elevator,
  try_cast(Distance_To_City_Center_KM AS double) AS Distance_To_City_Center_KM,
  try_cast(Kitchen_Size_SqM AS double) AS Kitchen_Size_SqM,
  try_cast(Reception_Size_SqM AS double) AS Reception_Size_SqM,
  try_cast(Balcony_Size_SqM AS double) AS Balcony_Size_SqM,
  {scrub(clean_name('Developer_Name'))} AS Developer_Name,
  {domain('Market_Reputation', REPUTATION)} AS Market_Reputation,
  {domain('Delivery_Punctuality', PUNCTUALITY)} AS Delivery_Punctuality,
  CASE WHEN Rooms_Count = 0 THEN 1 ELSE Rooms_Count END AS Rooms_Count,
  coalesce(Smart_Home_Ready, 0) AS Smart_Home_Ready,
  bronze_ingested_at,
  source_file_path,
  row_seq,
  coalesce(CASE WHEN json_valid({j}) THEN try_cast(json_extract_string({j}, '$.has_pool') AS boolean) END, false) AS has_pool,
  coalesce(CASE WHEN json_valid({j}) THEN try_cast(json_extract_string({j}, '$.gym') AS boolean) END, false) AS gym,
  coalesce({scrub(f"CASE WHEN json_valid({j}) THEN json_extract_string({j}, '$.security') END")}, 'None') AS security,
  coalesce(CASE WHEN json_valid({j}) THEN try_cast(json_extract_string({j}, '$.parking_spots') AS integer) END, 0) AS parking_spots,
  try_cast({scrub('Transport_Index')} AS decimal(10,2)) AS Transport_Index_Num,
  try_cast({scrub('Nearby_Schools_Score')} AS decimal(10,2)) AS Nearby_Schools_Score_Num,
  try_cast({scrub('Nearby_Malls_Dist_KM')} AS decimal(10,2)) AS NearbyMalls_Dist_KM
FROM {src}"""


def derived(src: str) -> str:
    """Means, payment features and flags over cleaned rows (windows here; joins in Spark)."""
    return f"""SELECT *,
  CAST(Total_Price AS double) / Size_SqM AS Price_Per_SqM,
  year(Delivery_Date) AS year,
  coalesce(Delivery_Date <= DATE '{AS_OF}', false) AS Is_Ready_To_Move,
  CASE WHEN Installment_Years > 0 THEN 'تقسيط' ELSE 'كاش' END AS Payment_Type,
  coalesce(Transport_Index_Num, avg(Transport_Index_Num) OVER (PARTITION BY City)) AS ti_mean,
  coalesce(Nearby_Schools_Score_Num, avg(Nearby_Schools_Score_Num) OVER (PARTITION BY City)) AS ss_mean,
  CASE WHEN NOT coalesce(Installment_Years > 0, false) THEN 100.0
       WHEN Down_Payment_Pct IS NULL THEN avg(Down_Payment_Pct) OVER (PARTITION BY Developer_Name)
       ELSE Down_Payment_Pct END AS dp_final,
  CASE WHEN Total_Price IS NULL THEN 'Missing or Invalid Price'
       WHEN Size_SqM IS NULL THEN 'Missing or Invalid Size'
       WHEN City = 'Unknown' THEN 'Missing City' END AS quarantine_reason
FROM {src}"""


def silver_ctes(suffix: str = "", where: str | None = None) -> list[str]:
    """CTEs ``dd{suffix}`` (newest versions of the raw rows matching ``where``), ``c{suffix}``
    (cleaned), ``sv{suffix}`` (means and flags) and ``silver{suffix}`` (final columns)."""
    filt = f"WHERE {where}" if where else ""
    return [
        f"""dd{suffix} AS (
  SELECT * FROM raw {filt}
  QUALIFY row_number() OVER (PARTITION BY Property_ID ORDER BY bronze_ingested_at DESC, row_seq DESC) = 1
)""",
        f"c{suffix} AS ({cleaned('dd' + suffix)})",
        f"sv{suffix} AS ({derived('c' + suffix)})",
        f"""silver{suffix} AS (
  SELECT * EXCLUDE (Down_Payment_Pct, Transport_Index_Num, Nearby_Schools_Score_Num, ti_mean, ss_mean, dp_final),
         ti_mean AS Transport_Index_Num, ss_mean AS Nearby_Schools_Score_Num, dp_final AS Down_Payment_Pct,
         {spark_round('Installment_Years / (dp_final + 1)', 2)} AS Payment_Flexibility_Score
  FROM sv{suffix}
)""",
    ]


DEDUP = silver_ctes()[0]
SILVER_CTES = ",\n".join([RAW, *silver_ctes()])

# Developer rows of every raw version, cleaned like silver (name, ratings, 'nan' scrub).
DEV_ROWS = f"""devrows AS (
  SELECT {scrub(clean_name('Developer_Name'))} AS Developer_Name,
         {domain('Market_Reputation', REPUTATION)} AS Market_Reputation,
         {domain('Delivery_Punctuality', PUNCTUALITY)} AS Delivery_Punctuality,
         bronze_ingested_at, row_seq, year(bronze_ingested_at) AS yr
  FROM raw)"""


def scd2_sql(src: str, ts: str) -> str:
    """SCD2 intervals from rows of ``src`` with columns Developer_Name, the two ratings and
    ``ts`` (at most one row per developer and ts)."""
    return f"""SELECT {hash_key('Developer_Name', ts_text(ts))} AS developer_sk, Developer_Name,
       Market_Reputation, Delivery_Punctuality, {ts} AS valid_from_ts,
       lead({ts}) OVER (PARTITION BY Developer_Name ORDER BY {ts}) AS valid_to_ts,
       lead({ts}) OVER (PARTITION BY Developer_Name ORDER BY {ts}) IS NULL AS is_current
FROM (
  SELECT *, lag(Market_Reputation) OVER w AS pm, lag(Delivery_Punctuality) OVER w AS pd,
         row_number() OVER w AS rn
  FROM {src} WINDOW w AS (PARTITION BY Developer_Name ORDER BY {ts})
) WHERE rn = 1 OR pm IS DISTINCT FROM Market_Reputation OR pd IS DISTINCT FROM Delivery_Punctuality"""


HISTORY_CTES = [DEV_ROWS, """devpick AS (
  SELECT * FROM devrows
  QUALIFY row_number() OVER (PARTITION BY Developer_Name, bronze_ingested_at ORDER BY row_seq DESC) = 1)""",
                f"hist AS ({scd2_sql('devpick', 'bronze_ingested_at')})"]


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
