"""Generated calendar scan and the date dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default calendar span and weekend days (dayofweek: 1 = Sunday ... 7 = Saturday;
# the weekend is Friday and Saturday).
CALENDAR_START = "2010-01-01"
CALENDAR_END = "2035-12-31"
WEEKEND_DAYS = (6, 7)


def _as_date(value) -> _dt.date:
    return value if isinstance(value, _dt.date) else _dt.date.fromisoformat(str(value))


def date_range(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END,
               name: str = "Date") -> DataFrame:
    """One row per day in [start, end], generated by ``spark.range`` so it is split over tasks."""
    first, last = _as_date(start), _as_date(end)
    days = (last - first).days + 1
    return spark.range(0, max(days, 0)).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def dim_date(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END,
             weekend=WEEKEND_DAYS) -> DataFrame:
    """Calendar dimension: Date, Date_ID, Year, Quarter, Month, Month_Name, Day_Of_Month,
    Day_Of_Week (1 = Sunday), Day_Name, Is_Weekend."""
    return calendar_attributes(date_range(spark, start, end), "Date", weekend)


def calendar_attributes(df: DataFrame, date_col: str = "Date", weekend=WEEKEND_DAYS) -> DataFrame:
    d = F.col(date_col)
    return df.select(
        d.alias("Date"),
        d.alias("Date_ID"),
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("Month_Name"),
        F.dayofmonth(d).alias("Day_Of_Month"),
        F.dayofweek(d).alias("Day_Of_Week"),
        F.date_format(d, "EEEE").alias("Day_Name"),
        F.coalesce(F.dayofweek(d).isin(list(weekend)), F.lit(False)).alias("Is_Weekend"),
    )
