"""Star queries over the gold tables. The guarded runner for generated SQL over them is in
``plans.guard``; its ``guarded_sql`` can be imported from here too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.plans.guard import guarded_sql

__all__ = ["DEFAULT_MEASURES", "guarded_sql", "star_measures", "top_developers"]


def top_developers(fact: DataFrame, developers: DataFrame, locations: DataFrame, city: str,
                   year: int, n: int = 1) -> DataFrame:
    """Developers ranked by their best payment-flexibility score among listings in ``city``
    that are ready to move and delivered in ``year``; ties broken by name. The limit is the
    feature (a top-n report): the plan is a TakeOrderedAndProject over the grouped result."""
    loc = locations.filter(F.col("City") == city).select("location_sk")
    dev = developers.select("developer_sk", "Developer_Name")
    rows = (fact.filter(F.col("Is_Ready_To_Move") & (F.year("Delivery_Date") == year))
            .join(loc, "location_sk", "left_semi")
            .join(dev, "developer_sk"))
    return (rows.groupBy("Developer_Name")
            .agg(F.max("Payment_Flexibility_Score").alias("best_score"),
                 F.round(F.avg("Payment_Flexibility_Score"), 4).alias("avg_score"),
                 F.count(F.lit(1)).alias("listings"))
            .orderBy(F.col("best_score").desc_nulls_last(), F.col("Developer_Name"))
            .limit(n))


# The default measures of star_measures, as (output name, aggregate, column,
# decimal places or None).
DEFAULT_MEASURES = (
    ("listings", "count", "*", None),
    ("avg_price", "avg", "Total_Price", 2),
    ("total_size_sqm", "sum", "Size_SqM", None),
    ("min_price_per_sqm", "min", "Price_Per_SqM", 4),
    ("max_flexibility", "max", "Payment_Flexibility_Score", None),
)
_AGGREGATES = {"count": F.count, "avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max}


def star_measures(fact: DataFrame, locations: DataFrame, by=("City", "Payment_Type"),
                  measures=DEFAULT_MEASURES, where=None, developers: DataFrame | None = None,
                  profiles: DataFrame | None = None, calendar: DataFrame | None = None) -> DataFrame:
    """Aggregates of fact measures (count, avg, sum, min, max) by attributes of the fact or of the
    dimensions given, optionally filtered first (``where``: a Column or SQL text). The calendar is
    joined on the listing date; facts without a match keep NULL attributes. Partial aggregation
    happens before the shuffle, so a hot group costs one row per task."""
    rows = fact.join(locations.select("location_sk", "City", "District"), "location_sk", "left")
    own = set(rows.columns)
    for dim, key in ((developers, "developer_sk"), (profiles, "profile_sk")):
        if dim is not None:
            more = [c for c in dim.columns if c not in own]
            rows = rows.join(dim.select(key, *more), key, "left")
            own |= set(more)
    if calendar is not None:        # a fixed number of days
        more = [c for c in calendar.columns if c not in own]
        day = calendar.select(F.col("Date").alias("__day"), *more)
        rows = rows.join(F.broadcast(day), rows["Date"] == F.col("__day"), "left").drop("__day")
    if where is not None:
        rows = rows.filter(where)
    aggs = []
    for name, func, column, places in measures:
        value = F.lit(1) if column == "*" else F.col(column)
        if func == "avg":
            value = value.cast("double")
        agg = _AGGREGATES[func](value)
        aggs.append((F.round(agg, places) if places is not None else agg).alias(name))
    return rows.groupBy(*by).agg(*aggs)
